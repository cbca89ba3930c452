"""Reading the index and checking documents against its schema."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.plans.scratch import cut_lineage

# Field-name suffix -> (Spark type, many values allowed).
SUFFIX_TYPES = {
    "_i": ("int", False),
    "_is": ("int", True),
    "_s": ("string", False),
    "_ss": ("string", True),
    "_l": ("bigint", False),
    "_ls": ("bigint", True),
    "_t": ("string", False),
    "_txt": ("string", True),
    "_f": ("float", False),
    "_fs": ("float", True),
    "_d": ("double", False),
    "_ds": ("double", True),
}


def terms(index: DataFrame, wanted: Mapping[str, object]) -> Column:
    """All of the given field values are present; array fields need one equal value."""
    types = dict(index.dtypes)
    conditions = []
    for name, value in wanted.items():
        if types[name].startswith("array"):
            conditions.append(F.array_contains(name, value))
        else:
            conditions.append(F.col(name) == value)
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def find(index: DataFrame, wanted: Mapping[str, object], key: str = "id") -> DataFrame:
    """Documents that carry every wanted value.

    Documents in parts match if their parts do so together; flags per document
    are combined before the shuffle, so part lists are never gathered.
    """
    if "part" not in index.columns or not wanted:
        return index.filter(terms(index, wanted))
    # Only documents with a part that has the first term can match, so the others are checked on those alone.
    first, *others = wanted.items()
    some = index.filter(terms(index, dict([first]))).select(key).distinct()
    matched = some
    if others:
        flags = [F.bool_or(terms(index, {n: v})).alias(f"_m{i}") for i, (n, v) in enumerate(others)]
        matched = index.join(some, key, "left_semi").groupBy(key).agg(*flags)
        for i in range(len(flags)):
            matched = matched.filter(F.col(f"_m{i}"))
    return index.join(matched.select(key), key, "left_semi")


def suffix_type(field: str) -> tuple[str, bool] | None:
    """Type and cardinality a field name stands for; None if the schema has no such field."""
    suffix = field[field.rfind("_"):] if "_" in field else ""
    return SUFFIX_TYPES.get(suffix)


def in_schema(field: Column, names: Sequence[str] = ()) -> Column:
    """The schema has such a field, by its suffix or by its full name.

    Fields of parsed texts are open-ended; this keeps those the index can hold.
    """
    suffix = F.regexp_extract(field, "_[^_]*$", 0)
    return suffix.isin(*SUFFIX_TYPES) | field.isin(*names) if names else suffix.isin(*SUFFIX_TYPES)


def type_checks(fields: Mapping[str, Column]) -> Iterator[tuple[str, Column, int]]:
    """Per way in which list fields may not fit the types of their names: message, what a part counts, how much is allowed."""
    for name, values in fields.items():
        known = suffix_type(name)
        if known is None:
            yield f"{name}: unknown field", F.size(values), 0
            continue
        spark_type, many = known
        cast = F.transform(values, lambda v: v.try_cast(spark_type))
        yield f"{name}: not a {spark_type}", F.size(F.filter(cast, lambda v: v.isNull())), 0
        if not many:
            yield f"{name}: more than one value", F.size(values), 1


def typed(docs: DataFrame, fields: Sequence[str], key: str = "id") -> DataFrame:
    """Give ARRAY<STRING> fields the types of their names; add ``error``.

    A value that cannot be read as the type, several values in a single-valued
    field, or a field the schema does not know is an error of the document. Of
    a document in parts, all parts are judged together and share the verdict.
    """
    columns: dict[str, Column] = {}
    for name in fields:
        known = suffix_type(name)
        if known is not None:
            values = F.transform(name, lambda v: v.try_cast(known[0]))
            columns[name] = values if known[1] else F.get(values, F.lit(0))
    checks = list(type_checks({name: F.col(name) for name in fields}))

    def fault(counts: Sequence[Column]) -> Column:
        found = [F.when(n > most, F.lit(message)) for n, (message, _, most) in zip(counts, checks)]
        return F.coalesce(*found, F.lit(None).cast("string"))

    if "part" not in docs.columns:
        return docs.withColumns({**columns, "error": fault([n for _, n, _ in checks])})
    # Stored, as the verdicts are taken from the parts and come back to them. Numbers are combined before the
    # shuffle, one per check and document, and only the faults found are joined. Documents without a key have no verdict.
    docs = cut_lineage(docs.filter(F.col(key).isNotNull()), "judged")
    sums = docs.groupBy(key).agg(*[F.sum(F.greatest(n, F.lit(0))).alias(f"_n{i}") for i, (_, n, _) in enumerate(checks)])
    verdicts = sums.select(key, fault([F.col(f"_n{i}") for i in range(len(checks))]).alias("error"))
    bad = cut_lineage(verdicts.filter("error IS NOT NULL"), "faults")
    return docs.withColumns(columns).join(bad, key, "left")


def accepted(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("error").isNull()).drop("error")


def quarantined(docs: DataFrame) -> DataFrame:
    """Bad documents with their fault; the good ones go on without them."""
    return docs.filter(F.col("error").isNotNull())


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Keys that were added, updated or deleted between two snapshots; documents in parts count once."""
    before = old.groupBy(key).agg(F.max(version).alias("old_version"))
    after = new.groupBy(key).agg(F.max(version).alias("new_version"))
    change = (
        F.when(F.col("old_version").isNull(), F.lit("ADDED"))
        .when(F.col("new_version").isNull(), F.lit("DELETED"))
        .when(F.col("old_version") != F.col("new_version"), F.lit("UPDATED"))
    )
    return before.join(after, key, "full_outer").withColumn("change", change).filter("change IS NOT NULL")


def bucket_digests(docs: DataFrame, key: str, version: str, buckets: int) -> DataFrame:
    """Per hash bucket of keys, what its (key, version) rows add up to, in whatever order they come.

    Counts and sums combine before they are shuffled: a row for each task and bucket.
    """
    mark = F.xxhash64(key, version)
    low, high = mark.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright(mark, 32)
    return docs.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.bit_xor(F.xxhash64(version, key)).alias("mixed")
    )


def differing_buckets(old: DataFrame, new: DataFrame, key: str, version: str, buckets: int) -> DataFrame:
    """The buckets whose digests differ: ``buckets`` numbers at most."""
    before, after = (bucket_digests(x, key, version, buckets) for x in (old, new))
    names = ["n", "low", "high", "mixed"]
    renamed = after.select(F.col("bucket").alias("other"), *[F.col(c).alias(f"_{c}") for c in names])
    both = before.join(renamed, F.col("bucket") == F.col("other"), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
    return both.filter(~same).select(F.coalesce("bucket", "other").alias("bucket"))


def snapshot_diff_digest(old: DataFrame, new: DataFrame, key: str, version: str, buckets: int = 4096) -> DataFrame:
    """``snapshot_diff`` of two stored snapshots that are mostly alike.

    Digests of hash buckets are compared first, from a scan of two columns. Only rows of buckets that differ
    are shuffled and joined. A bucket of equal rows always has equal digests; one of other rows has them
    with a chance of some 2 ** -100.
    """
    changed = F.broadcast(differing_buckets(old, new, key, version, buckets))  # at most ``buckets`` numbers

    def some(docs: DataFrame) -> DataFrame:
        placed = docs.select(key, version, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"))
        return placed.join(changed, "bucket", "left_semi").drop("bucket")

    return snapshot_diff(some(old), some(new), key, version)
