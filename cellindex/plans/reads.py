"""A copy of an index laid out for lookups: documents by id, and ids by term.

``documents`` lie in buckets by a hash of their id, sorted by id, with a bloom filter on it. ``terms`` name for
each chosen field and value the ids that carry it, sorted by a hash of the value, with a bloom filter on that. A
lookup opens the row groups of its terms, then those of the ids found; it never scans the documents. A term that
very many documents carry lies in many files, as ids are part of the order.

The copy is of a moment: it is written from a table of documents and replaced as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellindex.operators import lookup
from cellindex.plans.scratch import cut_lineage

BUCKET = "id_bucket_of_"
#: Up to so many ids are compared with the bloom filters and statistics of row groups one by one.
FEW = 64


def _bucket(key: str, of: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(of)).cast("int")


def _element(kind: T.DataType) -> T.DataType:
    return kind.elementType if isinstance(kind, T.ArrayType) else kind


def _term(value: Column, kind: T.DataType) -> Column:
    """A value as text, the same for equal values alone."""
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(kind)  # both zeros are equal
    return value.cast("string")


def write(
    docs: DataFrame, path: str, fields: Sequence[str], key: str = "id", buckets: int = 256, options: Mapping[str, str] | None = None
) -> None:
    """Lay out ``docs`` under ``path`` for lookups by ``key`` and by the values of ``fields``.

    Fields are single values or arrays; null values are no terms. ``options`` go to the Parquet writer, as the size of row groups.
    Documents are stored first, as both layouts read them, once to find ranges and once to write. They are shuffled once and
    their terms once, whatever the number of fields.
    """
    if not fields:
        raise ValueError("name the fields to look up by")
    docs = cut_lineage(docs, "to-lay-out")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    place = f"{BUCKET}{buckets}"
    placed = docs.withColumn(place, _bucket(key, buckets))
    order = [place, key, *(["part"] if "part" in kinds else [])]

    def save(rows: DataFrame, name: str, by: str, bloom: str) -> None:
        writer = rows.write.mode("overwrite").partitionBy(by).option(f"parquet.bloom.filter.enabled#{bloom}", "true")
        writer.options(**dict(options or {})).parquet(f"{path}/{name}")

    def pairs(name: str) -> Column:
        kind = _element(kinds[name])
        many = F.col(name) if isinstance(kinds[name], T.ArrayType) else F.array(name)
        each = F.transform(F.array_distinct(many), lambda v: F.struct(F.lit(name).alias("field"), _term(v, kind).alias("term")))
        return F.coalesce(each, F.array().cast("array<struct<field:string,term:string>>"))

    terms = docs.select(F.col(key), F.explode(F.concat(*[pairs(f) for f in fields])).alias("t"))
    terms = terms.select("t.field", F.xxhash64("t.term").alias("hash"), "t.term", key).filter(F.col("term").isNotNull())
    by_term = ["field", "hash", "term", key]
    placed.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")
    docs.sparkSession.createDataFrame([(f,) for f in fields], "field string").coalesce(1).write.mode("overwrite").parquet(f"{path}/fields")
    save(placed.repartitionByRange(*order).sortWithinPartitions(*order), "documents", place, key)
    save(terms.repartitionByRange(*by_term).sortWithinPartitions(*by_term), "terms", "field", "hash")


def _matched(spark: SparkSession, path: str, wanted: Mapping[str, object], kinds: Mapping[str, T.DataType], key: str) -> DataFrame:
    """Ids that carry all wanted terms, whichever of their parts do."""
    terms = spark.read.schema(
        T.StructType().add("hash", "long").add("term", "string").add(key, kinds[key]).add("field", "string")
    ).parquet(f"{path}/terms")
    conditions = []
    for name, value in wanted.items():
        kind = _element(kinds[name])
        own = F.lit(value).cast(kind)
        term = _term(own, kind)
        # A value that its field's type cannot hold exactly is in no document.
        held = own == F.lit(value)
        conditions.append((F.col("field") == name) & (F.col("hash") == F.xxhash64(term)) & (F.col("term") == term) & held)
    found = terms.filter(reduce(lambda a, b: a | b, conditions))
    if len(conditions) == 1:
        return found.select(key).distinct()
    which = F.coalesce(*[F.when(c, F.lit(1 << i)) for i, c in enumerate(conditions)])
    return found.groupBy(key).agg(F.bit_or(which).alias("has")).filter(F.col("has") == (1 << len(conditions)) - 1).select(key)


def find(spark: SparkSession, path: str, wanted: Mapping[str, object], key: str = "id") -> DataFrame:
    """``lookup.find`` over a layout that ``write`` made: all parts of the documents that carry every wanted value.

    ``wanted`` names laid-out fields, and may name ``key``. Ids that match are stored first. The few are sought one by one;
    for many, the buckets they lie in are read and joined; either way all of them are found.
    """
    schema = spark.read.parquet(f"{path}/schema").schema
    kinds = {f.name: f.dataType for f in schema.fields}
    place = next(n for n in kinds if n.startswith(BUCKET))
    of = int(place[len(BUCKET) :])
    docs = spark.read.schema(schema).parquet(f"{path}/documents")
    laid = {r["field"] for r in spark.read.schema("field string").parquet(f"{path}/fields").collect()}
    unknown = set(wanted) - laid - {key}
    if unknown:
        raise ValueError(f"not laid out for lookups: {sorted(unknown)}")
    if not wanted:
        return docs.drop(place)
    if key in wanted:
        one = docs.filter((F.col(place) == _bucket_of(wanted[key], kinds[key], of)) & (F.col(key) == F.lit(wanted[key])))
        return lookup.find(one.drop(place), {n: v for n, v in wanted.items() if n != key}, key)
    ids = cut_lineage(_matched(spark, path, wanted, kinds, key), "ids")
    some = ids.select(key, _bucket(key, of).alias("b")).limit(FEW + 1).collect()
    if not some:
        return docs.filter(F.lit(False)).drop(place)
    if len(some) <= FEW:
        these = reduce(lambda a, b: a | b, [F.col(key) == F.lit(r[key]) for r in some])
        return docs.filter(F.col(place).isin(sorted({r["b"] for r in some})) & these).drop(place)
    opened = [r["b"] for r in ids.select(_bucket(key, of).alias("b")).distinct().collect()]  # numbers below ``of``
    return docs.filter(F.col(place).isin(opened)).join(ids, key, "left_semi").drop(place)


def _bucket_of(value: object, kind: T.DataType, of: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(value).cast(kind)), F.lit(of)).cast("int")
