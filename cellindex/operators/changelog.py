"""Changes of an index, and folding them into its documents.

A changelog row is one of: ``upsert`` (a document, in ``doc``), ``delete_id``,
``delete_row``, ``delete_row_family``; or ``ignored`` when a delete cannot be
expressed. ``seq`` orders changes. A document lives if its upsert is the last
change of its id and comes after every delete of its row and family. Folding is
associative and does not depend on arrival order, so batches, replays and full
builds agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellindex.functions.keys import key_format
from cellindex.operators import lookup, mapping, reduce, select
from cellindex.operators.skew import HotKeys, hot_keys, lookup_join
from cellindex.operators.text import ERROR_FIELD
from cellindex.plans.scratch import cut_lineage
from cellindex.sources.cells import CELL_SCHEMA
from cellindex.spec import IndexSpec

UPSERT = "upsert"
DELETE_ID = "delete_id"
DELETE_ROW = "delete_row"
DELETE_ROW_FAMILY = "delete_row_family"
IGNORED = "ignored"

NEVER = -1


def change_kind(spec: IndexSpec) -> Column:
    """What a relevant cell does to a column-mode index."""
    op = F.col("op")
    row = F.lit(DELETE_ROW if spec.row_field is not None else IGNORED)
    both = spec.row_field is not None and spec.family_field is not None
    return (
        F.when(op == select.PUT, F.lit(UPSERT))
        .when(op == select.DELETE_COLUMN, F.lit(DELETE_ID))
        .when(op == select.DELETE_FAMILY, F.lit(DELETE_ROW_FAMILY if both else IGNORED))
        .when(op == select.DELETE_ROW, row)
        .otherwise(F.lit(IGNORED))
    )


def dispatch(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Every relevant cell with the change it causes, its id, row and family text."""
    keys = key_format(spec.key_format, spec.params)
    row, family, qualifier = F.col("row_key"), F.col("family"), F.col("qualifier")
    return (
        cells.filter(select.of_table(spec))
        .filter(select.relevant(spec))
        .withColumns(
            {
                "kind": change_kind(spec),
                "id": keys.cell(row, family, qualifier),
                "row_val": keys.row(row),
                "family_val": keys.family(family),
            }
        )
    )


def tombstones(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Latest delete per row and per (row, family), as changelog rows, within each value of ``by``."""
    deletes = changes.filter(F.col("kind").isin(DELETE_ROW, DELETE_ROW_FAMILY))
    return deletes.groupBy(
        *by, "kind", "row_val", F.when(F.col("kind") == DELETE_ROW_FAMILY, F.col("family_val")).alias("family_val")
    ).agg(F.max("seq").alias("seq"))


def uncovered(
    docs: DataFrame,
    deletes: DataFrame,
    hot: HotKeys | None = None,
    families: list[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Documents not covered by a later delete of their row or family, within each value of ``by``."""
    by = list(by)
    if families is not None:
        # The spec names all families, so a row delete is a delete of each of
        # them and one join answers both.
        each = F.when(F.col("kind") == DELETE_ROW, F.array(*[F.lit(f) for f in families])).otherwise(
            F.array("family_val")
        )
        ends = (
            deletes.filter(F.col("kind").isin(DELETE_ROW, DELETE_ROW_FAMILY))
            .select("row_val", F.explode(each).alias("family_val"), "seq")
            .groupBy("row_val", "family_val")
            .agg(F.max("seq").alias("_end"))
        )
        out = lookup_join(docs, ends, ["row_val", "family_val"], "left", ["id"], hot)
        return out.filter(F.col("seq") > F.coalesce("_end", F.lit(NEVER))).drop("_end")
    rows = deletes.filter(F.col("kind") == DELETE_ROW).select(*by, "row_val", F.col("seq").alias("_row_end"))
    pairs = deletes.filter(F.col("kind") == DELETE_ROW_FAMILY).select(
        *by, "row_val", "family_val", F.col("seq").alias("_family_end")
    )
    out = lookup_join(docs, rows, [*by, "row_val"], "left", ["id"], hot)
    out = lookup_join(out, pairs, [*by, "row_val", "family_val"], "left", ["id"], hot)
    end = F.greatest(F.coalesce("_row_end", F.lit(NEVER)), F.coalesce("_family_end", F.lit(NEVER)))
    return out.filter(F.col("seq") > end).drop("_row_end", "_family_end")


def spec_families(spec: IndexSpec) -> list[str]:
    return [f.decode("utf-8", "replace") if spec.key_format == "string" else f.hex() for f in spec.families]


def column_documents(cells: DataFrame, spec: IndexSpec, hot: HotKeys | None = None) -> DataFrame:
    """Column mode, whole log to live documents: reduce, drop deleted, then decode.

    Decoding comes last, so each surviving document is mapped once.
    """
    per_cell, deletes = _split(cells, spec)
    last = reduce.last_by(per_cell, ["id"]).filter(F.col("kind") == UPSERT)
    # A mapper of the user decides by itself what is relevant, so its families are not known.
    known = spec.key_format in ("string", "hex") and spec.row_mapper is None
    families = spec_families(spec) if known else None
    return uncovered(last, deletes if known else tombstones(deletes), hot, families)


def _split(cells: DataFrame, spec: IndexSpec) -> tuple[DataFrame, DataFrame]:
    """Changes of single cells, and deletes of rows and families.

    The split is on the stored operation, so that it reaches the scans.
    """
    changes = dispatch(cells, spec)
    op = F.col("op")
    per_cell = changes.filter(op.isin(select.PUT, select.DELETE_COLUMN))
    deletes = changes.filter(op.isin(select.DELETE_FAMILY, select.DELETE_ROW))
    return per_cell.select(*CHANGE_KEYS, "family", "qualifier", "value"), deletes.select(*CHANGE_KEYS)


def column_changes(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Column mode changelog of a batch: last change per id, latest delete per row / family."""
    per_cell, deletes = _split(cells, spec)
    docs = mapping.map_cells(reduce.last_by(per_cell, ["id"]), spec)
    doc = F.when(F.col("kind") == UPSERT, F.struct(*document_columns(spec)))
    per_id = with_faults(docs.select(*CHANGE_KEYS, doc.alias("doc")), spec)
    return per_id.unionByName(tombstones(deletes), allowMissingColumns=True)


CHANGE_KEYS = ("kind", "id", "row_val", "family_val", "seq")


def with_faults(changes: DataFrame, spec: IndexSpec) -> DataFrame:
    """Add ``error``: why a document must not be published, NULL for good ones.

    Such faults are texts that a parser could not read and, with ``spec.check_schema``, fields that do not
    fit the types of their names. All parts of a document share one verdict: numbers per part are summed
    by id and come back to the parts, so the parts themselves are never gathered. They are stored
    first, as both steps read them.
    """
    checks = list(fault_checks(spec, changes.schema["doc"].dataType))
    none = F.lit(None).cast("string")
    if not checks:
        return changes.withColumn("error", none)
    text, counts = none, []
    for message, value, most in checks:
        if most is None:
            text = F.coalesce(text, value)
        else:
            counts.append((message, value, most))

    def verdict(parsed: Column, sums: list[Column]) -> Column:
        return F.coalesce(parsed, *[F.when(n > most, F.lit(message)) for n, (message, _, most) in zip(sums, counts)], none)

    is_doc = F.col("kind") == UPSERT
    if "part" not in changes.columns:
        return changes.withColumn("error", F.when(is_doc, verdict(text, [n for _, n, _ in counts])))
    changes = cut_lineage(changes, "judged")
    sums = [F.sum(F.greatest(n, F.lit(0))).alias(f"_n{i}") for i, (_, n, _) in enumerate(counts)]
    per_id = changes.filter(is_doc).groupBy("id").agg(F.max(text).alias("_text"), *sums)
    found = verdict(F.col("_text"), [F.col(f"_n{i}") for i in range(len(counts))])
    bad = per_id.select("id", found.alias("error")).filter("error IS NOT NULL")
    return lookup_join(changes, bad, ["id"], "left", ["part"])


def fault_checks(spec: IndexSpec, doc: T.StructType) -> Iterator[tuple[str, Column, int | None]]:
    """What is looked at in a document: (message, number, how much is allowed), or a fault as text and None."""
    if spec.extracts and spec.row_mapper is None:
        bad = F.filter(F.col("doc")[mapping.TEXT_COLUMN], lambda e: e["field"] == ERROR_FIELD)
        yield "", F.get(bad, F.lit(0))["value"], None
    if spec.check_schema:
        lists = [f.name for f in doc.fields if isinstance(f.dataType, T.ArrayType) and f.name != mapping.TEXT_COLUMN]
        yield from lookup.type_checks({n: F.col("doc")[n] for n in lists})


def good(changes: DataFrame) -> DataFrame:
    """Changes that may be published: an id with a bad document keeps what it had."""
    return changes.filter(F.col("error").isNull())


def quarantined(changes: DataFrame) -> DataFrame:
    """The bad documents of a changelog, with their faults."""
    return changes.filter(F.col("error").isNotNull())


def pending_faults(changes: DataFrame, multipart: bool = False) -> DataFrame:
    """The bad documents that nothing has replaced: no later good change of their id, no later delete of their row.

    Of several bad documents of one id the last counts. Work is done on the ids of bad documents alone.
    """
    bad, fine = quarantined(changes), good(changes)
    last = _last_per_id(bad, multipart)
    order = F.struct("seq", F.coalesce("at", F.lit(NEVER)).alias("at"))
    ids = last.select("id").distinct()
    later = (
        fine.filter(F.col("kind").isin(UPSERT, DELETE_ID))
        .join(ids, "id", "left_semi")
        .groupBy("id")
        .agg(F.max(order).alias("_good"))
    )
    open_ = last.join(later, "id", "left").filter(F.col("_good").isNull() | (order > F.col("_good"))).drop("_good")
    return uncovered(open_, tombstones(fine), None, None)


def document_columns(spec: IndexSpec) -> list[str]:
    if spec.row_mapper is not None:
        return T.StructType.fromDDL(spec.row_mapper.fields).fieldNames()
    return [*spec.field_names, *([mapping.TEXT_COLUMN] if spec.extracts else [])]


def hot_rows(changes: DataFrame) -> HotKeys:
    """Rows that hold an outsized share of the changes, to be taken from stored changes or cells."""
    return hot_keys(changes, ["row_val"])


def change_schema(spark: SparkSession, spec: IndexSpec) -> T.StructType:
    """Schema of stored changes of a spec, so that files of an earlier spec can still be read."""
    if spec.row_mapper is not None:
        doc = T.StructType.fromDDL(spec.row_mapper.fields)
    else:
        none = spark.createDataFrame([], CELL_SCHEMA)
        doc = mapping.map_cells(none, spec).select(*document_columns(spec)).schema
    fields = [T.StructField(n, T.StringType()) for n in ("kind", "id", "row_val", "family_val")]
    fields.append(T.StructField("seq", T.LongType()))
    if spec.mapping == "row":
        fields.append(T.StructField("part", T.LongType()))
    fields += [T.StructField("error", T.StringType()), T.StructField("at", T.LongType())]
    return T.StructType([*fields, T.StructField("doc", doc)])


def fold(
    changes: DataFrame, multipart: bool = False, hot: HotKeys | None = None, docs_only: bool = False
) -> DataFrame:
    """Reduce changes to index state: last change per id and the latest deletes.

    Upserts that a delete covers are left out; the deletes stay, so a late put
    cannot bring a deleted document back. State is itself a changelog and can
    be folded again. ``multipart`` is for row documents that span parts. ``hot``
    names rows to be spread by salting. Of changes with one ``seq`` the later written (``at``) wins.
    """
    ends = tombstones(changes)
    last = _last_per_id(changes, multipart)
    live = uncovered(last.filter(F.col("kind") == UPSERT), ends, hot, None)
    if docs_only:
        return live
    gone = last.filter(F.col("kind") == DELETE_ID)
    return live.unionByName(gone).unionByName(ends, allowMissingColumns=True)


def _last_per_id(changes: DataFrame, multipart: bool) -> DataFrame:
    per_id = changes.filter(F.col("kind").isin(UPSERT, DELETE_ID))
    stamps = ["seq", "at"] if "at" in changes.columns else ["seq"]
    placed = per_id.withColumn("_order", F.struct(*[F.coalesce(s, F.lit(NEVER)).alias(s) for s in stamps]))
    if not multipart:
        return reduce.last_by(placed, ["id"], "_order").drop("_order")
    newest = placed.groupBy("id").agg(F.max("_order").alias("_order"))
    kept = placed.join(newest, ["id", "_order"], "left_semi")
    return reduce.last_by(kept, ["id", "part"], "_order").drop("_order")  # a replayed batch may repeat a part


def apply_changes(
    state: DataFrame,
    changes: DataFrame,
    multipart: bool = False,
    hot: HotKeys | None = None,
    docs_only: bool = False,
) -> DataFrame:
    """Apply a batch of changes to a much larger folded state.

    Same result as folding both together, but every join is built from the
    batch: while the batch is small the state is scanned and never shuffled.
    The folded batch is stored, as several joins read it. ``docs_only`` leaves
    out the deletes, for readers that keep no state.
    """
    batch = cut_lineage(fold(changes, multipart, hot), "batch")
    is_doc = F.col("kind").isin(UPSERT, DELETE_ID)
    old, new = state.filter(is_doc), batch.filter(is_doc)
    old_ends, new_ends = state.filter(~is_doc), batch.filter(~is_doc)

    def by_id(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        # Ids repeat only where documents have parts; a huge one is then spread.
        return lookup_join(left, right, ["id"], how, ["part"]) if multipart else left.join(right, "id", how)

    newer = new.groupBy("id").agg(F.max("seq").alias("_new_seq"))
    kept = by_id(old, newer, "left").filter(
        F.col("_new_seq").isNull() | (F.col("seq") > F.col("_new_seq"))
    ).drop("_new_seq")
    touched = by_id(old.withColumn("_old_seq", F.col("seq")), newer.select("id"), "left_semi")
    older = touched.groupBy("id").agg(F.max("_old_seq").alias("_old_seq"))
    won = by_id(new, older, "left").filter(
        F.col("_old_seq").isNull() | (F.col("seq") >= F.col("_old_seq"))
    ).drop("_old_seq")
    all_ends = tombstones(old_ends.unionByName(new_ends))
    live = uncovered(kept.filter(F.col("kind") == UPSERT), new_ends, hot, None).unionByName(
        uncovered(won.filter(F.col("kind") == UPSERT), all_ends, hot, None)
    )
    if docs_only:
        return live
    gone = kept.filter(F.col("kind") == DELETE_ID).unionByName(won.filter(F.col("kind") == DELETE_ID))
    return live.unionByName(gone).unionByName(all_ends, allowMissingColumns=True)


def documents(state: DataFrame, spec: IndexSpec) -> DataFrame:
    """The documents of folded state, with the field names the spec asks for."""
    live = state.filter(F.col("kind") == UPSERT)
    columns = [F.col("id").alias(spec.key_field)]
    if spec.row_field is not None and spec.mapping == "column":
        columns.append(F.col("row_val").alias(spec.row_field))
    if spec.family_field is not None and spec.mapping == "column":
        columns.append(F.col("family_val").alias(spec.family_field))
    if "part" in state.columns:
        columns.append(F.col("part"))
    for field in state.schema["doc"].dataType:
        value = F.col("doc")[field.name]
        # A document written before the spec had the field has no values for it.
        is_list = isinstance(field.dataType, T.ArrayType)
        columns.append((F.coalesce(value, F.array()) if is_list else value).alias(field.name))
    return live.select(*columns)


# Plain single steps, for tables that are kept by other means.


def upsert(index: DataFrame, docs: DataFrame, key: str = "id") -> DataFrame:
    """Add documents; one that has the id of an old one replaces it."""
    return index.join(docs.select(key), key, "left_anti").unionByName(docs)


def delete_ids(index: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return index.join(ids.select(key).distinct(), key, "left_anti")


def delete_rows(index: DataFrame, rows: DataFrame, row_field: str) -> DataFrame:
    """Delete all documents whose row field equals one of the rows."""
    return lookup_join(index, rows.select(row_field).distinct(), [row_field], "left_anti", ["id"])


def delete_families(index: DataFrame, pairs: DataFrame, row_field: str, family_field: str) -> DataFrame:
    """Delete all documents of the given (row, family) pairs."""
    on = [row_field, family_field]
    return lookup_join(index, pairs.select(*on).distinct(), on, "left_anti", ["id"])
