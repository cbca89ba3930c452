"""Whole jobs: from cell mutations or a source table to documents."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.functions.keys import key_format
from cellindex.operators import changelog, mapping, select
from cellindex.operators.reduce import last_by
from cellindex.operators.skew import MAX_GROUP_VALUES
from cellindex.operators.text import ERROR_FIELD
from cellindex.plans.scratch import cut_lineage
from cellindex.sources.cells import of_rows
from cellindex.spec import IndexSpec, SpecError

COORDINATES = ("row_key", "family", "qualifier")


def column_index(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Column mode: one document per live cell, from the whole mutation log."""
    live = changelog.column_documents(cells, spec)
    docs = mapping.map_cells(live, spec)
    columns = [F.col("id").alias(spec.key_field)]
    if spec.row_field is not None:
        columns.append(F.col("row_val").alias(spec.row_field))
    if spec.family_field is not None:
        columns.append(F.col("family_val").alias(spec.family_field))
    return docs.select(*columns, *changelog.document_columns(spec))


def reread(snapshot: DataFrame, touched: DataFrame, spec: IndexSpec, how: str = "left_semi") -> DataFrame:
    """Current cells of the touched rows, only those the spec reads.

    The predicate reaches the scan of the source table; the join keeps the
    rows. Spark broadcasts ``touched`` when it is small. With ``how`` "inner"
    the other columns of ``touched`` come along. Of a source laid out by row (``sources.cells.write_by_row``)
    only the buckets of touched rows are read; ``touched`` should then be a stored table, as it is read before.
    """
    snapshot = of_rows(snapshot, touched)
    wanted = snapshot.filter(select.of_table(spec)).filter(select.relevant(spec))
    if how == "left_semi":
        touched = touched.select("row_key").distinct()
    return wanted.join(touched, "row_key", how)


def _row_documents(cells: DataFrame, spec: IndexSpec, max_values: int, keep: tuple[str, ...] = ()) -> DataFrame:
    if spec.row_mapper is not None:
        return spec.row_mapper.map(cells, keep, spec.params)
    return mapping.map_rows(cells, spec, max_values, keep)


def bulk_build(snapshot: DataFrame, spec: IndexSpec, max_values: int = MAX_GROUP_VALUES) -> DataFrame:
    """Full build from a source table, with the mapping of the incremental path."""
    cells = snapshot.filter(select.of_table(spec)).filter(select.relevant(spec))
    if spec.mapping == "row":
        docs = mapping.add_key(_row_documents(cells, spec, max_values), spec).drop("row_key")
        return docs.select(spec.key_field, *[c for c in docs.columns if c != spec.key_field])
    docs = mapping.add_row_and_family(mapping.add_key(mapping.map_cells(cells, spec), spec), spec)
    extra = [c for c in (spec.row_field, spec.family_field) if c is not None]
    return docs.select(spec.key_field, *extra, *changelog.document_columns(spec))


def set_aside(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good documents of a full build and, apart, the bad ones with their ``error``.

    A document is bad if a text of it could not be parsed, in whatever part of it.
    """
    if mapping.TEXT_COLUMN not in docs.columns:
        return docs, docs.limit(0).withColumn("error", F.lit(None).cast("string"))
    fault = F.get(F.filter(mapping.TEXT_COLUMN, lambda e: e["field"] == ERROR_FIELD), F.lit(0))["value"]
    if "part" in docs.columns:
        # Stored, as the verdicts of documents are taken from the parts and come back to them.
        docs, key = cut_lineage(docs, "judged"), docs.columns[0]
        bad = docs.groupBy(key).agg(F.max(fault).alias("error")).filter("error IS NOT NULL")
        judged = docs.join(bad, key, "left").select(*docs.columns, "error")
    else:
        judged = docs.withColumn("error", fault)
    return judged.filter("error IS NULL").drop("error"), judged.filter("error IS NOT NULL")


def touched_rows(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Each row's last relevant event, and whether that event can be mapped alone.

    One hash aggregation on numbers: a row's last relevant event is that of the relevant
    cell with the greatest ``seq``, whatever its own number, and it is complete if every needed
    column was last put by that same event.
    """
    log = cells.filter(select.of_table(spec))

    def last_event(which: Column) -> Column:
        return F.max(F.when(which, F.struct("seq", "event_id")))

    last = last_event(select.touches_row(spec)).alias("_last")
    needed = select.required_columns(spec) if spec.read_row == "dynamic" else []
    if not needed:
        complete = F.lit(needed is not None)
        grouped = log.groupBy("row_key").agg(last)
    else:
        puts = {f"_put{i}": last_event(select.matches(t) & select.is_put()) for i, t in enumerate(needed)}
        grouped = log.groupBy("row_key").agg(last, *[c.alias(n) for n, c in puts.items()])
        own = F.col("_last.event_id")
        complete = reduce(lambda a, b: a & b, [F.coalesce(F.col(n)["event_id"] == own, F.lit(False)) for n in puts])
    return grouped.filter("_last IS NOT NULL").select(
        "row_key", F.col("_last.event_id").alias("event_id"), F.col("_last.seq").alias("change_seq"), complete.alias("complete")
    )


def event_cells(cells: DataFrame, events: DataFrame, spec: IndexSpec) -> DataFrame:
    """The puts of the given events, the last one per column."""
    puts = cells.filter(select.of_table(spec)).filter(select.is_put())
    own = puts.join(events.select("row_key", "event_id", "change_seq"), ["row_key", "event_id"])
    return last_by(own.select("change_seq", *COORDINATES, "value", "seq"), ["change_seq", *COORDINATES])


def row_changes(
    cells: DataFrame,
    spec: IndexSpec,
    snapshot: DataFrame | None = None,
    max_values: int = MAX_GROUP_VALUES,
) -> DataFrame:
    """Row mode changelog of a batch: a document or a delete for each touched row.

    With ``read_row`` "never" the last event's own puts are mapped. With
    "dynamic" an event that lacks a needed column sends its row to the source
    table ``snapshot``, taken at the end of the batch. A document that was read again holds all
    that the source knew by then, so its ``seq`` is the greatest of its event and of the
    cells found: a late event does not lose to what came before it.
    """
    # Both are read several times and are no larger than the batch touches.
    touched = cut_lineage(touched_rows(cells, spec), "touched")
    shared = ["row_key", "family", "qualifier", "value", "change_seq"]
    if spec.read_row == "never":
        found = event_cells(cells, touched, spec).select(*shared)
    elif snapshot is None:
        raise ValueError("read_row 'dynamic' needs the source table")
    else:
        stale = touched.filter(~F.col("complete")).select("row_key", "change_seq")
        known = F.greatest("change_seq", "seq")  # the row's greatest is taken when it is mapped
        found = reread(snapshot, stale, spec, "inner").withColumn("change_seq", known).select(*shared)
        if select.required_columns(spec) is not None:
            alone = event_cells(cells, touched.filter("complete"), spec).select(*shared)
            found = found.unionByName(alone)
    found = cut_lineage(found, "found")
    docs = _row_documents(found, spec, max_values, keep=("change_seq",))
    fields = [c for c in docs.columns if c not in ("row_key", "part", "change_seq")]
    upserts = docs.select(
        F.lit(changelog.UPSERT).alias("kind"), "row_key", F.col("change_seq").alias("seq"), "part",
        F.struct(*fields).alias("doc"),
    )
    # Rows without any cell left; distinct combines before it shuffles.
    gone = touched.join(found.select("row_key").distinct(), "row_key", "left_anti").select(
        F.lit(changelog.DELETE_ID).alias("kind"), "row_key", F.col("change_seq").alias("seq"),
        F.lit(0).cast("bigint").alias("part"),
    )
    key = key_format(spec.key_format, spec.params).row(F.col("row_key"))
    both = upserts.unionByName(gone, allowMissingColumns=True).select(
        "kind", key.alias("id"), key.alias("row_val"), F.lit(None).cast("string").alias("family_val"),
        "seq", "part", "doc",
    )
    return changelog.with_faults(both, spec)


def changes(cells: DataFrame, spec: IndexSpec, snapshot: DataFrame | None = None) -> DataFrame:
    """The changelog of a batch in the spec's own mode."""
    if spec.mapping == "column":
        return changelog.column_changes(cells, spec)
    return row_changes(cells, spec, snapshot)


def multi_index(cells: DataFrame, specs: Mapping[str, IndexSpec]) -> DataFrame:
    """Several column-mode indexes from one pass over one log.

    Every cell is tagged with the specs it feeds, and ids are reduced under (``index_name``, id) in one
    grouping; deletes apply within their index. Besides ``id`` and ``seq`` there is one struct column for each
    index, NULL in documents of the others; ``of_index`` takes one out.
    """
    if not specs:
        raise SpecError("name one index at least")
    if any(s.mapping != "column" or s.row_mapper is not None for s in specs.values()):
        raise SpecError("one pass is for indexes in column mode whose fields are mapped by their specs")
    tags = []
    for name, spec in specs.items():
        keys = key_format(spec.key_format, spec.params)
        row, family, qualifier = F.col("row_key"), F.col("family"), F.col("qualifier")
        tag = F.struct(
            F.lit(name).alias("index_name"), changelog.change_kind(spec).alias("kind"), keys.cell(row, family, qualifier).alias("id"),
            keys.row(row).alias("row_val"), keys.family(family).alias("family_val"),
        )
        tags.append(F.when(select.of_table(spec) & select.relevant(spec), tag))
    wanted = select.any_of(select.of_table(s) & select.relevant(s) for s in specs.values())
    tagged = cells.filter(wanted).withColumn("_tag", F.explode(F.array_compact(F.array(*tags)))).select(
        "_tag.*", "seq", "op", *COORDINATES, "value"
    )
    # One grouping for all: ids to their last cell, rows and families to their last delete. Both readers below tell
    # them apart by what was reduced, not by the keys, so that Spark plans the grouping once and reads it twice.
    single = F.col("op").isin(select.PUT, select.DELETE_COLUMN)
    keyed = tagged.select(
        "index_name", F.when(single, F.col("id")).alias("_id"), F.when(~single, F.col("row_val")).alias("_row"),
        F.when(F.col("op") == select.DELETE_FAMILY, F.col("family_val")).alias("_family"),
        F.struct("kind", "id", "row_val", "family_val", "family", "qualifier", "value", "seq").alias("_cell"), "seq",
    )
    reduced = keyed.groupBy("index_name", "_id", "_row", "_family").agg(F.max_by("_cell", "seq").alias("_last"))
    last = reduced.filter(F.col("_last.kind") == changelog.UPSERT).select("index_name", "_last.*")
    ends = reduced.filter(F.col("_last.kind").isin(changelog.DELETE_ROW, changelog.DELETE_ROW_FAMILY))
    live = changelog.uncovered(last, changelog.tombstones(ends.select("index_name", "_last.*"), ["index_name"]), by=["index_name"])
    columns = []
    for name, spec in specs.items():
        docs = F.struct(*[c.alias(n) for n, c in mapping.cell_fields(spec).items()])
        columns.append(F.when(F.col("index_name") == name, docs).alias(f"doc_{name}"))
    return live.select("index_name", "id", "row_val", "family_val", "seq", *columns)


def of_index(docs: DataFrame, name: str, spec: IndexSpec) -> DataFrame:
    """The documents of one index of ``multi_index``, with the columns of ``column_index``."""
    columns = [F.col("id").alias(spec.key_field)]
    if spec.row_field is not None:
        columns.append(F.col("row_val").alias(spec.row_field))
    if spec.family_field is not None:
        columns.append(F.col("family_val").alias(spec.family_field))
    return docs.filter(F.col("index_name") == name).select(*columns, f"`doc_{name}`.*")


def versioned_relevance(versions: Iterable[tuple[IndexSpec, int | None, int | None]]):
    """Relevance when the spec changed over time: each version from one seq up to another."""
    seq = F.col("seq")
    parts = []
    for spec, start, end in versions:
        within = F.lit(True)
        if start is not None:
            within = within & (seq >= start)
        if end is not None:
            within = within & (seq < end)
        parts.append(within & select.relevant(spec))
    return select.any_of(parts)
