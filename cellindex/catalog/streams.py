"""Queries: continuous indexing. Each must end with the documents of a full build."""

from __future__ import annotations

from cellindex.catalog.indexes import _LIVE_DOCS, ALL_FAMILIES, TYPED_ORDER, _families as families, _middle, flat
from cellindex.catalog.registry import LIVE_CELLS, ORDER_CELLS, SQL, query
from cellindex.operators import metrics
from cellindex.operators.skew import tasks_for
from cellindex.plans import history
from cellindex.plans.scratch import work_dir
from cellindex.plans.table import IndexTable
from cellindex.sources.cells import CELL_SCHEMA, stream_cells
from cellindex.sources.tables import event_cells, order_cells, page_cells
from cellindex.spec import ExtractSpec, IndexSpec
from cellindex.streaming.indexing import counters, start_indexing
from pyspark.sql import functions as F

_SQL = f"WITH {LIVE_CELLS} {_LIVE_DOCS}"


def _arrive(cells, path: str, batches: int) -> int:
    """Write cells as files of the stream's source folder, and return how many of them make a batch.

    Files are ranges of ``seq``, so all cells of an event lie in one file. A batch has as many as its size asks for.
    """
    cells = cells.select(*CELL_SCHEMA.fieldNames())
    files = -(-tasks_for(cells) // batches)
    cells.repartitionByRange(batches * files, "seq").write.mode("append").parquet(path)
    return files


def _run(spark, source: str, table: IndexTable, checkpoint: str, files: int) -> None:
    start_indexing(stream_cells(spark, source, files_per_batch=files), table, checkpoint).awaitTermination()


@query("stream_index", _SQL)
def stream_index(spark, folder):
    work = work_dir(spark, "stream")
    files = _arrive(event_cells(spark, folder), f"{work}/in", 3)
    table = IndexTable(spark, f"{work}/index", ALL_FAMILIES)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    return flat(table.documents())


@query("stream_resume", _SQL)
def stream_resume(spark, folder):
    """Stop after the first half, compact, let more cells arrive, go on."""
    work = work_dir(spark, "resume")
    cells, middle = event_cells(spark, folder), _middle(spark, folder)
    table = IndexTable(spark, f"{work}/index", ALL_FAMILIES)
    files = _arrive(cells.filter(F.col("seq") < middle), f"{work}/in", 1)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    table.compact()
    files = _arrive(cells.filter(F.col("seq") >= middle), f"{work}/in", 1)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    return flat(table.documents())


@query("stream_replay", _SQL)
def stream_replay(spark, folder):
    """Consume everything twice: a lost checkpoint delivers all events again, cut into other batches."""
    work = work_dir(spark, "replay")
    cells = event_cells(spark, folder)
    files = _arrive(cells, f"{work}/in", 2)
    files_again = _arrive(cells, f"{work}/again", 3)
    table = IndexTable(spark, f"{work}/index", ALL_FAMILIES)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    _run(spark, f"{work}/again", table, f"{work}/checkpoint-again", files_again)
    return flat(table.documents())


@query("stream_resubscribe", _SQL)
def stream_resubscribe(spark, folder):
    """Index the first half and compact; then subscribe anew, from shortly before the end of that half."""
    work = work_dir(spark, "resubscribe")
    cells, middle = event_cells(spark, folder), _middle(spark, folder)
    table = IndexTable(spark, f"{work}/index", ALL_FAMILIES)
    files = _arrive(cells.filter(F.col("seq") < middle), f"{work}/in", 2)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    table.compact()
    files = _arrive(cells.filter(F.col("seq") >= middle), f"{work}/in", 1)
    cutoff = cells.filter(F.col("seq") < middle - 20).agg(F.max("ts")).first()[0]
    seen = stream_cells(spark, f"{work}/in", since=cutoff, files_per_batch=files)
    start_indexing(seen, table, f"{work}/new-checkpoint").awaitTermination()
    return flat(table.documents())


def unless_fifth(html: str):
    """A parser of the user that cannot read some pages."""
    if len(html) % 5 == 0:
        raise ValueError("cannot be read")
    return [("length", str(len(html)))]


PARSED = IndexSpec(
    "pages",
    extracts=[ExtractSpec("content:*", type="text/html", params={"parsers": {"text/html": unless_fifth}})],
    mapping="column",
)


@query(
    "stream_quarantine",
    """SELECT page_id, CASE WHEN length(html) % 5 = 0 THEN 'ValueError: cannot be read' END AS error,
CASE WHEN length(html) % 5 <> 0 THEN CAST(length(html) AS VARCHAR) END AS length FROM pages""",
)
def stream_quarantine(spark, folder):
    """Pages that the parser cannot read are set aside, the others indexed."""
    work = work_dir(spark, "quarantine")
    files = _arrive(page_cells(spark, folder), f"{work}/in", 2)
    table = IndexTable(spark, f"{work}/index", PARSED)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    page = F.regexp_extract("id", "(\\d+)$", 1).cast("bigint").alias("page_id")
    field = F.get(F.filter("text_fields", lambda e: e["field"] == "length"), F.lit(0))["value"]
    none = F.lit(None).cast("string")
    good = table.documents().select(page, none.alias("error"), field.alias("length"))
    return good.unionByName(table.quarantine().select(page, "error", none.alias("length")))


@query(
    "stream_report",
    """SELECT 'pages' AS run, CAST(count(*) AS BIGINT) AS records_in,
CAST(count(*) FILTER (length(html) % 5 = 0) AS BIGINT) AS records_failed,
CASE WHEN count(*) FILTER (length(html) % 5 = 0) = 0 THEN 'FINISHED' ELSE 'FINISHED_WITH_ERRORS' END AS state,
count(*) FILTER (length(html) % 5 = 0) = 0 AS success FROM pages""",
)
def stream_report(spark, folder):
    """The report of a run, from the counters that its batches stored."""
    work = work_dir(spark, "report")
    files = _arrive(page_cells(spark, folder), f"{work}/in", 2)
    table = IndexTable(spark, f"{work}/index", PARSED)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    stored = spark.read.parquet(f"{work}/index/metrics").withColumn("run", F.lit("pages"))
    return metrics.stored_report(stored.select("run", "metric", "value"))


CHECKED_ORDER = IndexSpec("orders", TYPED_ORDER.fields, read_row="never", check_schema=True)


@query(
    "stream_schema_faults",
    f"""WITH {ORDER_CELLS}, d AS (SELECT h.row_key AS id, count(i.qualifier) AS n,
count(i.qualifier) FILTER (i.qualifier LIKE '01%') > 1 AS bad FROM heads h LEFT JOIN items i USING (row_key) GROUP BY 1)
SELECT id, CASE WHEN NOT bad THEN n END AS n_lines, CASE WHEN bad THEN 'first_s: more than one value' END AS error FROM d""",
)
def stream_schema_faults(spark, folder):
    """Orders whose fields do not fit the types of their names are set aside while they are indexed."""
    work = work_dir(spark, "schema")
    files = _arrive(order_cells(spark, folder), f"{work}/in", 2)
    table = IndexTable(spark, f"{work}/index", CHECKED_ORDER)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    good = table.documents().select("id", F.size("lines_ss").cast("bigint").alias("n_lines"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(table.quarantine().select("id", F.lit(None).cast("bigint").alias("n_lines"), "error"))


@query(
    "quarantine_after_compact",
    """SELECT page_id, 'ValueError: cannot be read' AS error FROM pages
WHERE (length(html) + CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END) % 5 = 0""",
)
def quarantine_after_compact(spark, folder):
    """Faults outlive compactions until a good document comes: every third page is put again, one character longer."""
    work = work_dir(spark, "kept-aside")
    cells = page_cells(spark, folder)
    last = cells.agg(F.max("seq")).first()[0]
    number = F.col("seq") + last + 1
    longer = cells.filter(F.col("seq") % 3 == 0).withColumns(
        {"value": F.concat("value", F.lit(b" ")), "seq": number, "event_id": number}
    )
    table = IndexTable(spark, f"{work}/index", PARSED)
    files = _arrive(cells, f"{work}/in", 1)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    table.compact()
    files = _arrive(longer, f"{work}/in", 1)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    table.compact()
    page = F.regexp_extract("id", "(\\d+)$", 1).cast("bigint").alias("page_id")
    return table.quarantine().select(page, "error")


@query("stream_spec_change", SQL["spec_change"])
def stream_spec_change(spark, folder):
    """A second family joins the stored spec in the middle of a batch; earlier events of it are not indexed."""
    work, middle = work_dir(spark, "spec-change"), _middle(spark, folder)
    old, new = families("table1", "act"), families("table1", "act", "buy")
    history.remember(spark, f"{work}/index", old)
    history.remember(spark, f"{work}/index", new, since=middle)
    files = _arrive(event_cells(spark, folder), f"{work}/in", 3)
    _run(spark, f"{work}/in", history.open_table(spark, f"{work}/index"), f"{work}/checkpoint", files)
    return flat(history.open_table(spark, f"{work}/index").documents())


@query(
    "stream_metrics",
    f"""WITH {ORDER_CELLS}, d AS (SELECT h.row_key, count(i.qualifier) FILTER (i.qualifier LIKE '01%') > 1 AS bad
  FROM heads h LEFT JOIN items i USING (row_key) GROUP BY 1),
counted AS (SELECT count(*) AS incoming_events, count(*) AS applicable_events, count(*) FILTER (NOT bad) AS adds,
  count(*) FILTER (bad) AS document_errors, 0 AS deletes_by_id, 0 AS deletes_by_query, 0 AS ignored, 0 AS bad_values, 0 AS system_errors
  FROM d)
SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def stream_metrics(spark, folder):
    """Row mode: the counters that a stream took while it wrote, one per document whatever its parts."""
    work = work_dir(spark, "metrics")
    files = _arrive(order_cells(spark, folder), f"{work}/in", 2)
    table = IndexTable(spark, f"{work}/index", CHECKED_ORDER)
    _run(spark, f"{work}/in", table, f"{work}/checkpoint", files)
    return counters(table)
