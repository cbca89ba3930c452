"""Queries: whole indexes, changes applied to them, reads and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellindex.catalog import registry
from cellindex.catalog.registry import EVENT_CELLS, LIVE_CELLS, ORDER_CELLS, money, query
from cellindex.catalog.documents import ORDER_DOC
from cellindex.operators import changelog, lookup, mapping, metrics, reduce, select
from cellindex.plans import build, reads
from cellindex.plans.scratch import cut_lineage, work_dir
from cellindex.plans.table import IndexTable
from cellindex.sources.cells import without_dictionary, write_by_row
from cellindex.sources.tables import event_cells, event_key, order_cells, spread, stored, table
from cellindex.spec import FieldSpec, IndexSpec


def _families(tbl: str, *names: str) -> IndexSpec:
    return IndexSpec(
        tbl,
        [FieldSpec("value_d", f"{n}:*", type="double") for n in names],
        mapping="column",
        row_field="row_s",
        family_field="family_s",
    )


ALL_FAMILIES = _families("table1", "act", "buy", "info")
_ID_SQL = "replace(row_key, '-', '\\-') || '-' || family || '-' || qualifier"
_LIVE_DOCS = f"""SELECT {_ID_SQL} AS id, row_key AS row_s, family AS family_s, value FROM live WHERE tbl = 'table1'"""


def flat(docs):
    """The single value of each cell document."""
    return docs.select("id", "row_s", "family_s", F.get("value_d", F.lit(0)).alias("value"))


@query("column_index", f"WITH {LIVE_CELLS} {_LIVE_DOCS}")
def column_index(spark, folder):
    return flat(build.column_index(event_cells(spark, folder), ALL_FAMILIES))


@query(
    "multi_index",
    f"""WITH {EVENT_CELLS.replace("cells AS", "every AS")},
cells AS (SELECT * FROM every WHERE tbl = 'table1' OR family IN ('act', 'buy')),
{LIVE_CELLS[len(EVENT_CELLS) + 2:]}
SELECT CASE WHEN tbl = 'table1' THEN 'first' ELSE 'second' END AS index_name,
{_ID_SQL} AS id, row_key AS row_s, family AS family_s, value FROM live""",
)
def multi_index(spark, folder):
    specs = {"first": ALL_FAMILIES, "second": _families("table2", "act", "buy")}
    built = build.multi_index(event_cells(spark, folder), specs)
    value = F.coalesce(F.get("doc_first.value_d", F.lit(0)), F.get("doc_second.value_d", F.lit(0)))
    return built.select(
        "index_name", "id", F.col("row_val").alias("row_s"), F.col("family_val").alias("family_s"), value.alias("value")
    )


@query(
    "delete_dispatch",
    f"""WITH {EVENT_CELLS} SELECT seq, {_ID_SQL} AS id,
CASE op WHEN 'DeleteColumn' THEN 'delete_id' WHEN 'DeleteFamily' THEN 'delete_row_family' ELSE 'delete_row' END AS kind,
CASE op WHEN 'DeleteColumn' THEN 'delete_id' WHEN 'DeleteFamily' THEN 'ignored' ELSE 'delete_row' END AS row_only,
CASE op WHEN 'DeleteColumn' THEN 'delete_id' ELSE 'ignored' END AS neither
FROM cells WHERE tbl = 'table1' AND op <> 'Put' AND family IN ('act', 'buy', 'info')""",
)
def delete_dispatch(spark, folder):
    """Deletes by kind, for specs with row and family fields, with one, with none."""
    deletes = changelog.dispatch(event_cells(spark, folder), ALL_FAMILIES).filter(~select.is_put())
    row_only = IndexSpec("table1", ALL_FAMILIES.fields, mapping="column", row_field="row_s")
    neither = IndexSpec("table1", ALL_FAMILIES.fields, mapping="column")
    return deletes.select(
        "seq", "id", "kind",
        changelog.change_kind(row_only).alias("row_only"), changelog.change_kind(neither).alias("neither"),
    )


# Row mode


NEVER_ACT = IndexSpec("table1", [FieldSpec("v", "act:*", type="double"), FieldSpec("q", "act:*", source="qualifier")], read_row="never")
DYNAMIC_ACT = IndexSpec("table1", NEVER_ACT.fields)


def _row_docs(changes):
    return changes.select(
        "kind", "id", "part",
        F.coalesce(F.array_join("doc.q", "|"), F.lit("")).alias("q"),
        F.coalesce(money(F.col("doc.v")), F.lit("")).alias("v"),
    )


@query(
    "row_index_never",
    f"""WITH {EVENT_CELLS}, last AS (
  SELECT row_key, max_by(family, seq) AS family, max_by(qualifier, seq) AS qualifier, max_by(value, seq) AS value,
         max_by(op, seq) AS op FROM cells WHERE tbl = 'table1' AND (family = 'act' OR op <> 'Put') GROUP BY 1)
SELECT CASE WHEN op = 'Put' THEN 'upsert' ELSE 'delete_id' END AS kind, row_key AS id, CAST(0 AS BIGINT) AS part,
CASE WHEN op = 'Put' THEN qualifier ELSE '' END AS q,
CASE WHEN op = 'Put' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) ELSE '' END AS v FROM last""",
)
def row_index_never(spark, folder):
    return _row_docs(build.row_changes(event_cells(spark, folder), NEVER_ACT))


@query(
    "row_index_dynamic",
    f"""WITH {LIVE_CELLS}, touched AS (
  SELECT DISTINCT row_key FROM cells WHERE tbl = 'table1' AND (family = 'act' OR op <> 'Put'))
SELECT CASE WHEN count(l.qualifier) > 0 THEN 'upsert' ELSE 'delete_id' END AS kind, t.row_key AS id, CAST(0 AS BIGINT) AS part,
coalesce(string_agg(l.qualifier, '|' ORDER BY l.qualifier), '') AS q,
coalesce(string_agg(CAST(CAST(l.value AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY l.qualifier), '') AS v
FROM touched t LEFT JOIN (SELECT * FROM live WHERE tbl = 'table1' AND family = 'act') l USING (row_key) GROUP BY 2""",
)
def row_index_dynamic(spark, folder):
    cells = event_cells(spark, folder)
    source = cut_lineage(reduce.live_cells(cells), "source")  # stands for the source table on disk
    return _row_docs(build.row_changes(cells, DYNAMIC_ACT, source))


@query("row_index_never_reordered", registry.SQL["row_index_never"])
def row_index_never_reordered(spark, folder):
    """Event numbers fall while ``seq`` rises: the order is that of ``seq``."""
    cells = event_cells(spark, folder).withColumn("event_id", -F.col("event_id"))
    return _row_docs(build.row_changes(cells, NEVER_ACT))


EXACT_ACT = IndexSpec("table1", [FieldSpec("v", "act:q7", type="double"), FieldSpec("q", "act:q7")])


@query(
    "row_index_dynamic_exact",
    f"""WITH {LIVE_CELLS}, touched AS (
  SELECT row_key, max_by(op, seq) AS op, max_by(value, seq) AS own FROM cells
  WHERE tbl = 'table1' AND ((family = 'act' AND qualifier = 'q7') OR op <> 'Put') GROUP BY 1)
SELECT CASE WHEN coalesce(CASE WHEN t.op = 'Put' THEN t.own END, l.value) IS NULL THEN 'delete_id' ELSE 'upsert' END AS kind,
row_key AS id, CAST(0 AS BIGINT) AS part, t.op = 'Put' AS alone,
coalesce(CAST(CAST(coalesce(CASE WHEN t.op = 'Put' THEN t.own END, l.value) AS DECIMAL(18,2)) AS VARCHAR), '') AS v
FROM touched t LEFT JOIN (SELECT row_key, value FROM live WHERE tbl = 'table1' AND family = 'act' AND qualifier = 'q7') l
USING (row_key)""",
)
def row_index_dynamic_exact(spark, folder):
    """An exact column: an event that puts it is mapped alone, other rows are read again."""
    cells = event_cells(spark, folder)
    source = cut_lineage(reduce.live_cells(cells), "source")
    docs = build.row_changes(cells, EXACT_ACT, source)
    alone = build.touched_rows(cells, EXACT_ACT).select(F.col("row_key").cast("string").alias("id"), F.col("complete").alias("alone"))
    return docs.join(alone, "id").select("kind", "id", "part", "alone", F.coalesce(money(F.col("doc.v")), F.lit("")).alias("v"))


@query(
    "row_index_late",
    f"""WITH {LIVE_CELLS} SELECT row_key AS id, CAST(0 AS BIGINT) AS part, string_agg(qualifier, '|' ORDER BY qualifier) AS q,
string_agg(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY qualifier) AS v
FROM live WHERE tbl = 'table1' AND family = 'act' GROUP BY 1""",
)
def row_index_late(spark, folder):
    """Two batches in the wrong order end with the documents of a full build."""
    cells, middle = event_cells(spark, folder), _middle(spark, folder)
    source = cut_lineage(reduce.live_cells(cells), "source")
    index = IndexTable(spark, work_dir(spark, "late"), DYNAMIC_ACT)
    index.write_batch(build.changes(cells.filter(F.col("seq") >= middle), DYNAMIC_ACT, source), 0)
    index.write_batch(build.changes(cells.filter(F.col("seq") < middle), DYNAMIC_ACT, source), 1)
    return index.documents().select("id", "part", F.array_join("q", "|").alias("q"), money(F.col("v")).alias("v"))


# Changes applied to an index


def _middle(spark, folder) -> int:
    """The event number that cuts the log in two halves."""
    return (table(spark, folder, "events").agg(F.max("event_id")).first()[0] + 1) // 2


_HALF_SQL = "(SELECT (max(event_id) + 1) // 2 FROM events)"


@query("apply_changelog", f"WITH {LIVE_CELLS} {_LIVE_DOCS}")
def apply_changelog(spark, folder):
    """State of the first half of the log, stored, then the second half applied."""
    cells = event_cells(spark, folder)
    middle = _middle(spark, folder)
    first = changelog.column_changes(cells.filter(F.col("seq") < middle), ALL_FAMILIES)
    state = cut_lineage(changelog.fold(first), "state")
    second = changelog.column_changes(cells.filter(F.col("seq") >= middle), ALL_FAMILIES)
    second = cut_lineage(second, "changes")
    applied = changelog.apply_changes(state, second, docs_only=True)
    return flat(changelog.documents(applied, ALL_FAMILIES))


_FEW = "CAST(substr(row_key, 3) AS INTEGER) % 50 = 3"


@query(
    "compact_touched",
    f"""WITH {EVENT_CELLS.replace("cells AS", "every AS")},
cells AS (SELECT * FROM every WHERE seq < {_HALF_SQL} OR {_FEW}), {LIVE_CELLS[len(EVENT_CELLS) + 2:]} {_LIVE_DOCS}""",
)
def compact_touched(spark, folder):
    """A base of the first half, then changes of a few rows, folded into the buckets of these rows alone."""
    cells, middle = event_cells(spark, folder), _middle(spark, folder)
    index = IndexTable(spark, work_dir(spark, "touched"), ALL_FAMILIES)
    index.write_batch(build.changes(cells.filter(F.col("seq") < middle), ALL_FAMILIES), 0)
    index.compact()
    few = F.substring(F.col("row_key").cast("string"), 3, 20).cast("int") % 50 == 3
    index.write_batch(build.changes(cells.filter((F.col("seq") >= middle) & few), ALL_FAMILIES), 1)
    index.compact()
    return flat(index.documents())


_STEP_SQL = f"""{EVENT_CELLS},
old AS (SELECT {_ID_SQL} AS id, row_key AS row_s, family AS family_s, max_by(value, seq) AS value FROM cells
        WHERE op = 'Put' AND tbl = 'table1' AND seq < {_HALF_SQL} GROUP BY row_key, family, qualifier),
late AS (SELECT *, {_ID_SQL} AS id FROM cells WHERE tbl = 'table1' AND seq >= {_HALF_SQL})"""


def _step(spark, folder):
    """Documents put in the first half of the log, and the cells of the second half."""
    cells = event_cells(spark, folder)
    middle = _middle(spark, folder)
    changes = changelog.dispatch(cells, ALL_FAMILIES)
    early = changes.filter(select.is_put() & (F.col("seq") < middle))
    old = reduce.last_by(early.select("id", "row_val", "family_val", "family", "qualifier", "value", "seq"), ["id"])
    return _as_docs(old), changes.filter(F.col("seq") >= middle)


def _as_docs(cells):
    from cellindex.operators.mapping import map_cells

    docs = map_cells(cells, ALL_FAMILIES)
    return flat(docs.withColumnsRenamed({"row_val": "row_s", "family_val": "family_s"}))


@query(
    "apply_upsert",
    f"""WITH {_STEP_SQL}, new AS (
  SELECT id, row_key AS row_s, family AS family_s, max_by(value, seq) AS value FROM late WHERE op = 'Put'
  GROUP BY 1, 2, 3)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE id NOT IN (SELECT id FROM new)""",
)
def apply_upsert(spark, folder):
    old, late = _step(spark, folder)
    puts = late.filter(select.is_put())
    new = reduce.last_by(puts.select("id", "row_val", "family_val", "family", "qualifier", "value", "seq"), ["id"])
    return changelog.upsert(old, _as_docs(new))


@query(
    "apply_delete_id",
    f"WITH {_STEP_SQL} SELECT * FROM old WHERE id NOT IN (SELECT id FROM late WHERE op = 'DeleteColumn')",
)
def apply_delete_id(spark, folder):
    old, late = _step(spark, folder)
    return changelog.delete_ids(old, late.filter(F.col("kind") == changelog.DELETE_ID))


@query(
    "apply_delete_row",
    f"WITH {_STEP_SQL} SELECT * FROM old WHERE row_s NOT IN (SELECT row_key FROM late WHERE op = 'DeleteRow')",
)
def apply_delete_row(spark, folder):
    old, late = _step(spark, folder)
    rows = late.filter(F.col("kind") == changelog.DELETE_ROW).select(F.col("row_val").alias("row_s"))
    return changelog.delete_rows(old, rows, "row_s")


@query(
    "apply_delete_family",
    f"""WITH {_STEP_SQL} SELECT * FROM old WHERE NOT EXISTS (
  SELECT 1 FROM late WHERE op = 'DeleteFamily' AND row_key = row_s AND family = family_s)""",
)
def apply_delete_family(spark, folder):
    old, late = _step(spark, folder)
    pairs = late.filter(F.col("kind") == changelog.DELETE_ROW_FAMILY).select(
        F.col("row_val").alias("row_s"), F.col("family_val").alias("family_s")
    )
    return changelog.delete_families(old, pairs, "row_s", "family_s")


@query(
    "spec_change",
    f"""WITH {EVENT_CELLS.replace("cells AS", "every AS")},
cells AS (SELECT * FROM every WHERE family = 'act' OR (family = 'buy' AND seq >= {_HALF_SQL})),
{LIVE_CELLS[len(EVENT_CELLS) + 2:]} {_LIVE_DOCS}""",
)
def spec_change(spark, folder):
    """A second family joins the spec halfway; earlier events of it are not indexed."""
    middle = _middle(spark, folder)
    old, new = _families("table1", "act"), _families("table1", "act", "buy")
    cells = event_cells(spark, folder)
    seen = cells.filter(build.versioned_relevance([(old, None, middle), (new, middle, None)]))
    return flat(build.column_index(seen, new))


# Reads and checks


@query("index_count", f"WITH {LIVE_CELLS} SELECT count(*) AS n FROM live WHERE tbl = 'table1'")
def index_count(spark, folder):
    return column_index(spark, folder).agg(F.count(F.lit(1)).alias("n"))


@query(
    "index_lookup",
    f"""WITH {ORDER_CELLS} SELECT h.row_key AS id FROM heads h
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def index_lookup(spark, folder):
    """Two terms on one multi-valued field, one on another."""
    docs = cut_lineage(build.bulk_build(order_cells(spark, folder), ORDER_DOC), "index")
    labelled = lookup.find(docs, {"labels": "F", "rush": "yes"})
    return labelled.select("id")


@query(
    "index_lookup_pruned",
    f"""WITH {ORDER_CELLS}, top AS (SELECT max(o_totalprice) AS most, max(row_key) AS last FROM heads)
SELECT 'labels' AS sought, row_key AS id, o_orderpriority AS first_label FROM heads
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
UNION ALL SELECT 'total', row_key, o_orderpriority FROM heads, top WHERE o_totalprice = most
UNION ALL SELECT 'id', row_key, o_orderpriority FROM heads, top WHERE row_key = last""",
)
def index_lookup_pruned(spark, folder):
    """Many documents by two terms, few by a rare one, and one by its id, from a layout for lookups."""
    path = work_dir(spark, "lookups")
    reads.write(build.bulk_build(order_cells(spark, folder), ORDER_DOC), path, ["labels", "rush", "total"], buckets=64)
    orders = table(spark, folder, "orders")
    top = orders.agg(F.max("o_totalprice").alias("most"), F.max(F.concat(F.lit("o-"), F.col("o_orderkey").cast("string"))).alias("last")).first()
    sought = {"labels": {"labels": "F", "rush": "yes"}, "total": {"total": float(top["most"])}, "id": {"id": top["last"]}}
    found = [
        reads.find(spark, path, wanted).select(F.lit(name).alias("sought"), "id", F.get("labels", F.lit(0)).alias("first_label"))
        for name, wanted in sought.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


_TYPED_SQL = """raw AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id, event_type, value FROM events),
checked AS (
  SELECT event_id, user_id, k, event_type, value,
    CASE WHEN event_type = 'error' THEN 'k_i: not a int'
         WHEN k % 10 = 3 THEN 'k_i: more than one value'
         WHEN k = 50 THEN 'value_d: not a double' END AS error FROM raw)"""

TYPED_FIELDS = ("k_i", "type_s", "tags_ss", "user_l", "value_d", "value_f")


@stored("string-docs")
def _string_docs(spark, folder):
    """Documents of strings, some of which do not fit the types of their names."""
    k, kind = event_key(), F.col("event_type")
    number = k.cast("string")
    ks = F.when(kind == "error", F.array(F.concat(F.lit("k"), number))).when(
        k % 10 == 3, F.array(number, number)
    ).otherwise(F.array(number))
    return spread(table(spark, folder, "events")).select(
        "event_id",
        ks.alias("k_i"),
        F.array(kind).alias("type_s"),
        F.array(kind, number).alias("tags_ss"),
        F.array(F.col("user_id").cast("string")).alias("user_l"),
        F.array(F.when(k == 50, F.lit("none")).otherwise(F.col("value").cast("string"))).alias("value_d"),
        F.array().cast("array<string>").alias("value_f"),
    )


@query(
    "typed_projection",
    f"""WITH {_TYPED_SQL} SELECT event_id, k AS k_i, event_type AS type_s,
event_type || '|' || CAST(k AS VARCHAR) AS tags_ss, user_id AS user_l, value AS value_d,
CAST(NULL AS DOUBLE) AS value_f FROM checked WHERE error IS NULL""",
)
def typed_projection(spark, folder):
    docs = lookup.accepted(lookup.typed(_string_docs(spark, folder), TYPED_FIELDS))
    return docs.select(
        "event_id", "k_i", "type_s", F.array_join("tags_ss", "|").alias("tags_ss"), "user_l", "value_d",
        F.col("value_f").cast("double").alias("value_f"),
    )


@query("quarantine_docs", f"WITH {_TYPED_SQL} SELECT event_id, error FROM checked WHERE error IS NOT NULL")
def quarantine_docs(spark, folder):
    docs = lookup.typed(_string_docs(spark, folder), TYPED_FIELDS)
    return lookup.quarantined(docs).select("event_id", "error")


@query(
    "build_report",
    f"""WITH {_TYPED_SQL}, runs AS (SELECT 'events' AS run, error FROM checked
  UNION ALL SELECT 'orders', NULL FROM orders)
SELECT run, count(*) AS records_in, count(error) AS records_failed,
CASE WHEN count(error) = 0 THEN 'FINISHED' ELSE 'FINISHED_WITH_ERRORS' END AS state, count(error) = 0 AS success
FROM runs GROUP BY 1""",
)
def build_report(spark, folder):
    events = lookup.typed(_string_docs(spark, folder), TYPED_FIELDS).select(F.lit("events").alias("run"), "error")
    orders = table(spark, folder, "orders").select(
        F.array(F.col("o_totalprice").cast("string")).alias("total_d")
    )
    orders = lookup.typed(orders, ["total_d"]).select(F.lit("orders").alias("run"), "error")
    return metrics.build_report(events.unionByName(orders))


@query(
    "snapshot_diff",
    f"""WITH {LIVE_CELLS}, every AS (SELECT tbl, row_key, family, qualifier, seq, {_ID_SQL} AS id FROM live),
early AS (SELECT * FROM cells WHERE seq < {_HALF_SQL}),
half AS (
  SELECT l.row_key, l.family, l.qualifier, l.seq, {_ID_SQL} AS id FROM (
    SELECT row_key, family, qualifier, max(seq) AS seq, max_by(op, seq) AS op FROM early
    WHERE tbl = 'table1' AND op IN ('Put', 'DeleteColumn') GROUP BY 1, 2, 3) l
  LEFT JOIN (SELECT row_key, max(seq) AS s FROM early WHERE tbl = 'table1' AND op = 'DeleteRow' GROUP BY 1) r
    USING (row_key)
  LEFT JOIN (SELECT row_key, family, max(seq) AS s FROM early WHERE tbl = 'table1' AND op = 'DeleteFamily'
             GROUP BY 1, 2) f USING (row_key, family)
  WHERE l.op = 'Put' AND l.seq > coalesce(r.s, -1) AND l.seq > coalesce(f.s, -1))
SELECT coalesce(a.id, b.id) AS id, a.seq AS old_version, b.seq AS new_version,
CASE WHEN a.id IS NULL THEN 'ADDED' WHEN b.id IS NULL THEN 'DELETED' ELSE 'UPDATED' END AS change
FROM half a FULL JOIN (SELECT * FROM every WHERE tbl = 'table1') b ON a.id = b.id
WHERE a.seq IS DISTINCT FROM b.seq""",
)
def snapshot_diff(spark, folder):
    cells = event_cells(spark, folder)
    old = changelog.column_documents(cells.filter(F.col("seq") < _middle(spark, folder)), ALL_FAMILIES)
    new = changelog.column_documents(cells, ALL_FAMILIES)
    return lookup.snapshot_diff(old, new, "id", "seq")


# Documents in parts are judged and compared as wholes.

PIECES = 2
TYPED_ORDER = IndexSpec(
    "orders",
    [
        FieldSpec("lines_ss", "item:*", source="qualifier"),
        FieldSpec("status_s", "info:status"),
        FieldSpec("first_s", "item:01*", source="qualifier"),
    ],
)


@query(
    "typed_projection_parts",
    f"""WITH {ORDER_CELLS} SELECT h.row_key AS id, count(i.qualifier) AS n_lines,
CASE WHEN count(i.qualifier) FILTER (i.qualifier LIKE '01%') > 1 THEN 'first_s: more than one value' END AS error
FROM heads h LEFT JOIN items i USING (row_key) GROUP BY 1""",
)
def typed_projection_parts(spark, folder, max_values=PIECES):
    docs = build.bulk_build(order_cells(spark, folder), TYPED_ORDER, max_values)
    judged = lookup.typed(docs, ["lines_ss", "status_s", "first_s"])
    return judged.groupBy("id").agg(F.sum(F.size("lines_ss")).alias("n_lines"), F.max("error").alias("error"))


@query(
    "snapshot_diff_parts",
    """WITH a AS (SELECT o_orderkey AS k, o_orderkey AS v FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_orderkey AS k, o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS v FROM orders WHERE o_orderkey % 5 <> 0)
SELECT 'o-' || CAST(coalesce(a.k, b.k) AS VARCHAR) AS id, a.v AS old_version, b.v AS new_version,
CASE WHEN a.k IS NULL THEN 'ADDED' WHEN b.k IS NULL THEN 'DELETED' ELSE 'UPDATED' END AS change
FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v""",
)
def snapshot_diff_parts(spark, folder, max_values=PIECES):
    cells = order_cells(spark, folder)

    def snapshot(kept, version):
        rows = mapping.map_rows(kept.withColumn("version", version), TYPED_ORDER, max_values, keep=("version",))
        return rows.select(F.col("row_key").cast("string").alias("id"), "part", "version")

    number = F.col("event_id")
    old = snapshot(cells.filter(number % 3 != 0), number)
    new = snapshot(cells.filter(number % 5 != 0), number + F.when(number % 7 == 0, 1).otherwise(0))
    return lookup.snapshot_diff(old, new, "id", "version")


@query(
    "snapshot_diff_digest",
    """WITH a AS (SELECT o_orderkey AS k, o_orderkey AS v FROM orders WHERE o_orderkey % 997 <> 1),
b AS (SELECT o_orderkey AS k, o_orderkey + CASE WHEN o_orderkey % 991 = 2 THEN 1 ELSE 0 END AS v FROM orders WHERE o_orderkey % 983 <> 3)
SELECT 'o-' || CAST(coalesce(a.k, b.k) AS VARCHAR) AS id, a.v AS old_version, b.v AS new_version,
CASE WHEN a.k IS NULL THEN 'ADDED' WHEN b.k IS NULL THEN 'DELETED' ELSE 'UPDATED' END AS change
FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v""",
)
def snapshot_diff_digest(spark, folder):
    """Two stored snapshots of all orders, of which few differ."""
    number = F.col("o_orderkey")
    docs = table(spark, folder, "orders").select(F.concat(F.lit("o-"), number.cast("string")).alias("id"), number, number.alias("version"))
    old = cut_lineage(docs.filter(number % 997 != 1), "old")
    newer = docs.withColumn("version", number + F.when(number % 991 == 2, 1).otherwise(0))
    new = cut_lineage(newer.filter(number % 983 != 3), "new")
    return lookup.snapshot_diff_digest(old, new, "id", "version")


@query(
    "row_reread_pruned",
    f"""WITH {ORDER_CELLS} SELECT row_key, qualifier FROM order_cells
WHERE family = 'item' AND event_id IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 10)""",
)
def row_reread_pruned(spark, folder):
    """The last ten orders read again from a source table laid out by row."""
    path = work_dir(spark, "by-row")
    write_by_row(order_cells(spark, folder), path, 64, options=without_dictionary("qualifier", "value"))
    last = table(spark, folder, "orders").orderBy(F.desc("o_orderkey")).limit(10)
    touched = cut_lineage(last.select(F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).cast("binary").alias("row_key")), "touched")
    found = build.reread(spark.read.parquet(path), touched, IndexSpec("orders", [FieldSpec("q", "item:*", source="qualifier")]))
    return found.select(F.col("row_key").cast("string").alias("row_key"), F.col("qualifier").cast("string").alias("qualifier"))
