"""Queries: extraction, mapping, merging, text and reductions."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from cellindex.catalog.cells import T1
from cellindex.catalog.registry import EVENT_CELLS, LIVE_CELLS, ORDER_CELLS, money, query, text
from cellindex.functions.decode import decode
from cellindex.operators import mapping, metrics, reduce, select
from cellindex.operators import text as parsing
from cellindex.operators.skew import collect_groups
from cellindex.operators.hooks import RowFold, RowMapper
from cellindex.plans import build
from cellindex.sources.tables import event_cells, event_key, order_cells, page_cells, table
from cellindex.spec import ExtractSpec, FieldSpec, IndexSpec, Target


@query(
    "extract_cell",
    f"""WITH {EVENT_CELLS} SELECT tbl, row_key, max_by(value, seq) AS value FROM cells
WHERE op = 'Put' AND family = 'act' AND qualifier = 'q7' GROUP BY 1, 2""",
)
def extract_cell(spark, folder):
    puts = event_cells(spark, folder).filter(select.is_put())
    latest = reduce.last_by(
        puts.filter(select.matches(Target.parse("act:q7"))).select("tbl", "row_key", "value", "seq"),
        ["tbl", "row_key"],
    )
    return latest.select("tbl", *text("row_key"), F.get(decode(F.col("value"), "double"), F.lit(0)).alias("value"))


def _ordered(cells, source):
    found = mapping.extract(cells, Target.parse("item:0*"), source)
    return collect_groups(found, ["row_key"], ["qualifier"], {"found": (None, F.col("bytes"))})


@query(
    "extract_prefix_values",
    f"""WITH {ORDER_CELLS} SELECT row_key, CAST(0 AS BIGINT) AS part,
string_agg(CAST(CAST(quantity AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY qualifier) AS found
FROM items WHERE qualifier LIKE '0%' GROUP BY row_key""",
)
def extract_prefix_values(spark, folder):
    found = _ordered(order_cells(spark, folder), "value")
    numbers = F.flatten(F.transform("found", lambda b: decode(b, "double")))
    return found.select(*text("row_key"), "part", money(numbers).alias("found"))


@query(
    "extract_prefix_qualifiers",
    f"""WITH {ORDER_CELLS} SELECT row_key, CAST(0 AS BIGINT) AS part, string_agg(qualifier, '|' ORDER BY qualifier) AS found
FROM items WHERE qualifier LIKE '0%' GROUP BY row_key""",
)
def extract_prefix_qualifiers(spark, folder):
    found = _ordered(order_cells(spark, folder), "qualifier")
    names = F.transform("found", lambda b: b.cast("string"))
    return found.select(*text("row_key"), "part", F.array_join(names, "|").alias("found"))


QUANTITIES = IndexSpec("orders", [FieldSpec("quantities", "item:*", type="double")])


@query(
    "map_fields",
    f"""WITH {ORDER_CELLS} SELECT h.row_key, count(i.qualifier) AS n,
coalesce(string_agg(CAST(CAST(quantity AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY qualifier), '') AS quantities
FROM heads h LEFT JOIN items i USING (row_key) GROUP BY 1""",
)
def map_fields(spark, folder):
    """Orders without lines still have the field, as an empty list."""
    docs = mapping.map_rows(order_cells(spark, folder), QUANTITIES)
    return docs.select(
        *text("row_key"), F.size("quantities").cast("bigint").alias("n"), money(F.col("quantities")).alias("quantities")
    )


ORDER_DOC = IndexSpec(
    "orders",
    [
        FieldSpec("labels", "info:priority"),
        FieldSpec("labels", "info:status"),
        FieldSpec("labels", "item:*", source="qualifier"),
        FieldSpec("total", "info:total", type="double"),
        FieldSpec("rush", "info:rush"),
    ],
)

_ORDER_DOC_SQL = """SELECT h.row_key AS {key}, o_orderpriority || '|' || o_orderstatus || coalesce('|' || l.labels, '') AS labels,
CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' ELSE '' END AS rush
FROM heads h LEFT JOIN (
  SELECT row_key, string_agg(qualifier, '|' ORDER BY qualifier) AS labels FROM items GROUP BY 1) l USING (row_key)"""


def _order_doc(docs, key):
    return docs.select(
        key,
        F.array_join("labels", "|").alias("labels"),
        money(F.col("total")).alias("total"),
        F.array_join("rush", "|").alias("rush"),
    )


@query("map_document", f"WITH {ORDER_CELLS} " + _ORDER_DOC_SQL.format(key="row_key"))
def map_document(spark, folder):
    docs = mapping.map_rows(order_cells(spark, folder), ORDER_DOC)
    return _order_doc(docs, *text("row_key"))


@query("bulk_build", f"WITH {ORDER_CELLS} " + _ORDER_DOC_SQL.format(key="id"))
def bulk_build(spark, folder):
    return _order_doc(build.bulk_build(order_cells(spark, folder), ORDER_DOC), "id")


def _show_cells(rows):
    def show(c):
        number = F.get(decode(c["value"], "double"), F.lit(0)).cast("decimal(18,2)").cast("string")
        is_text = (c["family"] == F.lit(b"info")) & (c["qualifier"] != F.lit(b"total"))
        value = F.when(is_text, c["value"].cast("string")).otherwise(number)
        return F.concat(c["family"].cast("string"), F.lit(":"), c["qualifier"].cast("string"), F.lit("="), value)

    return rows.select(
        *text("row_key"), "part", F.size("cells").cast("bigint").alias("n"),
        F.array_join(F.transform("cells", show), "|").alias("cells"),
    )


@query(
    "assemble_row",
    f"""WITH {ORDER_CELLS} SELECT row_key, CAST(0 AS BIGINT) AS part, count(*) AS n,
string_agg(family || ':' || qualifier || '=' || coalesce(txt, CAST(CAST(num AS DECIMAL(18,2)) AS VARCHAR)), '|'
           ORDER BY family, qualifier) AS cells
FROM order_cells GROUP BY 1""",
)
def assemble_row(spark, folder):
    """Whole rows: none of these is long enough to be cut."""
    return _show_cells(mapping.row_view(order_cells(spark, folder)))


# Long rows are cut in parts; a low limit shows it on orders of more than three cells.
PART_SIZE = 3


@query(
    "assemble_parts",
    f"""WITH {ORDER_CELLS}, placed AS (
  SELECT *, (row_number() OVER (PARTITION BY row_key ORDER BY family, qualifier) - 1) AS pos,
         count(*) OVER (PARTITION BY row_key) AS n FROM order_cells)
SELECT row_key, CAST(CASE WHEN n <= {PART_SIZE} THEN 0 ELSE pos // {PART_SIZE} END AS BIGINT) AS part, count(*) AS n,
string_agg(family || ':' || qualifier || '=' || coalesce(txt, CAST(CAST(num AS DECIMAL(18,2)) AS VARCHAR)), '|'
           ORDER BY family, qualifier) AS cells
FROM placed GROUP BY 1, 2""",
)
def assemble_parts(spark, folder):
    return _show_cells(mapping.row_view(order_cells(spark, folder), PART_SIZE))


@query(
    "merge_docs",
    """WITH added AS (
  SELECT c_custkey AS id, '' AS prefix, 'label' AS field, c_name AS value, 0.5 AS boost, 0 AS doc_ord, 0 AS value_ord
  FROM customer
  UNION ALL SELECT c_custkey, '', 'label', c_mktsegment, 0.5, 0, 1 FROM customer
  UNION ALL SELECT o_custkey, '', 'label', o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END,
    1 + o_orderkey, 0 FROM orders
  UNION ALL SELECT o_custkey, 'order_', 'status', o_orderstatus, 1, 1 + o_orderkey, 1 FROM orders)
SELECT id, prefix || field AS field, CAST(0 AS BIGINT) AS part, string_agg(value, '|' ORDER BY doc_ord, value_ord) AS vals,
CAST(product(boost) AS DOUBLE) AS boost FROM added GROUP BY 1, 2""",
)
def merge_docs(spark, folder):
    """Customers as base documents, merged with a document per order."""

    def entries(df, key, doc_ord, *added):
        rows = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(prefix).alias("prefix"), F.lit(field).alias("field"), F.col(value).alias("value"),
                        boost.cast("double").alias("boost"), F.lit(i).alias("value_ord"),
                    )
                    for i, (prefix, field, value, boost) in enumerate(added)
                ]
            )
        )
        return df.select(F.col(key).alias("id"), doc_ord.cast("bigint").alias("doc_ord"), rows.alias("e")).select(
            "id", "doc_ord", "e.*"
        )

    base = entries(
        table(spark, folder, "customer"), "c_custkey", F.lit(0),
        ("", "label", "c_name", F.lit(0.5)), ("", "label", "c_mktsegment", F.lit(0.5)),
    )
    weight = F.when(F.col("o_orderstatus") == "F", 2.0).otherwise(1.0)
    more = entries(
        table(spark, folder, "orders"), "o_custkey", 1 + F.col("o_orderkey"),
        ("", "label", "o_orderpriority", weight), ("order_", "status", "o_orderstatus", F.lit(1.0)),
    )
    merged = mapping.merge_documents(base.unionByName(more))
    return merged.select("id", "field", "part", F.array_join("values", "|").alias("vals"), "boost")


@query(
    "add_key",
    f"""WITH {EVENT_CELLS} SELECT seq, row_key AS custom_id,
replace(row_key, '-', '\\-') || '-' || family || '-' || qualifier AS cell_id FROM cells""",
)
def add_key(spark, folder):
    rows = IndexSpec("table1", T1.fields, key_field="custom_id")
    columns = IndexSpec("table1", T1.fields, mapping="column", key_field="cell_id")
    cells = mapping.add_key(mapping.add_key(event_cells(spark, folder), rows), columns)
    return cells.select("seq", "custom_id", "cell_id")


@query(
    "add_row_family",
    f"WITH {EVENT_CELLS} SELECT seq, row_key AS row_s, family AS family_s, lower(hex(row_key)) AS row_hex FROM cells",
)
def add_row_family(spark, folder):
    both = IndexSpec("table1", T1.fields, mapping="column", row_field="row_s", family_field="family_s")
    row_only = IndexSpec("table1", T1.fields, mapping="column", row_field="row_hex", key_format="hex")
    cells = mapping.add_row_and_family(event_cells(spark, folder), both)
    return mapping.add_row_and_family(cells, row_only).select("seq", "row_s", "family_s", "row_hex")


# Text


PAGES = ExtractSpec("content:*", prefix="page_", type="text/html")


#: What the parser reads from these pages, said in patterns: hidden elements go, breaking ones end lines, entities are few.
_TEXT_SQL = r"""WITH bare AS (
  SELECT page_id, url, html LIKE '%<title>%' AS titled,
    trim(regexp_replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&quot;', '"'), '&amp;?', '&', 'g')) AS title,
    regexp_replace(
      regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>|<title>.*?</title>', '', 'g'),
      '</?(address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)( [^>]*)?>',
      chr(10), 'g') AS x
  FROM pages WHERE html IS NOT NULL),
plain AS (
  SELECT page_id, url, titled, title, regexp_replace(replace(replace(replace(regexp_replace(x, '</?[a-zA-Z!][^>]*>', '', 'g'),
    '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;?', '&', 'g') AS x FROM bare),
lined AS (
  SELECT page_id, url, titled, title, array_to_string(list_filter(list_transform(string_split(x, chr(10)),
    lambda line: trim(regexp_replace(line, '\s+', ' ', 'g'))), lambda line: line <> ''), chr(10)) AS content FROM plain)
SELECT url AS row_key, CAST(page_id AS VARCHAR) AS qualifier, 0 AS ord, 'page_title' AS field, title AS value FROM lined WHERE titled
UNION ALL SELECT url, CAST(page_id AS VARCHAR), CAST(titled AS INTEGER), 'page_content', content FROM lined"""


@query("extract_text", _TEXT_SQL)
def extract_text(spark, folder):
    fields = parsing.extract_fields(page_cells(spark, folder), PAGES, ("row_key", "qualifier"))
    return parsing.accepted(fields).select(*text("row_key", "qualifier"), "ord", "field", "value")


@query(
    "extract_title",
    """SELECT page_id, trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&')) AS title
FROM pages WHERE html LIKE '%<title>%'""",
)
def extract_title(spark, folder):
    """The title as the parser reads it; ampersands are the only entities in these titles."""
    fields = parsing.extract_fields(page_cells(spark, folder), PAGES, ("qualifier",))
    titles = fields.filter(F.col("field") == "page_title")
    return titles.select(F.col("qualifier").cast("string").cast("bigint").alias("page_id"), F.col("value").alias("title"))


@query(
    "extract_schema",
    """SELECT page_id, 'p_title_txt' AS field, trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&')) AS value
FROM pages WHERE html LIKE '%<title>%'""",
)
def extract_schema(spark, folder):
    """Only fields that the index schema knows: the title is renamed to one, the content has no place."""
    params = {"lowernames": "true", "fmap.title": "title_txt"}
    known = ExtractSpec("content:*", prefix="p_", type="text/html", params=params, schema_fields=())
    fields = parsing.extract_fields(page_cells(spark, folder), known, ("qualifier",))
    return fields.select(F.col("qualifier").cast("string").cast("bigint").alias("page_id"), "field", "value")


def first_heading(html: str):
    """A parser of the user: the first heading only."""
    start = html.find("<h1>")
    return [("First Heading", html[start + 4 : html.find("</h1>", start)])] if start >= 0 else []


@query(
    "udf_parser",
    """SELECT page_id, 'h_first_heading' AS field, regexp_extract(html, '<h1>((?s).*?)</h1>', 1) AS value
FROM pages WHERE html LIKE '%<h1>%'""",
)
def udf_parser(spark, folder):
    own = ExtractSpec("content:*", prefix="h_", type="text/html", params={"parsers": {"text/html": first_heading}, "lowernames": "true", "fmap.content_type": "ignored_field"})
    fields = parsing.extract_fields(page_cells(spark, folder), own, ("qualifier",))
    return fields.select(F.col("qualifier").cast("string").cast("bigint").alias("page_id"), "field", "value")


# Strips white space and comments first, then looks at the name that opens the text.
_SNIFF_SQL = """CASE WHEN content = '' THEN 'application/octet-stream'
WHEN regexp_matches(lower(regexp_replace(content, '^([ \\t\\r\\n]|<!--([^-]|-[^-])*-->)*', '')), '^<(!doctype[ \\t\\r\\n]+html|html|head|body)([^a-z0-9_]|$)')
  THEN 'text/html'
WHEN lower(regexp_replace(content, '^([ \\t\\r\\n]|<!--([^-]|-[^-])*-->)*', '')) LIKE '<?xml%' THEN 'application/xml'
ELSE 'text/plain' END"""


@query(
    "detect_type",
    f"""WITH inputs AS (
  SELECT 'p' || CAST(page_id AS VARCHAR) AS item,
         CASE page_id % 4 WHEN 1 THEN chr(10) || html WHEN 3 THEN '<!-- two' || chr(10) || 'lines -->' || html ELSE html END AS content,
         CASE WHEN page_id % 2 = 0 THEN 'Text/HTML; charset=utf-8' ELSE 'not a type' END AS declared FROM pages
  UNION ALL SELECT 'd' || CAST(doc_id AS VARCHAR), text,
         CASE WHEN doc_id % 3 = 0 THEN 'application/pdf' ELSE 'text' END FROM documents)
SELECT item, CASE WHEN declared = 'application/pdf' THEN declared WHEN declared LIKE 'Text/HTML%' THEN 'text/html'
ELSE {_SNIFF_SQL} END AS mime FROM inputs""",
)
def detect_type(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("p"), F.col("page_id")).alias("item"),
        F.when(F.col("page_id") % 4 == 1, F.concat(F.lit("\n"), "html"))
        .when(F.col("page_id") % 4 == 3, F.concat(F.lit("<!-- two\nlines -->"), "html"))
        .otherwise(F.col("html"))
        .alias("content"),
        F.when(F.col("page_id") % 2 == 0, "Text/HTML; charset=utf-8").otherwise("not a type").alias("declared"),
    )
    documents = table(spark, folder, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("item"), F.col("text").alias("content"),
        F.when(F.col("doc_id") % 3 == 0, "application/pdf").otherwise("text").alias("declared"),
    )
    inputs = pages.unionByName(documents)
    return inputs.select("item", parsing.media_type(F.col("declared"), F.col("content")).alias("mime"))


@query(
    "remap_fields",
    """WITH named AS (
  SELECT event_id, CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 WHEN 0 THEN 'Content-Type'
    WHEN 1 THEN 'Content-Encoding' WHEN 2 THEN 'dc:Title' WHEN 3 THEN 'X Parsed.By' ELSE 'author' END AS field,
  event_type AS value FROM events),
lowered AS (SELECT event_id, lower(regexp_replace(field, '[^A-Za-z0-9]', '_', 'g')) AS field, value FROM named)
SELECT * FROM lowered WHERE field NOT IN ('content_type', 'content_encoding')""",
)
def remap_fields(spark, folder):
    # Sample field names as parsers report them.
    names = F.array(*map(F.lit, ("Content-Type", "Content-Encoding", "dc:Title", "X Parsed.By", "author")))
    events = table(spark, folder, "events")
    fields = events.select("event_id", names[event_key() % 5].alias("field"), F.col("event_type").alias("value"))
    renamed = parsing.normalise(F.col("field"), parsing.effective_params({}))
    return fields.withColumn("field", renamed).filter("field IS NOT NULL")


# Reductions and counters


@query(
    "last_event_per_row",
    f"""WITH {EVENT_CELLS} SELECT row_key, max(seq) AS event_id FROM cells
WHERE tbl = 'table1' AND (family = 'act' OR op <> 'Put') GROUP BY 1""",
)
def last_event_per_row(spark, folder):
    return reduce.last_event_per_row(event_cells(spark, folder), T1).select(*text("row_key"), "event_id")


@query(
    "last_cell_per_id",
    f"""WITH {EVENT_CELLS} SELECT replace(row_key, '-', '\\-') || '-' || family || '-' || qualifier AS id,
max(seq) AS seq, max_by(op, seq) AS op, max_by(value, seq) AS value
FROM cells WHERE tbl = 'table1' AND family = 'act' GROUP BY 1""",
)
def last_cell_per_id(spark, folder):
    last = reduce.last_cell_per_id(event_cells(spark, folder), T1)
    return last.select("id", "seq", "op", F.get(decode(F.col("value"), "double"), F.lit(0)).alias("value"))


@query(
    "run_metrics",
    f"""WITH {EVENT_CELLS}, own AS (SELECT * FROM cells WHERE tbl = 'table1'),
per_id AS (SELECT row_key, family, qualifier, max_by(op, seq) AS op FROM own
           WHERE op IN ('Put', 'DeleteColumn') GROUP BY 1, 2, 3),
counted AS (SELECT
  (SELECT count(*) FROM cells) AS incoming_events, (SELECT count(*) FROM own) AS applicable_events,
  (SELECT count(*) FROM per_id WHERE op = 'Put') AS adds,
  (SELECT count(*) FROM per_id WHERE op <> 'Put') AS deletes_by_id,
  (SELECT count(DISTINCT row_key) FROM own WHERE op = 'DeleteRow')
    + (SELECT count(*) FROM (SELECT DISTINCT row_key, family FROM own WHERE op = 'DeleteFamily')) AS deletes_by_query,
  0 AS ignored, 0 AS bad_values, 0 AS document_errors)
SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def run_metrics(spark, folder):
    from cellindex.catalog.indexes import ALL_FAMILIES
    from cellindex.operators.changelog import column_changes

    cells = event_cells(spark, folder)
    events = metrics.as_rows(metrics.event_counters(cells, ALL_FAMILIES))
    return events.unionByName(metrics.as_rows(metrics.change_counters(column_changes(cells, ALL_FAMILIES))))


@query(
    "run_metrics_faults",
    f"""WITH {EVENT_CELLS}, own AS (SELECT * FROM cells WHERE tbl = 'table1'), act AS (SELECT * FROM own WHERE family = 'act'),
per_id AS (SELECT row_key, qualifier, max_by(op, seq) AS op FROM act WHERE op IN ('Put', 'DeleteColumn') GROUP BY 1, 2),
counted AS (SELECT
  (SELECT count(*) FROM cells) AS incoming_events, (SELECT count(*) FROM own) AS applicable_events,
  (SELECT count(*) FROM per_id WHERE op = 'Put') AS adds, (SELECT count(*) FROM per_id WHERE op <> 'Put') AS deletes_by_id,
  0 AS deletes_by_query, (SELECT count(*) FROM act WHERE op IN ('DeleteRow', 'DeleteFamily')) AS ignored,
  (SELECT count(*) FROM act WHERE op = 'Put') AS bad_values, 0 AS document_errors)
SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def run_metrics_faults(spark, folder):
    """Values that do not fit their type, and deletes that a spec without row field cannot express."""
    from cellindex.operators.changelog import column_changes

    spec = IndexSpec("table1", [FieldSpec("flag", "act:*", type="boolean")], mapping="column")
    cells = event_cells(spark, folder)
    events = metrics.as_rows(metrics.event_counters(cells, spec))
    return events.unionByName(metrics.as_rows(metrics.change_counters(column_changes(cells, spec))))


# A row mapper of the user.


def summarise(piece):
    names = [bytes(cell["qualifier"]).decode() for cell in piece]
    return {"n_cells": len(piece), "first": names[0], "last": names[-1]}


SUMMARY = IndexSpec(
    "orders",
    row_mapper=RowMapper(
        summarise,
        "n_cells BIGINT, first STRING, last STRING",
        ("item:*",),
        max_values=2,  # nearly every order comes in pieces
        merge={"n_cells": "sum", "first": "first", "last": "last"},
    ),
)


@query(
    "udf_row_mapper",
    f"""WITH {ORDER_CELLS} SELECT row_key AS id, CAST(0 AS BIGINT) AS part, count(*) AS n_cells, min(qualifier) AS first,
max(qualifier) AS last FROM items GROUP BY 1""",
)
def udf_row_mapper(spark, folder):
    return build.bulk_build(order_cells(spark, folder), SUMMARY)


def add_line(state, cell):
    n, rises, first, last = state
    quantity = struct.unpack(">d", cell["value"])[0]
    return n + 1, rises + (last is not None and quantity > last), first or cell["qualifier"].decode(), quantity


FOLDED = IndexSpec(
    "orders",
    row_mapper=RowFold(
        lambda: (0, 0, None, None),
        add_line,
        lambda s: {"n_cells": s[0], "rises": s[1], "first": s[2], "last": s[3]},
        "n_cells BIGINT, rises BIGINT, first STRING, last DOUBLE",
        ("item:*",),
    ),
)


@query(
    "udf_row_fold",
    f"""WITH {ORDER_CELLS}, steps AS (
  SELECT *, quantity > lag(quantity) OVER (PARTITION BY row_key ORDER BY qualifier) AS rise FROM items)
SELECT row_key AS id, CAST(0 AS BIGINT) AS part, count(*) AS n_cells, count(*) FILTER (rise) AS rises, min(qualifier) AS first,
arg_max(quantity, qualifier) AS last FROM steps GROUP BY 1""",
)
def udf_row_fold(spark, folder):
    """A mapper that needs the cells of a row one after another and in order."""
    return build.bulk_build(order_cells(spark, folder), FOLDED)


def describe(cells, params):
    """A mapper of single cells, with a parameter of the spec."""
    return {"label": params["before"] + bytes(cells[0]["qualifier"]).decode()}


@query(
    "udf_cell_mapper",
    f"""WITH {EVENT_CELLS.replace("cells AS", "every AS")},
cells AS (SELECT * FROM every WHERE family IN ('act', 'buy')), {LIVE_CELLS[len(EVENT_CELLS) + 2:]}
SELECT replace(row_key, '-', '\\-') || '-' || family || '-' || qualifier AS id,
row_key AS row_s, family AS family_s, 'cell ' || qualifier AS label FROM live WHERE tbl = 'table1'""",
)
def udf_cell_mapper(spark, folder):
    """Column mode with a row mapper: each live cell is mapped, deletes of rows and families apply."""
    mapper = RowMapper(describe, "label STRING", ("act:*", "buy:*"))
    spec = IndexSpec(
        "table1", mapping="column", row_mapper=mapper, row_field="row_s", family_field="family_s", params={"before": "cell "}
    )
    return build.column_index(event_cells(spark, folder), spec)
