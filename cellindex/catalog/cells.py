"""Queries: sources, filters, keys and value decoding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.catalog.registry import EVENT_CELLS, ORDER_CELLS, query, text
from cellindex.functions.decode import decode, register_decoder
from cellindex.functions.encode import string_bytes
from cellindex.functions.keys import HEX, STRING
from cellindex.operators import select
from cellindex.plans import build
from cellindex.sources.tables import event_cells, event_key, order_cells, spread, stored, table
from cellindex.spec import FieldSpec, IndexSpec, Target

COORDINATES = ("row_key", "family", "qualifier")


def _shown(cells: DataFrame) -> DataFrame:
    return cells.select("seq", *text(*COORDINATES))


def _value(values: Column) -> Column:
    return F.get(values, F.lit(0))


@query(
    "src_cells",
    f"WITH {EVENT_CELLS} SELECT seq, epoch_us(ts) AS ts_us, tbl, row_key, family, qualifier, value, op FROM cells",
)
def src_cells(spark, folder):
    cells = event_cells(spark, folder)
    micros = F.unix_micros(F.col("ts"))
    return cells.select(
        "seq", micros.alias("ts_us"), "tbl", *text(*COORDINATES),
        _value(decode(F.col("value"), "double")).alias("value"), "op",
    )


REREAD = IndexSpec("orders", [FieldSpec("status", "info:status"), FieldSpec("lines", "item:01*", type="double")])


@query(
    "row_reread",
    f"""WITH {ORDER_CELLS}
SELECT row_key, family, qualifier, coalesce(txt, CAST(CAST(num AS DECIMAL(18,2)) AS VARCHAR)) AS value
FROM order_cells WHERE row_key IN (SELECT row_key FROM heads WHERE o_orderpriority = '2-HIGH')
AND ((family = 'info' AND qualifier = 'status') OR (family = 'item' AND qualifier LIKE '01%'))""",
)
def row_reread(spark, folder):
    cells = order_cells(spark, folder)
    touched = cells.filter(
        select.matches(Target.parse("info:priority")) & (F.col("value") == F.lit(b"2-HIGH"))
    ).select("row_key")
    found = build.reread(cells, touched, REREAD)
    number = _value(decode(F.col("value"), "double")).cast("decimal(18,2)").cast("string")
    shown = F.when(F.col("family") == F.lit(b"item"), number).otherwise(F.col("value").cast("string"))
    return found.select(*text(*COORDINATES), shown.alias("value"))


T1 = IndexSpec("table1", [FieldSpec("v", "act:*", type="double")], mapping="column")
MIXED = IndexSpec(
    "table1",
    [FieldSpec("a", "act:q1*"), FieldSpec("b", "buy:q5"), FieldSpec("c", "info:*", source="qualifier")],
    mapping="column",
)
_SHOWN = "SELECT seq, row_key, family, qualifier FROM cells"
_MIXED_SQL = (
    "((family = 'act' AND qualifier LIKE 'q1%') OR (family = 'buy' AND qualifier = 'q5') OR family = 'info')"
)


@query("filter_table", f"WITH {EVENT_CELLS} {_SHOWN} WHERE tbl = 'table1'")
def filter_table(spark, folder):
    return _shown(event_cells(spark, folder).filter(select.of_table(T1)))


@query("filter_column", f"WITH {EVENT_CELLS} {_SHOWN} WHERE family = 'act' AND qualifier = 'q17'")
def filter_column(spark, folder):
    return _shown(event_cells(spark, folder).filter(select.matches(Target.parse("act:q17"))))


@query("filter_prefix", f"WITH {EVENT_CELLS} {_SHOWN} WHERE family = 'act' AND qualifier LIKE 'q1%'")
def filter_prefix(spark, folder):
    return _shown(event_cells(spark, folder).filter(select.matches(Target.parse("act:q1*"))))


@query("filter_subscription", f"WITH {EVENT_CELLS} {_SHOWN} WHERE ts > TIMESTAMP '2024-01-12 00:00:00'")
def filter_subscription(spark, folder):
    cutoff = F.timestamp_seconds(F.lit(1705017600))  # 2024-01-12 00:00:00 UTC
    return _shown(event_cells(spark, folder).filter(select.after(cutoff)))


@query("filter_relevant", f"WITH {EVENT_CELLS} {_SHOWN} WHERE tbl = 'table1' AND {_MIXED_SQL}")
def filter_relevant(spark, folder):
    cells = event_cells(spark, folder)
    return _shown(cells.filter(select.of_table(MIXED)).filter(select.relevant(MIXED)))


@query(
    "filter_row_event",
    f"""WITH {EVENT_CELLS} SELECT seq AS event_id, row_key, family = 'act' OR op <> 'Put' AS is_relevant
FROM cells WHERE tbl = 'table1'""",
)
def filter_row_event(spark, folder):
    events = select.relevant_events(event_cells(spark, folder), T1)
    return events.select("event_id", *text("row_key"), "is_relevant")


@query("filter_puts", f"WITH {EVENT_CELLS} {_SHOWN} WHERE op = 'Put'")
def filter_puts(spark, folder):
    return _shown(event_cells(spark, folder).filter(select.is_put()))


COMPLETE = IndexSpec(
    "orders", [FieldSpec("status", "info:status"), FieldSpec("rush", "info:rush"), FieldSpec("total", "info:total")]
)


@query(
    "event_complete",
    f"""WITH {ORDER_CELLS} SELECT event_id, row_key,
bool_or(qualifier = 'status') AND bool_or(qualifier = 'rush') AND bool_or(qualifier = 'total') AS is_complete
FROM order_cells GROUP BY 1, 2""",
)
def event_complete(spark, folder):
    events = select.complete_events(order_cells(spark, folder), COMPLETE)
    return events.select("event_id", *text("row_key"), "is_complete")


# Keys


@query("key_string_row", f"WITH {EVENT_CELLS} SELECT seq, row_key AS id FROM cells")
def key_string_row(spark, folder):
    return event_cells(spark, folder).select("seq", STRING.row(F.col("row_key")).alias("id"))


@query(
    "key_string_cell",
    f"""WITH {EVENT_CELLS} SELECT seq, replace(row_key, '-', '\\-') || '-' || replace(family, '-', '\\-') || '-'
|| replace(qualifier, '-', '\\-') AS id FROM cells""",
)
def key_string_cell(spark, folder):
    return event_cells(spark, folder).select("seq", STRING.cell(*map(F.col, COORDINATES)).alias("id"))


@query("key_hex_row", f"WITH {EVENT_CELLS} SELECT seq, lower(hex(row_key)) AS id FROM cells")
def key_hex_row(spark, folder):
    return event_cells(spark, folder).select("seq", HEX.row(F.col("row_key")).alias("id"))


@query(
    "key_hex_cell",
    f"""WITH {EVENT_CELLS} SELECT seq, lower(hex(row_key)) || '-' || lower(hex(family)) || '-'
|| lower(hex(qualifier)) AS id FROM cells""",
)
def key_hex_cell(spark, folder):
    return event_cells(spark, folder).select("seq", HEX.cell(*map(F.col, COORDINATES)).alias("id"))


@query(
    "key_parse",
    f"""WITH {EVENT_CELLS} SELECT seq, row_key, family, qualifier, row_key AS hex_row_key, family AS hex_family,
qualifier AS hex_qualifier, row_key AS row_id FROM cells""",
)
def key_parse(spark, folder):
    coordinates = [F.col(c) for c in COORDINATES]
    keyed = event_cells(spark, folder).select(
        "seq",
        STRING.cell(*coordinates).alias("s"),
        HEX.cell(*coordinates).alias("h"),
        HEX.row(coordinates[0]).alias("r"),
    )
    parsed = keyed.select(
        "seq",
        STRING.must_parse_cell(F.col("s")).alias("s"),
        HEX.must_parse_cell(F.col("h")).alias("h"),
        HEX.parse_row(F.col("r")).cast("string").alias("row_id"),
    )
    return parsed.select(
        "seq",
        *[F.col(f"s.{c}").cast("string").alias(c) for c in COORDINATES],
        *[F.col(f"h.{c}").cast("string").alias(f"hex_{c}") for c in COORDINATES],
        "row_id",
    )


@query(
    "key_family", f"WITH {EVENT_CELLS} SELECT seq, family AS family_id, lower(hex(family)) AS hex_family_id FROM cells"
)
def key_family(spark, folder):
    family = F.col("family")
    return event_cells(spark, folder).select(
        "seq", STRING.family(family).alias("family_id"), HEX.family(family).alias("hex_family_id")
    )


# Value decoding. The bytes are packed by numpy, apart from the library's own code.


def packed(kind: str):
    """A vectorised encoder to big-endian bytes of one numpy type."""

    @F.pandas_udf("binary")
    def pack(values: pd.Series) -> pd.Series:
        raw = values.to_numpy().astype(kind)
        size = raw.dtype.itemsize
        data = raw.tobytes()
        return pd.Series([data[i : i + size] for i in range(0, len(data), size)], dtype=object)

    return pack


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_LINE_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey"


def packed_table(spark, folder: str, name: str, table_name: str, keys, value: Column) -> DataFrame:
    """Keys and bytes ``_b`` of a table, packed once and stored: queries then read bytes only."""

    @stored(f"packed-{name}")
    def derive(spark, folder):
        return spread(table(spark, folder, table_name)).select(*keys, value.alias("_b"))

    return derive(spark, folder)


def _decoded(df: DataFrame, keys, type: str, params=None, as_type: str | None = None) -> DataFrame:
    values = decode(F.col("_b"), type, params)
    out = _value(values)
    out = out if as_type is None else out.cast(as_type)
    return df.select(*keys, out.alias("v"), F.size(values).alias("n"))


@query("decode_int", "SELECT c_custkey, c_nationkey - 12 AS v, 1 AS n FROM customer")
def decode_int(spark, folder):
    return _decoded(packed_table(spark, folder, "int", "customer", ["c_custkey"], packed(">i4")(F.col("c_nationkey") - 12)), ["c_custkey"], "int")


@query("decode_long", "SELECT o_orderkey, 3 - o_orderkey * 1000003 AS v, 1 AS n FROM orders")
def decode_long(spark, folder):
    return _decoded(packed_table(spark, folder, "long", "orders", ["o_orderkey"], packed(">i8")(3 - F.col("o_orderkey") * 1000003)), ["o_orderkey"], "long")


@query("decode_short", f"{_LINE_SQL}, CAST(l_linenumber - 7 AS SMALLINT) AS v, 1 AS n FROM lineitem")
def decode_short(spark, folder):
    return _decoded(packed_table(spark, folder, "short", "lineitem", LINE_KEY, packed(">i2")(F.col("l_linenumber") - 7)), LINE_KEY, "short")


@query("decode_float", f"{_LINE_SQL}, CAST(CAST(l_discount - 0.05 AS FLOAT) AS DOUBLE) AS v, 1 AS n FROM lineitem")
def decode_float(spark, folder):
    return _decoded(packed_table(spark, folder, "float", "lineitem", LINE_KEY, packed(">f4")(F.col("l_discount") - 0.05)), LINE_KEY, "float", as_type="double")


@query("decode_double", f"{_LINE_SQL}, l_extendedprice AS v, 1 AS n FROM lineitem")
def decode_double(spark, folder):
    return _decoded(packed_table(spark, folder, "double", "lineitem", LINE_KEY, packed(">f8")("l_extendedprice")), LINE_KEY, "double")


@query("decode_boolean", "SELECT doc_id, toxic = 1 AS v, 1 AS n FROM labels")
def decode_boolean(spark, folder):
    return _decoded(packed_table(spark, folder, "boolean", "labels", ["doc_id"], packed("u1")("toxic")), ["doc_id"], "boolean")


@query("decode_string", "SELECT p_partkey, p_type || ' ' || p_name AS v, 1 AS n FROM part")
def decode_string(spark, folder):
    return _decoded(packed_table(spark, folder, "string", "part", ["p_partkey"], F.encode(F.concat_ws(" ", "p_type", "p_name"), "UTF-8")), ["p_partkey"], "string")


def packed_decimal(cents: Column) -> Column:
    def one(n):
        n = int(n)
        return np.array(2, ">i4").tobytes() + n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)

    @F.pandas_udf("binary")
    def pack(values: pd.Series) -> pd.Series:
        return values.map(one)

    return pack(cents)


@query(
    "decode_decimal",
    "SELECT o_orderkey, CAST(round((o_totalprice - 250000) * 100) AS BIGINT) AS v, 1 AS n FROM orders",
)
def decode_decimal(spark, folder):
    cents = packed_decimal(F.round((F.col("o_totalprice") - 250000) * 100).cast("bigint"))
    out = _decoded(packed_table(spark, folder, "decimal", "orders", ["o_orderkey"], cents), ["o_orderkey"], "bigdecimal", {"scale": 2})
    return out.withColumn("v", (F.col("v") * 100).cast("bigint"))


@query(
    "decode_decimal_exact",
    """WITH cents AS (SELECT o_orderkey, CAST(round((o_totalprice - 250000) * 100) AS BIGINT) AS c FROM orders)
SELECT o_orderkey, CASE WHEN c % 10 = 0 THEN c // 10 END AS v, CASE WHEN c % 10 = 0 THEN 1 ELSE 0 END AS n FROM cents""",
)
def decode_decimal_exact(spark, folder):
    """At a scale of one place only the amounts that need no rounding have a value."""
    cents = packed_decimal(F.round((F.col("o_totalprice") - 250000) * 100).cast("bigint"))
    out = _decoded(packed_table(spark, folder, "decimal", "orders", ["o_orderkey"], cents), ["o_orderkey"], "bigdecimal", {"scale": 1})
    return out.withColumn("v", (F.col("v") * 10).cast("bigint"))


@query(
    "decode_invalid",
    """SELECT c_custkey, 0 AS as_long, 0 AS as_double, 1 AS as_short, 0 AS as_boolean, 0 AS as_decimal,
c_nationkey >> 16 AS short_value FROM customer""",
)
def decode_invalid(spark, folder):
    """Four bytes of an int, read as other types: too short has no value, too long reads the head."""
    b = F.col("_b")
    return packed_table(spark, folder, "nation", "customer", ["c_custkey"], packed(">i4")("c_nationkey")).select(
        "c_custkey",
        *[F.size(decode(b, t)).alias(f"as_{t}") for t in ("long", "double", "short", "boolean")],
        F.size(decode(b, "bigdecimal")).alias("as_decimal"),
        _value(decode(b, "short")).cast("int").alias("short_value"),
    )


@query(
    "decode_csv",
    """SELECT event_id, event_type || '|' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)
|| '|default1|default2' AS v, 4 AS n FROM events""",
)
def decode_csv(spark, folder):
    """Trailing empty entries are dropped before the configured defaults are added."""
    events = spread(table(spark, folder, "events"))
    b = string_bytes(F.concat(F.col("event_type"), F.lit(","), event_key().cast("string"), F.lit(",,")))
    values = decode(F.col("b"), "csv", {"defaults": "default1,default2"})
    return events.withColumn("b", b).select(
        "event_id", F.array_join(values, "|").alias("v"), F.size(values).alias("n")
    )


# A value mapper of the user: one value to many, as a vectorised function.


def name_parts(b: Column, params) -> Column:
    @F.pandas_udf("array<string>")
    def parts(values: pd.Series) -> pd.Series:
        return values.map(lambda v: [w.upper() for w in v.decode().split("#")])

    return parts(b)


@query(
    "udf_value_mapper",
    "SELECT c_custkey, upper(replace(c_name, '#', '|')) AS v, len(string_split(c_name, '#')) AS n FROM customer",
)
def udf_value_mapper(spark, folder):
    register_decoder("name_parts", name_parts)
    customers = table(spark, folder, "customer").withColumn("b", string_bytes("c_name"))
    values = customers.select("c_custkey", decode(F.col("b"), "name_parts").alias("a"))
    return values.select("c_custkey", F.array_join("a", "|").alias("v"), F.size("a").cast("bigint").alias("n"))


class ReversedKeys:
    """A key format of the user: reversed row keys, which spread monotone rows."""

    def row(self, row_key: Column) -> Column:
        return F.reverse(STRING.row(row_key))

    family = row

    def cell(self, row_key: Column, family: Column, qualifier: Column) -> Column:
        return F.concat_ws("/", self.row(row_key), STRING.row(family), STRING.row(qualifier))


@query(
    "udf_key",
    f"""WITH {EVENT_CELLS} SELECT reverse(row_key) || '/' || family || '/' || qualifier AS id, max(seq) AS seq
FROM cells WHERE tbl = 'table1' AND family = 'act' GROUP BY 1""",
)
def udf_key(spark, folder):
    from cellindex.operators.reduce import last_cell_per_id

    spec = IndexSpec("table1", T1.fields, mapping="column", key_format=ReversedKeys())
    return last_cell_per_id(event_cells(spark, folder), spec).select("id", "seq")
