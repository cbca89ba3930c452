"""Cell mutations derived from relational tables.

Three shapes: one cell per event, wide rows from orders and their lines, and
pages of markup. Spark derives each log once per application, as a Parquet
table in the shared folder; jobs then scan it as they would scan a real log,
with pushed filters and pruned columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellindex.functions.encode import double_bytes, string_bytes
from cellindex.operators.select import DELETE_COLUMN, DELETE_FAMILY, DELETE_ROW, PUT
from cellindex.plans.scratch import work_dir
from cellindex.sources.cells import CELL_SCHEMA, without_dictionary

_PATHS: dict[tuple[str, str, str], str] = {}


def stored(name: str, options: Mapping[str, str] | None = None) -> Callable:
    """Turn a derivation into a table that is written on first use; ``options`` go to the Parquet writer."""

    def wrap(derive: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def read(spark: SparkSession, folder: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, folder, name)
            if key not in _PATHS:
                path = work_dir(spark, name)
                derive(spark, folder).write.options(**dict(options or {})).parquet(path)
                _PATHS[key] = path
            return spark.read.parquet(_PATHS[key])

        read.__name__, read.__doc__ = derive.__name__, derive.__doc__
        return read

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer splits than there are cores.

    Large tables have more splits than cores and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def utc(name: str) -> Column:
    """A timestamp without zone, read as UTC whatever the zone of the session."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {name})")
    return F.timestamp_micros(micros)


def event_key() -> Column:
    """The number in an event's props."""
    return F.get_json_object("props", "$.k").cast("int")


@stored("event-cells")
def event_cells(spark: SparkSession, folder: str) -> DataFrame:
    """One cell mutation per event: two tables, three families, all kinds of delete."""
    events = spread(table(spark, folder, "events")).withColumn("k", event_key())
    kind, k = F.col("event_type"), F.col("k")
    family = (
        F.when(kind.isin("click", "view"), "act")
        .when(kind == "purchase", "buy")
        .when(kind == "signup", "info")
        .when(k % 3 == 0, "act")
        .when(k % 3 == 1, "buy")
        .otherwise("info")
    )
    op = (
        F.when(kind != "error", PUT)
        .when(k % 20 == 0, DELETE_ROW)
        .when((k % 20).isin(1, 2), DELETE_FAMILY)
        .otherwise(DELETE_COLUMN)
    )
    return _cells(
        events,
        tbl=F.concat(F.lit("table"), (1 + F.col("user_id") % 2).cast("string")),
        row_key=string_bytes(F.concat(F.lit("u-"), F.col("user_id").cast("string"))),
        family=string_bytes(family),
        qualifier=string_bytes(F.concat(F.lit("q"), k.cast("string"))),
        value=double_bytes("value"),
        op=op,
        ts=utc("ts"),
        seq=F.col("event_id"),
        event_id=F.col("event_id"),
    )


@stored("order-cells", without_dictionary("row_key", "qualifier", "value", "seq", "event_id"))
def order_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Wide rows: one event per order, with a cell per order column and per line."""
    orders = spread(table(spark, folder, "orders"))
    lines = spread(table(spark, folder, "lineitem"))
    entry = F.explode(
        F.array(
            F.struct(F.lit("status").alias("q"), string_bytes("o_orderstatus").alias("v")),
            F.struct(F.lit("priority").alias("q"), string_bytes("o_orderpriority").alias("v")),
            F.struct(F.lit("total").alias("q"), double_bytes("o_totalprice").alias("v")),
            F.struct(
                F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("rush")).alias("q"),
                string_bytes(F.lit("yes")).alias("v"),
            ),
        )
    )
    heads = orders.select("o_orderkey", "o_orderdate", entry.alias("e")).filter("e.q IS NOT NULL")
    head_cells = _order_row(heads, "o_orderkey", "info", F.col("e.q"), F.col("e.v"), "o_orderdate")
    # Lines may repeat all four keys; a running number gives each a coordinate of its own.
    same = Window.partitionBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").orderBy("l_quantity", "l_shipdate")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    lines = lines.withColumn("n", F.row_number().over(same))
    item = F.concat_ws("-", two(F.col("l_linenumber")), F.col("l_partkey"), F.col("l_suppkey"), two(F.col("n")))
    line_cells = _order_row(lines, "l_orderkey", "item", item, double_bytes("l_quantity"), "l_shipdate")
    return head_cells.unionByName(line_cells)


def _order_row(df: DataFrame, key: str, family: str, qualifier: Column, value: Column, ts: str) -> DataFrame:
    return _cells(
        df,
        tbl=F.lit("orders"),
        row_key=string_bytes(F.concat(F.lit("o-"), F.col(key).cast("string"))),
        family=F.lit(family.encode()),
        qualifier=string_bytes(qualifier),
        value=value,
        op=F.lit(PUT),
        ts=utc(ts),
        seq=F.col(key),
        event_id=F.col(key),
    )


@stored("page-cells")
def page_cells(spark: SparkSession, folder: str) -> DataFrame:
    """One cell of markup per page."""
    pages = spread(table(spark, folder, "pages"))
    return _cells(
        pages,
        tbl=F.lit("pages"),
        row_key=string_bytes("url"),
        family=F.lit(b"content"),
        qualifier=string_bytes("page_id"),
        value=string_bytes("html"),
        op=F.lit(PUT),
        ts=F.lit(None),
        seq=F.col("page_id"),
        event_id=F.col("page_id"),
    )


def _cells(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in CELL_SCHEMA])
