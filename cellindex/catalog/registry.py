"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Cell mutations per event, as text; the SQL side of sources.tables.event_cells.
EVENT_CELLS = """
cells AS (
  SELECT event_id AS seq, ts, 'table' || CAST(1 + user_id % 2 AS VARCHAR) AS tbl,
         'u-' || CAST(user_id AS VARCHAR) AS row_key,
         CASE WHEN event_type IN ('click','view') THEN 'act'
              WHEN event_type = 'purchase' THEN 'buy'
              WHEN event_type = 'signup' THEN 'info'
              WHEN k % 3 = 0 THEN 'act' WHEN k % 3 = 1 THEN 'buy' ELSE 'info' END AS family,
         'q' || CAST(k AS VARCHAR) AS qualifier, value,
         CASE WHEN event_type <> 'error' THEN 'Put'
              WHEN k % 20 = 0 THEN 'DeleteRow'
              WHEN k % 20 IN (1, 2) THEN 'DeleteFamily'
              ELSE 'DeleteColumn' END AS op
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

# Live cells of both tables: the last put of a cell, after all deletes that cover it.
LIVE_CELLS = (
    EVENT_CELLS
    + """,
row_ends AS (SELECT tbl, row_key, max(seq) AS s FROM cells WHERE op = 'DeleteRow' GROUP BY 1, 2),
family_ends AS (
  SELECT tbl, row_key, family, max(seq) AS s FROM cells WHERE op = 'DeleteFamily' GROUP BY 1, 2, 3),
last_cells AS (
  SELECT tbl, row_key, family, qualifier, max(seq) AS seq, max_by(op, seq) AS op, max_by(value, seq) AS value
  FROM cells WHERE op IN ('Put', 'DeleteColumn') GROUP BY 1, 2, 3, 4),
live AS (
  SELECT l.* FROM last_cells l
  LEFT JOIN row_ends r USING (tbl, row_key) LEFT JOIN family_ends f USING (tbl, row_key, family)
  WHERE l.op = 'Put' AND l.seq > coalesce(r.s, -1) AND l.seq > coalesce(f.s, -1))"""
)

# Wide rows from orders; the SQL side of sources.tables.order_cells.
ORDER_CELLS = """
heads AS (
  SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS row_key, o_orderkey AS event_id, * FROM orders),
items AS (
  SELECT 'o-' || CAST(l_orderkey AS VARCHAR) AS row_key, l_orderkey AS event_id, l_quantity AS quantity,
         lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-' || CAST(l_partkey AS VARCHAR) || '-'
           || CAST(l_suppkey AS VARCHAR) || '-'
           || lpad(CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                                           ORDER BY l_quantity, l_shipdate) AS VARCHAR), 2, '0') AS qualifier
  FROM lineitem),
order_cells AS (
  SELECT row_key, event_id, 'info' AS family, 'status' AS qualifier, o_orderstatus AS txt, NULL AS num FROM heads
  UNION ALL SELECT row_key, event_id, 'info', 'priority', o_orderpriority, NULL FROM heads
  UNION ALL SELECT row_key, event_id, 'info', 'total', NULL, o_totalprice FROM heads
  UNION ALL SELECT row_key, event_id, 'info', 'rush', 'yes', NULL FROM heads WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT row_key, event_id, 'item', qualifier, NULL, quantity FROM items
)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def text(*names: str) -> list[Column]:
    """Binary columns as text, for output."""
    return [F.col(n).cast("string").alias(n) for n in names]


def money(values: Column) -> Column:
    """A list of numbers as text with two places, the same in both engines."""
    return F.array_join(F.transform(values, lambda v: v.cast("decimal(18,2)").cast("string")), "|")
