"""Continuous indexing: micro-batches of cell mutations into an index table."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cellindex.operators import metrics
from cellindex.plans import build, history
from cellindex.plans.scratch import reuse_scratch
from cellindex.plans.table import DEFAULT_SUBSCRIPTION, IndexTable

Snapshot = Callable[[SparkSession], DataFrame]


def index_batch(
    cells: DataFrame,
    batch_id: int,
    table: IndexTable,
    snapshot: Snapshot | None = None,
    subscription: str = DEFAULT_SUBSCRIPTION,
) -> None:
    """Index one batch. Running it again with the same id changes nothing.

    If specs were stored beside the table (``plans.history``), each cell is read by the one that holds at its ``seq``.
    Documents with faults are stored beside the good ones, but not published.
    Faults of the infrastructure raise, so Spark retries the batch.
    """
    with reuse_scratch(f"{table.path}/scratch"):
        source = snapshot(table.spark) if snapshot else None
        versions = history.recall(table.spark, table.path)
        if versions:
            table = IndexTable(table.spark, table.path, versions[-1].spec, table.buckets)
            found = history.changes(cells, versions, source)
        else:
            found = build.changes(cells, table.spec, source)
        counts: dict[str, int] = {}
        try:
            table.write_batch(found, batch_id, subscription, metrics.change_counts(found), counts)
            write_counters(cells, counts, table, batch_id, subscription)
        except Exception as fault:
            note_failure(table, batch_id, subscription, fault)
            raise


def subscription_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a query when its checkpoint is made; a new checkpoint is a new subscription."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_indexing(
    cells: DataFrame,
    table: IndexTable,
    checkpoint: str,
    snapshot: Snapshot | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that keeps ``table`` in step with a stream of cells.

    Stopping the query pauses indexing; starting it again with the same
    checkpoint goes on without loss. A new checkpoint, with a new ``since`` on
    the stream, is a new subscription: its batches are added to those of earlier ones.
    """
    known: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        if not known:  # the checkpoint exists once the first batch runs
            known.append(subscription_of(table.spark, checkpoint))
        index_batch(batch, number, table, snapshot, known[0])

    return (
        cells.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_counters(
    cells: DataFrame, counts: Mapping[str, int], table: IndexTable, batch_id: int, subscription: str = DEFAULT_SUBSCRIPTION
) -> None:
    """Store the counters of a batch beside its changes, as (metric, value) rows.

    ``counts`` were observed while the changes were written. Events are counted from the batch, as an event
    may have cells anywhere in it.
    """
    events = metrics.as_rows(metrics.event_counters(cells, table.spec))
    observed = table.spark.createDataFrame(list(counts.items()), "metric string, value long")
    path = f"{table.path}/metrics/subscription={subscription}/batch={batch_id}"
    events.unionByName(observed).coalesce(1).write.mode("overwrite").parquet(path)


def note_failure(table: IndexTable, batch_id: int, subscription: str, fault: Exception) -> None:
    """Note an attempt that the infrastructure ended: a system error of that batch, however it ends later."""
    row = [(subscription, batch_id, type(fault).__name__, time.time_ns())]
    with suppress(Exception):  # the fault itself is what is raised
        notes = table.spark.createDataFrame(row, "subscription string, batch long, error string, at long")
        notes.coalesce(1).write.mode("append").parquet(f"{table.path}/failures")


def counters(table: IndexTable) -> DataFrame:
    """All counters of an index as (metric, value), with ``system_errors`` for attempts that failed."""
    spark = table.spark
    found = spark.read.parquet(f"{table.path}/metrics").groupBy("metric").agg(F.sum("value").alias("value"))
    try:
        failed = spark.read.parquet(f"{table.path}/failures").agg(F.count(F.lit(1)).alias("value"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        failed = spark.createDataFrame([(0,)], "value long")
    return found.unionByName(failed.select(F.lit("system_errors").alias("metric"), "value"))
