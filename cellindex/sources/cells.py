"""Cell mutations as tables and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellindex.operators import select

# One row per cell mutation. ``seq`` orders all mutations, and tells apart two
# mutations of one cell; cells of one event share ``event_id``.
CELL_SCHEMA = T.StructType(
    [
        T.StructField("tbl", T.StringType()),
        T.StructField("row_key", T.BinaryType()),
        T.StructField("family", T.BinaryType()),
        T.StructField("qualifier", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("event_id", T.LongType()),
    ]
)


def read_cells(spark: SparkSession, path: str, format: str = "parquet", since: datetime | None = None) -> DataFrame:
    """A table of cell mutations; ``since`` keeps those strictly after a moment."""
    cells = spark.read.format(format).schema(CELL_SCHEMA).load(path)
    return cells if since is None else cells.filter(select.after(since))


def stream_cells(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    since: datetime | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of cell mutations from files that arrive under ``path``."""
    reader = spark.readStream.format(format).schema(CELL_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    cells = reader.load(path)
    return cells if since is None else cells.filter(select.after(since))


def write_cells(cells: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append") -> None:
    """Write cells so that scans by coordinate prune.

    Files are range-partitioned and sorted by coordinates, which gives narrow
    min/max statistics and splits a large row over many files.
    """
    order = ["tbl", "family", "row_key", "qualifier"]
    laid_out = cells.select(*CELL_SCHEMA.fieldNames()).repartitionByRange(*order).sortWithinPartitions(*order)
    laid_out.write.mode(mode).partitionBy(*partition_by).parquet(path)


ROW_BUCKET = "row_bucket_of_"


def write_by_row(
    cells: DataFrame, path: str, buckets: int = 256, mode: str = "overwrite", options: Mapping[str, str] | None = None
) -> None:
    """Write the content of a source table so that reading a few rows again opens few files.

    The table is partitioned by a hash of the row; the name of the partition column says into how many.
    Files are sorted by row, so that row groups prune as well. A row's files lie in one bucket, and a
    large bucket is written by several tasks, as Spark splits large partitions of a rebalance while it runs.
    ``cells`` are read once. ``options`` go to the Parquet writer, as ``without_dictionary``.
    """
    name = f"{ROW_BUCKET}{buckets}"
    placed = cells.withColumn(name, F.pmod(F.xxhash64("row_key"), F.lit(buckets)).cast("int"))
    order = [name, "row_key", "family", "qualifier"]
    laid_out = placed.hint("rebalance", F.col(name)).sortWithinPartitions(*order)
    laid_out.write.mode(mode).options(**dict(options or {})).partitionBy(name).parquet(path)


def without_dictionary(*columns: str) -> dict[str, str]:
    """Options of the Parquet writer for columns of mostly different values, for which dictionaries are built in vain."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


def of_rows(snapshot: DataFrame, rows: DataFrame) -> DataFrame:
    """Cells of a source table that may belong to some rows: those of their buckets, if it is laid out by row.

    The buckets of ``rows`` become a filter on partitions, so other files are never opened. Tables of any other
    layout come back as they are.
    """
    names = [c for c in snapshot.columns if c.startswith(ROW_BUCKET)]
    if not names:
        return snapshot
    name, of = names[0], int(names[0][len(ROW_BUCKET) :])
    found = rows.select(F.pmod(F.xxhash64("row_key"), F.lit(of)).cast("int").alias("b")).distinct()
    wanted = [r["b"] for r in found.collect()]  # numbers below ``of``
    return snapshot.filter(F.col(name).isin(wanted)) if len(wanted) < of else snapshot
