"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellindex.plans.scratch import cut_lineage

stored = cut_lineage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def columns_of(df: DataFrame) -> list[Column]:
    """All columns by their exact names, dots included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_prefix(df: DataFrame, start: str = "__") -> str:
    """A prefix that no column of the table has, in any case of letters, for columns a step needs in between."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(start.lower()) for c in taken):
        start += "_"
    return start


def slices(batches: Iterator[pa.RecordBatch], text: str, chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches where their texts reach ``chars`` bytes, so that work on them stays small."""
    for batch in batches:
        first, size = 0, 0
        column = batch.column(batch.schema.get_field_index(text))
        for k in range(batch.num_rows):
            value = column[k]
            size += value.as_buffer().size if value.is_valid else 0
            if size >= chars:
                yield batch.slice(first, k + 1 - first)
                first, size = k + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)
