"""Vectors as columns: which take part, and as arrays in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null or empty, no null, infinite or NaN component, and not all zero."""
    bound = F.lit(float("inf"))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound)

    # Spark has NaN equal to itself and above all numbers.
    good = F.forall(vector, lambda x: finite(x.cast("double")))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists of doubles."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))
