"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import count

from pyspark.sql import DataFrame, SparkSession

_reused: ContextVar[tuple[str, Iterator[int]] | None] = ContextVar("reused", default=None)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``, in a folder of this application.

    Only a local master may fall back to a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/cellindex/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once none of its results is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_dir(spark, "")).getParent()
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def reuse_scratch(path: str) -> Iterator[None]:
    """Within, intermediate tables go under ``path`` and replace those of the last time.

    A stream's batches use it, so that its scratch space does not grow.
    """
    token = _reused.set((path.rstrip("/"), count()))
    try:
        yield
    finally:
        _reused.reset(token)


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The written files survive lost executors, and later reads prune columns.
    """
    reused = _reused.get()
    if reused:
        path = f"{reused[0]}/{next(reused[1])}-{label}"
    else:
        path = work_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
