"""The versions of a spec, stored beside its index: which one holds from which ``seq`` on.

A running index reads them anew with every batch. A cell is read by the version
that holds at its ``seq``, also where a batch has cells of several versions, so
a change is never applied to what came before it, and does not depend on where
batches are cut. Readers need no spec of their own: the newest stored one says
what the documents look like.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellindex.operators import changelog
from cellindex.plans import build
from cellindex.plans.table import IndexTable
from cellindex.spec import IndexSpec, SpecError

SPECS = "since long, spec string, at long"
START = -(2**63)


@dataclass(frozen=True)
class Version:
    """A spec and the first ``seq`` at which it holds."""

    spec: IndexSpec
    since: int


def remember(spark: SparkSession, path: str, spec: IndexSpec, since: int | None = None) -> None:
    """Store a version of the spec of the index under ``path``; the first holds from the start.

    A version written again for the same ``since`` replaces the earlier one. ``since`` must lie after all that
    is indexed already: batches that were written keep the documents they have.
    """
    since = START if since is None else since
    known = recall(spark, path)
    if not known and since != START:
        raise SpecError("the first spec of an index holds from the start")
    if any(v.spec.mapping != spec.mapping or v.spec.table != spec.table for v in known):
        raise SpecError("a new version of a spec keeps its table and mode")
    row = [(since, json.dumps(spec.to_dict()), time.time_ns())]
    spark.createDataFrame(row, SPECS).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/specs")


def recall(spark: SparkSession, path: str) -> list[Version]:
    """All versions, in order; none if no spec was stored."""
    try:
        stored = spark.read.schema(SPECS).parquet(f"{path.rstrip('/')}/specs")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    last = stored.groupBy("since").agg(F.max_by("spec", "at").alias("spec")).orderBy("since").collect()  # a row for each change of a spec
    return [Version(IndexSpec.from_dict(json.loads(r["spec"])), r["since"]) for r in last]


def open_table(spark: SparkSession, path: str) -> IndexTable:
    """The index under ``path`` with its newest stored spec."""
    versions = recall(spark, path)
    if not versions:
        raise ValueError(f"no spec is stored with {path}")
    return IndexTable(spark, path, versions[-1].spec)


def changes(cells: DataFrame, versions: list[Version], snapshot: DataFrame | None = None) -> DataFrame:
    """The changelog of a batch, each cell under the version of its ``seq``, in the shape of the newest.

    Only versions that the batch reaches are planned: as a rule one. Where an older version reads a row again,
    its document counts as of the last ``seq`` of that version, so that one of a newer version wins.
    """
    newest = versions[-1].spec
    shape = changelog.change_schema(cells.sparkSession, newest)["doc"].dataType
    ends = [v.since for v in versions[1:]] + [None]
    first, last = cells.filter(F.col("tbl") == newest.table).agg(F.min("seq"), F.max("seq")).first() if len(versions) > 1 else (None, None)
    found = None
    for version, end in zip(versions, ends):
        if first is not None and (last < version.since or (end is not None and first >= end)):
            continue
        part = cells.filter(F.col("seq") >= version.since)
        if end is not None:
            part = part.filter(F.col("seq") < end)
        own = build.changes(part, version.spec, snapshot)
        if end is not None:
            own = own.withColumn("seq", F.least("seq", F.lit(end - 1)))
        own = own.withColumn("doc", _in_shape(own.schema["doc"].dataType, shape))
        found = own if found is None else found.unionByName(own)
    return found


def _in_shape(old: T.StructType, new: T.StructType) -> Column:
    """A document with the fields of ``new``; those it never had are NULL, which reads as no values."""
    fields = []
    for f in new.fields:
        value = F.col("doc")[f.name] if f.name in old.fieldNames() else F.lit(None)
        fields.append((value if f.name in old.fieldNames() and old[f.name].dataType == f.dataType else _cast(value, f)).alias(f.name))
    return F.when(F.col("doc").isNotNull(), F.struct(*fields))


def _cast(value: Column, field: T.StructField) -> Column:
    """Values of a field whose type has changed: those that fit the new type."""
    if not isinstance(field.dataType, T.ArrayType):
        return value.cast(field.dataType)
    kind = field.dataType.elementType
    return F.filter(F.transform(value.cast(T.ArrayType(T.StringType())), lambda v: v.try_cast(kind)), lambda v: v.isNotNull())
