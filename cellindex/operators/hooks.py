"""Hooks for code of the user: row mappers over whole rows."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellindex.operators import select
from cellindex.operators.skew import MAX_GROUP_BYTES, collect_groups
from cellindex.spec import SpecError, Target

# Cells handed to one call; Arrow batches hold many calls, so this stays small.
MAX_CALL_CELLS = 1_000
# Results of pieces that one call merges.
MERGED_AT_ONCE = 1_000
MERGES = ("sum", "min", "max", "first", "last", "concat")


class Targets:
    """The cells that code of the user reads, named by ``targets``."""

    targets: tuple[str, ...]

    def relevant(self) -> Column:
        return select.any_of(select.matches(Target.parse(t)) for t in self.targets)

    def required(self) -> list[Target] | None:
        targets = [Target.parse(t) for t in self.targets]
        return None if any(t.prefix for t in targets) else targets


def _takes(fn: Callable, more_than: int) -> bool:
    return len(inspect.signature(fn).parameters) > more_than


@dataclass(frozen=True)
class RowFold(Targets):
    """Map the cells of a row to document fields, cell by cell, whatever the size of the row.

    ``start`` makes a state (from the dict of the spec's and its own parameters, if it takes an argument), ``add``
    takes the state and the next cell, a dict of family, qualifier and value bytes, and returns the state, and
    ``finish`` turns it into a dict of field values. Cells come in family and qualifier order. ``fields`` is the DDL of those fields.

    Spark sorts each partition, spilling where it must, and a task holds one Arrow batch of cells and one state; so
    documents do not depend on the size of batches. A row is read by one task from its first cell to its last,
    as the order of ``add`` asks for; ``RowMapper`` with ``merge`` spreads a row over tasks.
    """

    start: Callable[..., Any]
    add: Callable[[Any, dict], Any]
    finish: Callable[[Any], dict]
    fields: str
    targets: tuple[str, ...]
    params: Mapping[str, Any] = field(default_factory=dict)

    def _starter(self, params: Mapping[str, Any] | None) -> Callable[[], Any]:
        start, given = self.start, {**(params or {}), **self.params}
        return (lambda: start(given)) if _takes(start, 0) else start

    def map_cells(self, cells: DataFrame, params: Mapping[str, Any] | None = None) -> DataFrame:
        """Column mode: each cell is a row of its own; its fields become columns."""
        start, add, finish = self._starter(params), self.add, self.finish

        @F.pandas_udf(T.StructType.fromDDL(self.fields))
        def mapped(family: pd.Series, qualifier: pd.Series, value: pd.Series) -> pd.DataFrame:
            rows = zip(family, qualifier, value)
            return pd.DataFrame([finish(add(start(), _cell(*r))) for r in rows])

        return cells.withColumn("_doc", mapped("family", "qualifier", "value")).select("*", "_doc.*").drop("_doc")

    def map(self, cells: DataFrame, keep: tuple[str, ...] = (), params: Mapping[str, Any] | None = None) -> DataFrame:
        """One document per row with ``part`` 0; of the columns in ``keep`` the greatest value of its cells."""
        start, add, finish = self._starter(params), self.add, self.finish
        names = T.StructType.fromDDL(self.fields).fieldNames()
        order = ["row_key", "family", "qualifier"]
        placed = cells.select(*order, "value", *keep).repartition("row_key").sortWithinPartitions(*order)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, state, kept, done = None, None, None, []

            def closed() -> dict:
                return {"row_key": own, "part": 0, **dict(zip(keep, kept)), **{n: v for n, v in finish(state).items() if n in names}}

            for frame in frames:
                for key, family, qualifier, value, *others in frame.itertuples(index=False, name=None):
                    if own is None or key != own:
                        if own is not None:
                            done.append(closed())
                        own, state, kept = key, start(), others
                    state = add(state, _cell(family, qualifier, value))
                    kept = [max(a, b) for a, b in zip(kept, others)]
                    if len(done) >= MAX_CALL_CELLS:
                        yield pd.DataFrame(done)
                        done = []
            if own is not None:
                done.append(closed())
            if done:
                yield pd.DataFrame(done)

        given = {f.name: f.dataType.simpleString() for f in cells.schema}
        schema = ", ".join(["row_key binary", "part bigint", *[f"`{k}` {given[k]}" for k in keep], self.fields])
        return placed.mapInPandas(run, schema)


def _cell(family: bytes, qualifier: bytes, value: bytes | None) -> dict:
    return {"family": family, "qualifier": qualifier, "value": value}


@dataclass(frozen=True)
class RowMapper(Targets):
    """Map the cells of a row to document fields with a Python function.

    ``fn`` gets the cells of one row in family and qualifier order, each a dict
    of family, qualifier and value bytes, and returns a dict of field values. If
    it takes a second argument, that is a dict of the spec's and its own parameters. ``fields`` is
    the DDL of those fields. Rows are handed over in Arrow batches.

    A row above ``max_values`` cells is handed over in pieces, and ``merge`` says
    how their results become one document: for each field one of ``sum``, ``min``,
    ``max``, ``first``, ``last`` and ``concat`` (lists or text, in order), or one function
    of two result dicts that is associative. With either, the document does not
    depend on the size of the pieces. A mapper without ``merge`` fails on such a row; ``RowFold`` takes rows of any size.
    """

    fn: Callable[..., dict]
    fields: str
    targets: tuple[str, ...]
    max_values: int = MAX_CALL_CELLS
    merge: Mapping[str, str] | Callable[[dict, dict], dict] | None = None
    params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        if isinstance(self.merge, Mapping):
            if not set(self.merge.values()) <= set(MERGES):
                raise SpecError(f"merge needs one of {', '.join(MERGES)} for each field")

    def _mapped(self, cells: Column, params: Mapping[str, Any] | None) -> Column:
        fn, given = self.fn, {**(params or {}), **self.params}
        if _takes(fn, 1):
            own = fn
            fn = lambda row: own(row, given)

        @F.pandas_udf(T.StructType.fromDDL(self.fields))
        def mapped(rows: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([fn(list(row)) for row in rows])

        return mapped(cells)

    def map_cells(self, cells: DataFrame, params: Mapping[str, Any] | None = None) -> DataFrame:
        """Column mode: each cell is a row of its own; its fields become columns."""
        one = F.array(F.struct("family", "qualifier", "value"))
        return cells.withColumn("_doc", self._mapped(one, params)).select("*", "_doc.*").drop("_doc")

    def map(
        self, cells: DataFrame, keep: tuple[str, ...] = (), params: Mapping[str, Any] | None = None
    ) -> DataFrame:
        rows = collect_groups(
            cells.select("row_key", "family", "qualifier", "value", *keep),
            ["row_key"],
            ["family", "qualifier"],
            {"cells": (None, F.struct("family", "qualifier", "value"))},
            self.max_values,
            totals={k: F.max(k) for k in keep},
            size=F.length("qualifier") + F.coalesce(F.length("value"), F.lit(0)),
        )
        if self.merge is None:
            whole = F.when(F.col("part") == 0, F.col("cells")).otherwise(
                F.raise_error(F.lit(f"a row has more than {self.max_values} cells or {MAX_GROUP_BYTES} bytes and its mapper has no merge"))
            )
            rows = rows.withColumn("cells", whole)
        pieces = rows.withColumn("doc", self._mapped(F.col("cells"), params)).select("row_key", "part", *keep, "doc")
        if self.merge is not None:
            pieces = self._merged(pieces, keep)
        return pieces.select("row_key", "part", *keep, "doc.*")

    def _merged(self, pieces: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """One document per row from the documents of its pieces.

        A function merges them in rounds over runs of neighbouring pieces, so that no call sees all pieces of a long row.
        """
        kept = [F.max(k).alias(k) for k in keep]
        part = F.lit(0).cast("bigint").alias("part")
        if isinstance(self.merge, Mapping):
            if set(self.merge) != set(T.StructType.fromDDL(self.fields).fieldNames()):
                raise SpecError("merge must name every field of the mapper")
            fields = [self._combined(f, self.merge[f.name]).alias(f.name) for f in T.StructType.fromDDL(self.fields)]
            grouped = pieces.groupBy("row_key").agg(*kept, *fields)
            return grouped.select("row_key", part, *keep, F.struct(*[f"`{f.name}`" for f in T.StructType.fromDDL(self.fields)]).alias("doc"))
        merge = self.merge

        @F.pandas_udf(T.StructType.fromDDL(self.fields))
        def combined(rows: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([reduce(merge, (dict(r) for r in row)) for row in rows])

        docs = F.sort_array(F.collect_list(F.struct("part", F.col("doc").alias("d"))))["d"]
        # Before the last round, two that shorten rows of up to MERGED_AT_ONCE ** 3 pieces; planning starts no job to count them.
        for _ in range(2):
            run = F.floor(F.col("part") / MERGED_AT_ONCE).cast("bigint").alias("part")
            grouped = pieces.groupBy("row_key", run).agg(*kept, docs.alias("docs"))
            pieces = grouped.select("row_key", "part", *keep, combined("docs").alias("doc"))
        grouped = pieces.groupBy("row_key").agg(*kept, docs.alias("docs"))
        return grouped.select("row_key", part, *keep, combined("docs").alias("doc"))

    def _combined(self, of: T.StructField, how: str) -> Column:
        value = F.col("doc")[of.name]
        if how in ("sum", "min", "max"):
            return getattr(F, how)(value).cast(of.dataType)
        if how in ("first", "last"):
            return (F.min_by if how == "first" else F.max_by)(value, "part")
        pieces = F.sort_array(F.collect_list(F.struct("part", value.alias("v"))))["v"]
        return F.flatten(pieces) if isinstance(of.dataType, T.ArrayType) else F.array_join(pieces, "")
