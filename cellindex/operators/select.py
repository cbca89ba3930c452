"""Which cells and events matter: predicates compiled from a spec.

All of them are plain comparisons on cell columns, so they reach the Parquet
scan as pushed filters.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.spec import IndexSpec, Target

PUT = "Put"
DELETE_COLUMN = "DeleteColumn"
DELETE_FAMILY = "DeleteFamily"
DELETE_ROW = "DeleteRow"


def of_table(spec: IndexSpec) -> Column:
    return F.col("tbl") == spec.table


def is_put() -> Column:
    """Cells that carry a value; deletes and internal cells do not."""
    return F.col("op") == PUT


def after(cutoff: datetime | Column) -> Column:
    """Strictly later than the moment the index was subscribed."""
    return F.col("ts") > (cutoff if isinstance(cutoff, Column) else F.lit(cutoff))


def _successor(prefix: bytes) -> bytes | None:
    """The least byte string above every string that starts with ``prefix``."""
    kept = prefix.rstrip(b"\xff")
    return kept[:-1] + bytes([kept[-1] + 1]) if kept else None


def matches(target: Target) -> Column:
    """The cell lies in the target. A prefix is a byte range, which scans can prune."""
    family = F.col("family") == F.lit(target.family)
    qualifier = F.col("qualifier")
    if not target.prefix:
        return family & (qualifier == F.lit(target.qualifier))
    if not target.qualifier:
        return family
    within = qualifier >= F.lit(target.qualifier)
    end = _successor(target.qualifier)
    return family & (within & (qualifier < F.lit(end)) if end is not None else within)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def relevant(spec: IndexSpec) -> Column:
    """The cell's coordinates match any definition, whatever its type."""
    if hasattr(spec.row_mapper, "relevant"):
        return spec.row_mapper.relevant()
    return any_of(matches(t) for t in dict.fromkeys(spec.targets))


def touches_row(spec: IndexSpec) -> Column:
    """Row mode: a cell makes its event count if it is relevant or any delete."""
    return relevant(spec) | F.col("op").isin(DELETE_COLUMN, DELETE_FAMILY, DELETE_ROW)


def relevant_events(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Events of the spec's table with a flag whether row mode looks at them."""
    return (
        cells.filter(of_table(spec))
        .groupBy("event_id", "row_key")
        .agg(F.bool_or(touches_row(spec)).alias("is_relevant"))
    )


def required_columns(spec: IndexSpec) -> list[Target] | None:
    """Columns an event must carry to be mapped alone; None if it never can be."""
    if hasattr(spec.row_mapper, "required"):
        return spec.row_mapper.required()
    targets = list(dict.fromkeys(spec.targets))
    return None if any(t.prefix for t in targets) else targets


def complete_events(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Events with a flag whether they carry every column the spec needs."""
    needed = required_columns(spec)
    if needed is None:
        flag = F.lit(False)
    else:
        flag = reduce(lambda a, b: a & b, [F.bool_or(matches(t) & is_put()) for t in needed], F.lit(True))
    return cells.filter(of_table(spec)).groupBy("event_id", "row_key").agg(flag.alias("is_complete"))
