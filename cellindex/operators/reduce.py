"""Last-wins reductions. All combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellindex.operators import select
from cellindex.operators.skew import HotKeys, lookup_join
from cellindex.functions.keys import key_format
from cellindex.spec import IndexSpec

COORDINATES = ("row_key", "family", "qualifier")


def last_by(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The row with the greatest ``order`` for each key, with all its columns."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(*keys, "_last.*")


def last_event_per_row(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Row mode: the last event of each row that the spec looks at."""
    return (
        cells.filter(select.of_table(spec))
        .filter(select.touches_row(spec))
        .groupBy("row_key")
        .agg(F.max_by("event_id", "seq").alias("event_id"))
    )


def last_cell_per_id(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Column mode: the last relevant cell of each document id, puts and deletes."""
    keys = key_format(spec.key_format, spec.params)
    found = cells.filter(select.of_table(spec)).filter(select.relevant(spec))
    return last_by(found.withColumn("id", keys.cell(*(F.col(c) for c in COORDINATES))), ["id"])


def live_cells(cells: DataFrame) -> DataFrame:
    """The current content of a source table, from its mutation log.

    A cell lives if its last mutation is a put that comes after every delete of
    its row and of its family.
    """
    per_cell = cells.filter(F.col("op").isin(select.PUT, select.DELETE_COLUMN))
    last = last_by(per_cell.select("tbl", *COORDINATES, "value", "op", "seq"), ["tbl", *COORDINATES]).filter(select.is_put())
    return survivors(last, cells, ["tbl", "row_key"], "family")


def survivors(
    live: DataFrame, log: DataFrame, row: Sequence[str], family: str, hot: HotKeys | None = None
) -> DataFrame:
    """Drop rows of ``live`` that a later row or family delete in ``log`` covers."""
    row = list(row)
    by_row = (
        log.filter(F.col("op") == select.DELETE_ROW).groupBy(*row).agg(F.max("seq").alias("_row_end"))
    )
    by_family = (
        log.filter(F.col("op") == select.DELETE_FAMILY)
        .groupBy(*row, family)
        .agg(F.max("seq").alias("_family_end"))
    )
    out = lookup_join(live, by_row, row, "left", [family, "qualifier"], hot)
    out = lookup_join(out, by_family, [*row, family], "left", ["qualifier"], hot)
    never = F.lit(-1)
    return out.filter(
        F.col("seq") > F.greatest(F.coalesce("_row_end", never), F.coalesce("_family_end", never))
    ).drop("_row_end", "_family_end")
