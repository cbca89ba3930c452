"""Joins, numbering and grouping that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellindex.plans.scratch import cut_lineage

# At most this many keys can each hold more than 1/HOT_SHARE of the rows, so the
# list of hot keys is bounded however large the data is.
HOT_SHARE = 256
TRACKED = 8192
# Keys with fewer rows fit into one task anyway.
MIN_HOT_ROWS = 1_000_000
# Values of one group, and their bytes, that are collected into one output row.
MAX_GROUP_VALUES = 100_000
MAX_GROUP_BYTES = 64 << 20
# Up to so many estimated bytes a group cannot be too long for one task; Spark takes 2 ** 63 - 1 for what it cannot estimate.
ONE_TASK_BYTES = 16 << 20
UNKNOWN_BYTES = 2**62


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the keys of ``on`` that hold an outsized share of some table."""

    on: tuple[str, ...]
    hashes: tuple[int, ...]

    def flag(self) -> Column:
        return F.xxhash64(*self.on).isin(list(self.hashes))


def hot_keys(df: DataFrame, on: Sequence[str], min_rows: int | None = None) -> HotKeys:
    """The keys that hold more than 1/HOT_SHARE of ``df``.

    One pass over the key columns: each task sends a bounded frequent-items
    sketch, so nothing is shuffled by key. The sketch only steers placement;
    results do not depend on it.
    """
    key = F.xxhash64(*on).alias("k")
    top = df.select(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(k, {HOT_SHARE}, {TRACKED})").alias("top"),
    ).first()
    floor = max(MIN_HOT_ROWS if min_rows is None else min_rows, top.n // HOT_SHARE)
    return HotKeys(tuple(on), tuple(t["item"] for t in top.top or () if t["count"] > floor))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join ``left`` with a keyed ``right`` (one row per key, or semi / anti).

    A plain join by default: Spark broadcasts a right side that it measures to be
    small, and splits the left side of skewed keys at run time. With ``hot``, found
    by the caller beforehand on all or some of ``on``, rows of those keys are spread
    over many tasks by the ``spread`` columns, and only the matching right rows are repeated.
    """
    on = list(on)
    if hot is None or not hot.hashes:
        return left.join(right, on, how)
    salts = max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot = hot.flag()
    salted = left.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(copies))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos", size: str | None = None
) -> DataFrame:
    """Number the rows of each group from 0 in ``order``, without a task per group.

    The rows are range-partitioned, so a large group spans many tasks. Each
    task numbers its own sorted run; runs of one group are then offset by the
    rows before them. The order columns must tell the rows of a group apart. With
    ``size``, a column of bytes, ``_bytes`` is their sum before each row.
    """
    keys, order = list(keys), list(order)
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    # Written once: both reads below must see the same placement.
    ranged = cut_lineage(ranged, "numbered").withColumn("_run", F.shiftright("_at", 33))
    total = F.sum(size) if size else F.lit(0)
    runs = ranged.groupBy(*keys, "_run").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"), total.alias("_all")
    )
    # A group has at most one run per task, so this window stays small.
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *keys,
        "_run",
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_all_before"),
    )
    out = ranged.join(runs, [*keys, "_run"]).withColumn(name, F.col("_before") + F.col("_at") - F.col("_first"))
    if size:
        own = Window.partitionBy(*keys, "_run").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("_bytes", F.col("_all_before") + F.coalesce(F.sum(size).over(own), F.lit(0)))
    return out.drop("_at", "_run", "_first", "_before", "_all_before")


def with_parts(
    values: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_values: int = MAX_GROUP_VALUES,
    counted: Column | None = None,
    size: Column | None = None,
    max_bytes: int = MAX_GROUP_BYTES,
    large: DataFrame | None = None,
) -> DataFrame:
    """Add ``part``: groups within the limits are part 0, larger ones are cut in order.

    After this, grouping by the keys and ``part`` never gathers more than
    ``max_values`` counted rows, nor (with ``size``, bytes per row) much more than
    ``max_bytes``. Rows that are not ``counted`` fill no parts.

    Where Spark estimates more input than one task should see, rows and bytes are first counted per
    group. Groups within the limits need no numbers; those beyond them that one task should not number, or those that
    ``large`` names (see ``large_groups``), are numbered over many tasks. All others are numbered in the shuffle that
    the grouping needs anyway, and so is a smaller input, and one that Spark cannot estimate.
    """
    keys = list(keys)
    one = F.lit(1) if counted is None else counted.cast("int")
    sized = values.withColumn("_one", one)
    if size is not None:
        sized = sized.withColumn("_size", F.when(F.col("_one") == 1, size).otherwise(0))
    if large is not None:
        rest = _running(sized.join(large, keys, "left_anti"), keys, order, size is not None)
    elif not ONE_TASK_BYTES < _estimated_bytes(values) < UNKNOWN_BYTES:
        return _cut(_running(sized, keys, order, size is not None), max_values, max_bytes, size is not None)
    else:
        some, large = _oversized(sized, keys, max_values, max_bytes if size is not None else None)
        whole = sized.drop("_one", "_size").withColumn("part", F.lit(0).cast("bigint"))
        if large is None:
            return _cut(_running(sized, keys, order, size is not None), max_values, max_bytes, size is not None) if some else whole
        rest = _running(sized.join(large, keys, "left_anti"), keys, order, size is not None) if some else None
    long = sized.filter("_one = 1").join(large, keys, "left_semi")
    long = numbered(long, keys, order, "_pos", "_size" if size is not None else None)
    if rest is None:
        return whole.join(large, keys, "left_anti").unionByName(_cut(long, max_values, max_bytes, size is not None))
    return _cut(rest.unionByName(long), max_values, max_bytes, size is not None)


def _estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's output, which starts no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def tasks_for(df: DataFrame) -> int:
    """How many tasks ``df`` asks for by Spark's estimate of it; one if Spark cannot estimate it."""
    size = _estimated_bytes(df)
    return -(-size // ONE_TASK_BYTES) if 0 < size < UNKNOWN_BYTES else 1


def _oversized(sized: DataFrame, keys: list[str], max_values: int, max_bytes: int | None) -> tuple[bool, DataFrame | None]:
    """Whether groups beyond the limits are there that one task can number, and the keys of the others, stored; None without any.

    One task numbers up to ``MAX_GROUP_VALUES`` rows and ``ONE_TASK_BYTES``. Counts combine before they are shuffled.
    """
    counts = [F.sum("_one").alias("_n"), *([F.sum("_size").alias("_b")] if max_bytes is not None else [])]
    beyond, long = F.col("_n") > max_values, F.col("_n") > MAX_GROUP_VALUES
    if max_bytes is not None:
        beyond, long = beyond | (F.col("_b") > max_bytes), long | (F.col("_b") > ONE_TASK_BYTES)
    counted = sized.groupBy(*keys).agg(*counts)
    found = counted.agg(F.count_if(beyond & ~long).alias("some"), F.count_if(beyond & long).alias("many")).first()
    large = cut_lineage(counted.filter(beyond & long).select(*keys), "large") if found["many"] else None
    return found["some"] > 0, large


def _running(sized: DataFrame, keys: list[str], order: Sequence[str], with_size: bool) -> DataFrame:
    """Counted rows, and their bytes, before each row of its group."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = sized.withColumn("_pos", F.coalesce(F.sum("_one").over(before), F.lit(0)))
    return out.withColumn("_bytes", F.coalesce(F.sum("_size").over(before), F.lit(0))) if with_size else out


def _cut(placed: DataFrame, max_values: int, max_bytes: int, with_size: bool) -> DataFrame:
    """Parts by position, each of them cut again by bytes: both counts stay below their limits."""
    part = F.floor(F.col("_pos") / max_values)
    if with_size:
        # Numbers of both cuts together rise along the group, and name its parts.
        part = part + F.floor(F.col("_bytes") / max_bytes)
    part = F.when(F.col("_one") == 1, part).otherwise(0).cast("bigint")
    return placed.withColumn("part", part).drop("_one", "_pos", *(["_size", "_bytes"] if with_size else []))


def large_groups(values: DataFrame, keys: Sequence[str], min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Keys of the groups of more than ``min_rows`` rows, counted and stored: what one task should not number alone."""
    sizes = values.groupBy(*keys).count().filter(F.col("count") > min_rows)
    return cut_lineage(sizes.select(*keys), "large")


def collect_groups(
    values: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lists: Mapping[str, tuple[Column | None, Column]],
    max_values: int = MAX_GROUP_VALUES,
    counted: Column | None = None,
    totals: Mapping[str, Column] | None = None,
    size: Column | None = None,
    large: DataFrame | None = None,
) -> DataFrame:
    """Collect ordered lists per group, in parts of bounded numbers of rows and bytes.

    ``lists`` maps an output column to (row condition, value). A group within
    the limits gives one row with ``part`` 0; a larger one continues in further
    parts, so the result is whole and no task holds an unbounded group.
    ``counted`` marks the rows that carry values; others only make their group
    exist. ``totals`` are plain aggregates taken per part. For ``size`` and
    ``large`` see ``with_parts``.
    """
    aggs = []
    for name, (condition, value) in lists.items():
        item = F.struct(*order, value.alias("_value"))
        if condition is not None:
            item = F.when(condition, item)
        aggs.append(F.sort_array(F.collect_list(item))["_value"].alias(name))
    aggs += [agg.alias(name) for name, agg in (totals or {}).items()]
    parts = with_parts(values, keys, order, max_values, counted, size, large=large)
    return parts.groupBy(*keys, "part").agg(*aggs)
