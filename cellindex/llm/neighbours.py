"""Nearest neighbours by a low-dimensional stable projection, a kd-tree and a chi-square test.

Vectors are projected on a few normally distributed directions. For a vector at
distance d, the squared projected distance over d squared follows a chi-square
distribution, so a query may stop once the projected distance of all that is left is
so large that a neighbour better than its k-th best would have been seen before
with the wanted probability. A kd-tree in the projected space gives what is left in
ascending order of projected distance.

The upper part of the tree is fitted on a bounded sample; its cells, split by hash
if they are large, are what tasks hold. A query first searches its own cell and
then those other cells that the test cannot rule out, each with a tree of its
own. Every row is indexed. The answer of a query is merged from at most k rows per
cell.

Distances are Euclidean, in double precision, between the given vectors, also where squares of components leave the range
of doubles; a pair whose distance itself leaves it is not found. Rows whose vector is null, empty, zero
or has null or non-finite components take no part, nor do rows with a null id.
Equal rows count once; a query does not meet rows of its own id. Vectors of
different lengths are not compared. Ties go to the smaller id. Empty tables give empty results, fewer candidates
than k all of them. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellindex.llm.shared import stored
from cellindex.llm.vectors import lists, matrix, usable


@dataclass(frozen=True)
class Settings:
    k: int = 10
    #: Directions; an even number, for which the chi-square distribution has a closed form.
    directions: int = 8
    #: Probability with which each true neighbour is seen before the search stops.
    sure: float = 0.99
    leaf: int = 32
    cell_rows: int = 256
    most_cells: int = 1024
    #: Rows that the upper tree is fitted on, at most.
    sample_rows: int = 8_192
    #: Rows, and queries, in one search task.
    block_rows: int = 50_000
    block_queries: int = 2_000
    seed: int = 11


def chi_square(x: float, m: int) -> float:
    """Distribution function for an even number of degrees."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, m) < p else (low, middle)
    return high


def directions(dim: int, settings: Settings) -> np.ndarray:
    return np.random.default_rng((settings.seed, dim)).standard_normal((dim, settings.directions))


def split(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Axis and value of each inner node of a kd-tree of equal depth, in heap order: the median of the widest axis."""
    nodes, parts = [], [points]
    for _ in range(depth):
        below = []
        for p in parts:
            axis = int(np.argmax(np.ptp(p, axis=0))) if len(p) else 0
            value = float(np.median(p[:, axis])) if len(p) else 0.0
            nodes.append((axis, value))
            below += [p[p[:, axis] <= value], p[p[:, axis] > value]] if len(p) else [p, p]
        parts = below
    return nodes


def cell_of(points: np.ndarray, nodes: list[tuple[int, float]], depth: int) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    axes = np.array([a for a, _ in nodes] or [0])
    values = np.array([v for _, v in nodes] or [0.0])
    rows = np.arange(len(points))
    for _ in range(depth):
        at = 2 * at + 1 + (points[rows, axes[at]] > values[at])
    return at - (2**depth - 1)


class Tree:
    """Leaves of a kd-tree: the order of the points, where each leaf ends, and its box."""

    def __init__(self, points: np.ndarray, leaf: int):
        parts, done = [np.arange(len(points))], []
        while parts:
            own = parts.pop()
            if len(own) <= leaf:
                done.append(own)
                continue
            p = points[own]
            axis = int(np.argmax(np.ptp(p, axis=0)))
            order = own[np.argsort(p[:, axis], kind="stable")]
            parts += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.leaves = done
        self.low = np.array([points[x].min(axis=0) for x in done])
        self.high = np.array([points[x].max(axis=0) for x in done])


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distances of points from boxes, shape (points, boxes); none is rounded up from a square that is too small."""
    largest = max((float(np.abs(x).max(initial=0)) for x in (points, low, high)))
    scale = math.ldexp(1.0, math.frexp(largest)[1] - 1) if largest else 1.0
    points, low, high = points / scale, low / scale, high / scale
    total = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        p = points[:, axis, None]
        total += np.maximum(0, np.maximum(low[None, :, axis] - p, p - high[None, :, axis])) ** 2
    return np.sqrt(total) * scale


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances, shape (queries, rows).

    Sums of squares beyond the range of doubles are taken again at a scale of their own, a power of two, which
    changes no digit of the others.
    """
    with np.errstate(over="ignore", under="ignore"):
        apart = queries[:, None, :] - rows[None, :, :]
        squares = (apart**2).sum(axis=2)
        found = np.sqrt(squares)
        q, r = np.nonzero((squares < 1e-200) | ~np.isfinite(squares))
        if len(q):
            few = apart[q, r]
            # Half a power less, so that it is a double where the largest component is.
            power = np.frexp(np.abs(few).max(axis=1))[1] - 1
            few = np.ldexp(few, -power[:, None])
            found[q, r] = np.ldexp(np.sqrt((few**2).sum(axis=1)), power)
    return found


def search(
    ids: np.ndarray,
    vectors: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    bound: np.ndarray,
    settings: Settings,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query numbers, ids and distances of at most k neighbours each, none beyond ``bound``."""
    k, stop = settings.k, math.sqrt(quantile(settings.sure, settings.directions))
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], vectors[by_id]
    matrix_ = directions(vectors.shape[1], settings)
    points = vectors @ matrix_
    tree = Tree(points, settings.leaf)
    best = np.full((len(queries), k), np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    projected = queries @ matrix_
    far = box_distance(projected, tree.low, tree.high)
    order = np.argsort(far, axis=1, kind="stable")
    alive = np.arange(len(queries))
    for turn in range(order.shape[1]):
        leaf = order[alive, turn]
        # The test: what is left has a projected distance of this much at least.
        reach = np.minimum(best[alive, -1], bound[alive])
        go = far[alive, leaf] <= stop * reach
        alive, leaf = alive[go], leaf[go]
        if not len(alive):
            break
        for one in np.unique(leaf):
            rows, asked = tree.leaves[one], alive[leaf == one]
            step = max(1, 4_000_000 // (len(rows) * vectors.shape[1]))
            for i in range(0, len(asked), step):
                q = asked[i : i + step]
                d = distances(queries[q], vectors[rows])
                d[ids[rows][None, :] == query_ids[q][:, None]] = np.inf
                both = np.concatenate([best[q], d], axis=1)
                names = np.concatenate([best_id[q], np.broadcast_to(ids[rows], d.shape)], axis=1)
                names[~np.isfinite(both)] = np.iinfo(np.int64).max
                take = np.lexsort((names, both), axis=1)[:, :k]
                best[q] = np.take_along_axis(both, take, axis=1)
                best_id[q] = np.take_along_axis(names, take, axis=1)
    found = np.isfinite(best) & (best <= bound[:, None])
    return np.nonzero(found)[0], best_id[found], best[found]


def _prepared(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    rows = vectors.select(vectors[key].cast("long").alias("vec_id"), vectors[vector].alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("v", F.col("v").cast("array<double>"))
    return rows.distinct().withColumn("dim", F.size("v"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    settings: Settings = Settings(),
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k nearest rows found of each row for which ``is_query`` (on column ``vec_id``) holds.

    Columns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the distance.
    """
    rows = stored(_prepared(vectors, key, vector), "vectors")
    out = None
    # Almost always one; each length of vectors has an index of its own.
    for dim, count in sorted((r["dim"], r["count"]) for r in rows.groupBy("dim").count().collect()):
        found = _nearest(rows.filter(F.col("dim") == dim).drop("dim"), is_query, dim, count, settings)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = out.withColumn("rank", F.row_number().over(ranked).cast("int")).filter(F.col("rank") <= settings.k)
    return out.select("query_id", "rank", "vec_id", "score")


def _nearest(rows: DataFrame, is_query: Column, dim: int, count: int, settings: Settings) -> DataFrame:
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(settings.sample_rows).select("v").toArrow()
    cells = min(settings.most_cells, max(1, count // settings.cell_rows), max(1, len(sample) // 16))
    depth = int(math.log2(cells))
    to_points = directions(dim, settings)
    nodes = split(matrix(sample["v"]) @ to_points, depth)

    def place(batches):
        for batch in batches:
            v = matrix(batch.column("v"))
            points = v @ to_points
            columns = [*batch.columns, pa.array(cell_of(points, nodes, depth)), lists(points)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "p"])

    placed = stored(rows.mapInArrow(place, "vec_id long, v array<double>, cell long, p array<double>"), "cells")
    axes = range(settings.directions)
    measures = [f(F.col("p")[a]).alias(f"{n}{a}") for a in axes for n, f in (("low", F.min), ("high", F.max))]
    # One row per cell, of which there are most_cells at most.
    known = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *measures).orderBy("cell").collect()
    numbers = np.array([r["cell"] for r in known], np.int64)
    low = np.array([[r[f"low{a}"] for a in axes] for r in known])
    high = np.array([[r[f"high{a}"] for a in axes] for r in known])
    blocks = {r["cell"]: -(-r["n"] // settings.block_rows) for r in known}
    stop = math.sqrt(quantile(settings.sure, settings.directions))

    block_count = F.coalesce(F.create_map(*[F.lit(int(x)) for kv in blocks.items() for x in kv])[F.col("cell")], F.lit(1))
    candidates = placed.select(
        "cell", F.pmod(F.xxhash64("vec_id"), block_count).cast("int").alias("block"), "vec_id", "v"
    )
    queries = placed.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "p", "cell")

    def ask(asked: DataFrame) -> DataFrame:
        """Search blocks of rows for ``asked``: query_id, q, cell, bound."""
        per_cell = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / settings.block_queries).cast("int").alias("parts"))
        # Both tables have one row per cell at most.
        part = F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part")
        left = asked.join(F.broadcast(per_cell), "cell").select(
            F.col("cell").alias("asked_cell"), part, F.explode(F.sequence(F.lit(0), block_count - 1)).alias("block"), "query_id", "q", "bound"
        )
        right = candidates.join(F.broadcast(per_cell), "cell").select(
            F.col("cell").alias("own_cell"), F.col("block").alias("own_block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own_part"), "vec_id", "v"
        )

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            if not a.num_rows or not b.num_rows:
                which, ids, far = (np.zeros(0, t) for t in (np.int64, np.int64, np.float64))
            else:
                which, ids, far = search(
                    b["vec_id"].to_numpy(), matrix(b["v"]), a["query_id"].to_numpy(), matrix(a["q"]), a["bound"].to_numpy(), settings
                )
            return pa.table({"query_id": a["query_id"].to_numpy()[which], "vec_id": ids, "score": far})

        here, there = left.groupBy("asked_cell", "block", "part"), right.groupBy("own_cell", "own_block", "own_part")
        return here.cogroup(there).applyInArrow(run, "query_id long, vec_id long, score double")

    home = stored(ask(queries.select("query_id", "q", "cell", F.lit(float("inf")).alias("bound"))), "home")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    kth = home.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") == settings.k)
    kth = kth.select("query_id", F.col("score").alias("bound"))
    bounded = queries.join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def route(batches):
        for batch in batches:
            far = box_distance(matrix(batch.column("p")), low, high)
            bound = batch.column("bound").to_numpy()
            go = (far <= stop * bound[:, None]) & (numbers[None, :] != batch.column("cell").to_numpy()[:, None])
            row, cell = np.nonzero(go)
            for i in range(0, len(row), 5000):
                take = pa.array(row[i : i + 5000])
                columns = [batch.column(c).take(take) for c in ("query_id", "q", "bound")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(numbers[cell[i : i + 5000]])], names=["query_id", "q", "bound", "cell"]
                )

    others = bounded.mapInArrow(route, "query_id long, q array<double>, bound double, cell long")
    return home.unionByName(ask(others))
