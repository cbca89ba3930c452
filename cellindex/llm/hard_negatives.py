"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors become whole numbers, and a score is the whole inner product with an
anchor. All rows are laid out as Parquet blocks: of one label, in the order of a
Hilbert curve through the dimensions of largest spread, each with the minimum and
maximum of every dimension. For an anchor, interval arithmetic on these gives
the least and the largest score that a block can hold. A block is read for the
anchor's positives if it may hold one above the worst of its own block, and for the
windows of its hard negatives if its interval and the window meet. Anchors go in
groups of neighbours on the curve, and a group meets the zone maps in pages and
the blocks chosen in parts, so no task holds more than these.

Rows of a null id or label, of a null vector or with a null or infinite component
take no part; nor do those whose scores might not fit a long: with a
component that reaches ``sqrt(2**63 / dimensions)`` when it is whole. Zero
vectors take part, vectors of several lengths meet only their like, and rows that
repeat an id are rows of their own. Anchors without positives, or whose windows are empty, have no
rows. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellindex.llm.shared import stored

#: Rows that say which dimensions and levels the curve uses; they decide how rows lie, not what is found.
SAMPLE = 4096
NONE, ALL = np.iinfo(np.int64).min, np.iinfo(np.int64).max
BLOCKS = "block long, dims int, label string, n int, first long, ids binary, vectors binary, kind string, low binary, high binary, anchors binary"


@dataclass(frozen=True)
class Settings:
    """``low`` and ``high`` bound a negative's score in percent of the positive's."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    scale: int = 256
    block: int = 256
    anchors: int = 512
    page: int = 4096
    part: int = 64
    axes: int = 12
    bits: int = 5


# The curve


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of cell numbers below ``2 ** bits``; rows times bits fit in 63.

    Skilling's published transform: undo the turns of the sub-cubes from the largest down, then Gray code.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        q = np.int64(1) << level
        for i in range(n):
            turned = (x[:, i] & q) != 0
            swapped = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(turned, q - 1, swapped)
            x[:, i] ^= swapped
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    place = np.zeros(len(x), np.int64)
    for level in reversed(range(bits)):
        for i in range(n):
            place = place << 1 | (x[:, i] >> level & 1)
    return place


@dataclass(frozen=True)
class Curve:
    """The dimensions a curve runs through, and the edges of its cells on each."""

    axes: list[int]
    edges: list[list[float]]
    bits: int

    @staticmethod
    def fit(rows: list[list[int]], settings: Settings) -> "Curve":
        if not rows:
            return Curve([], [], settings.bits)
        dims = min(map(len, rows))
        sample = np.array([r[:dims] for r in rows], np.float64).reshape(len(rows), dims)
        axes = np.argsort(-sample.std(axis=0), kind="stable")[: settings.axes]
        levels = np.arange(1, 1 << settings.bits) / (1 << settings.bits)
        # Cells of equal width, so that clusters stay apart whatever their sizes.
        ends = [np.quantile(sample[:, a], (0.01, 0.99)) for a in axes]
        return Curve(axes.tolist(), [(low + (high - low) * levels).tolist() for low, high in ends], settings.bits)

    def places(self, rows: np.ndarray) -> np.ndarray:
        if not self.axes or rows.shape[1] <= max(self.axes):
            return np.zeros(len(rows), np.int64)
        cells = [np.searchsorted(e, rows[:, a], side="right") for a, e in zip(self.axes, self.edges)]
        return hilbert(np.stack(cells, axis=1), self.bits)


# Vectors in tasks


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _smallest(values: np.ndarray) -> str:
    most = int(np.abs(values).max(initial=0))
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products of the rows of both, exact; in floating point where that is exact too."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each row of ``a`` with any vector between the rows of ``low`` and ``high``."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _best(scores: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of scores and window of that row, the columns of the ``k`` largest scores within, ties in column order.

    Returns columns and scores; where there are fewer the score is ``NONE``.
    """
    order = np.argsort(~scores, axis=1, kind="stable")
    falling = np.take_along_axis(scores, order, axis=1)
    above = (falling[:, None, :] > high[:, :, None]).sum(axis=2)
    at = above[:, :, None] + np.arange(k)
    there = at < scores.shape[1]
    at = np.minimum(at, scores.shape[1] - 1)
    rows = np.arange(len(scores))[:, None, None]
    found = falling[rows, at]
    return order[rows, at], np.where(there & (found >= low[:, :, None]), found, NONE)


# Layout


def _prepared(rows: DataFrame, anchor: Column, settings: Settings, key: str, label: str, vector: str) -> DataFrame:
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * settings.scale))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * settings.scale) + 1 < F.sqrt(F.lit(2.0**63) / F.size(vector)))
    good = rows.filter(rows[key].isNotNull() & rows[label].isNotNull() & F.coalesce(finite & fits, F.lit(False)))
    return good.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.size(vector).alias("dims"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), whole.alias("vector"),
    )


def _placed(rows: DataFrame, curve: Curve) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.zeros(batch.num_rows, np.int64)
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                places[own] = curve.places(_matrix(batch.column("vector").take(pa.array(own))))
            yield batch.append_column("place", pa.array(places))

    return rows.mapInArrow(run, "id long, label string, dims int, anchor boolean, vector array<long>, place long")


def _blocks(placed: DataFrame, size: int) -> DataFrame:
    """Rows of one label in the order of the curve, cut into blocks that know their bounds."""
    order = ["dims", "label", "place", "id"]
    lined_up = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def block(rows: pa.Table, first: int) -> list:
        vectors = _matrix(rows.column("vector").combine_chunks())
        ids = rows.column("id").to_numpy()
        by_id = np.argsort(ids, kind="stable")  # ties of scores go to the smaller id
        kind = _smallest(vectors)
        bounds = [f(axis=0).astype("<i8").tobytes() for f in (vectors.min, vectors.max)]
        anchors = rows.column("anchor").to_numpy()[by_id].astype(np.uint8).tobytes()
        return [
            first, rows.column("dims")[0].as_py(), rows.column("label")[0].as_py(), len(ids), first,
            ids[by_id].astype("<i8").tobytes(), vectors[by_id].astype(kind).tobytes(), kind, *bounds, anchors,
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 40, None
        names = [x.split()[0] for x in BLOCKS.split(", ")]
        types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 2, pa.string(), *[pa.binary()] * 3]
        for batch in (*batches, None):
            rows = pa.Table.from_batches([batch]) if batch is not None else None
            if held is not None:
                rows = pa.concat_tables([held, rows]) if rows is not None else held
            if rows is None or not rows.num_rows:
                continue
            label, dims = rows.column("label").to_numpy(), rows.column("dims").to_numpy()
            new = np.flatnonzero((label[1:] != label[:-1]) | (dims[1:] != dims[:-1])) + 1
            cuts = [0]
            for stop in (*new.tolist(), rows.num_rows):
                cuts += [*range(cuts[-1] + size, stop, size), stop]
            ready, held = cuts, None
            if batch is not None:  # the last block may go on
                ready, held = cuts[:-1], rows.slice(cuts[-2])
            out = []
            for a, b in zip(ready, ready[1:]):
                out.append(block(rows.slice(a, b - a), first))
                first += b - a
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return lined_up.mapInArrow(run, BLOCKS)


def _unpacked(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and vectors of a block."""
    ids = np.frombuffer(block.ids, "<i8")
    return block.first + np.arange(block.n), ids, np.frombuffer(block.vectors, block.kind).astype(np.int64).reshape(block.n, block.dims)


ANCHORS = "row long, anchor_id long, label string, dims int, place long, vector binary, low array<long>, high array<long>"


def _anchors(blocks: DataFrame, curve: Curve, k: int) -> DataFrame:
    """The anchors with one window: from the worst score that the best of its own block gives a positive."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block in frame.itertuples(index=False):
                rows, ids, vectors = _unpacked(block)
                own = np.flatnonzero(np.frombuffer(block.anchors, np.uint8))
                scores = products(vectors[own], vectors)
                scores[np.arange(len(own)), own] = NONE
                low = np.sort(scores, axis=1)[:, -k] if block.n > k else np.full(len(own), NONE)
                yield pd.DataFrame(
                    {
                        "row": rows[own], "anchor_id": ids[own], "label": block.label, "dims": block.dims,
                        "place": curve.places(vectors[own]), "vector": [v.astype("<i8").tobytes() for v in vectors[own]],
                        "low": [[int(x)] for x in low], "high": [[int(ALL)] for _ in own],
                    }
                )

    some = blocks.filter(F.instr(F.hex("anchors"), "01") > 0).select("block", "dims", "label", "n", "first", "ids", "vectors", "kind", "anchors")
    return some.mapInPandas(run, ANCHORS)


def _grouped(anchors: DataFrame, size: int) -> DataFrame:
    """Give stored anchors a ``team``: neighbours on the curve of one vector length, about ``size`` of them.

    The edges of teams are a number for each team, and so is the count by which a place shared by many is split.
    """
    count = anchors.count()
    teams = -(-count // size)
    edges = sorted(set(anchors.approxQuantile("place", [k / teams for k in range(1, teams)], 0.1 / teams))) if teams > 1 else []

    @F.pandas_udf("long")
    def bucket(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(edges), place.to_numpy(), side="right"))

    placed = anchors.withColumn("bucket", bucket("place"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    split = placed.join(sizes, "bucket").withColumn("split", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / (2 * size))))
    return split.withColumn("team", F.xxhash64("dims", "bucket", "split")).drop("bucket", "n", "split", "place")


# Choosing and reading


def _needed(anchors: pd.DataFrame, zones: pd.DataFrame, same: bool) -> np.ndarray:
    """Which blocks (columns) each anchor's windows must read."""
    dims = int(zones["dims"].iloc[0])
    own, (low, high) = _vectors(anchors, dims), (_stack(zones[c], dims) for c in ("low", "high"))
    least, most = intervals(own, low, high)
    starts, ends = _stack_lists(anchors["low"]), _stack_lists(anchors["high"])
    meets = ((most[:, None, :] >= starts[:, :, None]) & (least[:, None, :] <= ends[:, :, None])).any(axis=1)
    alike = anchors["label"].to_numpy()[:, None] == zones["label"].to_numpy()[None, :]
    return meets & (alike if same else ~alike)


def _vectors(anchors: pd.DataFrame, dims: int) -> np.ndarray:
    return _stack(anchors["vector"], dims)


def _stack(column: pd.Series, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8").reshape(len(column), dims)


def _stack_lists(column: pd.Series) -> np.ndarray:
    return np.array([list(x) for x in column], np.int64)


def _choose(anchors: DataFrame, blocks: DataFrame, pages: int, same: bool) -> DataFrame:
    """Pairs of a team and a block that some window of it must read, from the zone maps alone."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page")
    zones = blocks.select("block", "dims", "label", "low", "high", F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int").alias("page"))
    teams = anchors.select(F.col("team").alias("team"), "dims").distinct()  # a name of its own, for the cogroup
    met = zones.join(teams, "dims")

    def run(some: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(zones):
            return pd.DataFrame({"team": [], "block": []}, dtype="int64")
        hit = _needed(some, zones, same).any(axis=0)
        return pd.DataFrame({"team": int(some["team"].iloc[0]), "block": zones["block"].to_numpy()[hit]})

    spread = anchors.select("team", "label", "vector", "low", "high", numbers)
    return spread.groupBy("team", "page").cogroup(met.groupBy("team", "page")).applyInPandas(run, "team long, block long")


FOUND = "row long, window int, found_row long, found_id long, score long"


def _read(anchors: DataFrame, blocks: DataFrame, chosen: DataFrame, parts: int, same: bool, k: int) -> DataFrame:
    """The best ``k`` rows of each window, first in every part, then of all."""
    part = F.pmod(F.xxhash64("block", F.lit(7)), F.lit(parts)).cast("int").alias("part")
    chosen = chosen.select("team", "block", part)
    payload = chosen.join(blocks.drop("anchors"), "block")
    own = chosen.select(F.col("team").alias("team"), F.col("part").alias("part")).distinct()
    spread = own.join(anchors, "team")

    def run(some: pd.DataFrame, payload: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in FOUND.split(", ")})
        if not len(some) or not len(payload):
            return empty
        own, rows = _vectors(some, int(payload["dims"].iloc[0])), some["row"].to_numpy()
        low, high = _stack_lists(some["low"]), _stack_lists(some["high"])
        needed = _needed(some, payload, same)
        shape = (*low.shape, k)
        best, ids, found = np.full(shape, NONE), np.full(shape, ALL), np.full(shape, ALL)
        for at, block in enumerate(payload.itertuples(index=False)):
            here = np.flatnonzero(needed[:, at])
            if not len(here):
                continue
            numbers, names, vectors = _unpacked(block)
            scores = products(own[here], vectors)
            if same:  # an anchor is no positive of itself
                scores[rows[here][:, None] == numbers[None, :]] = NONE
            columns, values = _best(scores, low[here], high[here], k)
            missing = values == NONE
            both = [
                np.concatenate(x, axis=2)
                for x in (
                    (best[here], values),
                    (ids[here], np.where(missing, ALL, names[columns])),
                    (found[here], np.where(missing, ALL, numbers[columns])),
                )
            ]
            order = _order(*both)[:, :, :k]
            best[here], ids[here], found[here] = (np.take_along_axis(x, order, axis=2) for x in both)
        a, w, j = np.nonzero(best != NONE)
        return pd.DataFrame({"row": rows[a], "window": w.astype(np.int32), "found_row": found[a, w, j], "found_id": ids[a, w, j], "score": best[a, w, j]})

    return spread.groupBy("team", "part").cogroup(payload.groupBy("team", "part")).applyInPandas(run, FOUND)


def _order(score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Largest scores first, then smaller ids, then smaller rows; ``~`` reverses whole numbers without overflow."""
    return np.lexsort((rows, ids, ~score), axis=2)


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best ``k`` of each group with their ``rank``, from a few for each part."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id", "found_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _ceil_percent(score: Column, percent: int) -> Column:
    """The least whole number at or above a percentage, without overflow; scores are below ``2 ** 63``."""
    exact = score.cast("decimal(30,0)") * percent
    return F.ceil(exact / 100).cast("decimal(30,0)")


def _window_bounds(positives: DataFrame, settings: Settings) -> DataFrame:
    """Per anchor the bounds of the windows of its positives, in order, none wider than a long."""
    bound = lambda c: F.least(F.greatest(c, F.lit(NONE + 1).cast("decimal(30,0)")), F.lit(ALL).cast("decimal(30,0)")).cast("long")
    low = bound(_ceil_percent(F.col("score"), settings.low))
    high = bound(-_ceil_percent(-F.col("score").cast("decimal(30,0)"), settings.high))
    listed = F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high"))))
    padded = F.array_repeat(F.struct(F.lit(0).alias("rank"), F.lit(ALL).alias("low"), F.lit(NONE + 1).alias("high")), settings.positives)
    whole = positives.groupBy("row").agg(listed.alias("w"))
    whole = whole.select("row", F.slice(F.concat("w", padded), 1, settings.positives).alias("w"))
    return whole.select("row", F.col("w.low").alias("low"), F.col("w.high").alias("high"))


def mine(
    rows: DataFrame,
    anchor: Column,
    settings: Settings = Settings(),
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """Per anchor, positive and rank a hard negative, with both scores.

    Positives are an anchor's best other rows of its label; hard negatives the best rows of other labels
    whose score lies in the window that the positive's score opens.
    """
    good = _prepared(rows, anchor, settings, key, label, vector)
    # A bounded sample that only lays out the curve.
    sample = good.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    curve = Curve.fit([r["vector"] for r in sample], settings)
    blocks = stored(_blocks(_placed(good, curve), settings.block), "blocks")
    anchors = stored(_grouped(stored(_anchors(blocks, curve, settings.positives), "anchors"), settings.anchors), "teams")
    count = blocks.count()
    pages, parts = max(1, -(-count // settings.page)), max(1, -(-count // settings.part))

    chosen = stored(_choose(anchors, blocks, pages, True), "chosen")
    positives = _top(_read(anchors, blocks, chosen, parts, True, settings.positives), ["row"], settings.positives)
    positives = stored(positives.select("row", "rank", F.col("found_id").alias("positive_id"), "score"), "positives")

    windows = stored(anchors.drop("low", "high").join(_window_bounds(positives, settings), "row"), "windows")
    chosen = stored(_choose(windows, blocks, pages, False), "chosen")
    negatives = _top(_read(windows, blocks, chosen, parts, False, settings.negatives), ["row", "window"], settings.negatives)
    best = positives.select("row", (F.col("rank") - 1).alias("window"), "positive_id", F.col("score").alias("positive_score"))
    out = negatives.join(best, ["row", "window"]).join(anchors.select("row", "anchor_id"), "row")
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def sql(label: str) -> str:
    """The registered query in DuckDB's SQL; ``label`` is the expression of the label that counts."""
    score = "CAST(list_dot_product(a.v, c.v) AS BIGINT)"
    return f"""WITH r AS (
  SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM r WHERE vec_id % 100 = 0),
p AS (SELECT a.vec_id AS anchor_id, a.label, a.v, c.vec_id AS positive_id, {score} AS positive_score
  FROM a JOIN r c ON a.label = c.label AND a.vec_id <> c.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, c.vec_id) <= 5),
n AS (SELECT a.vec_id AS anchor_id, c.vec_id AS negative_id, {score} AS negative_score FROM a JOIN r c ON a.label <> c.label),
m AS (SELECT anchor_id, positive_id, negative_id, positive_score, negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank
  FROM p JOIN n USING (anchor_id)
  WHERE 80 * positive_score <= 100 * negative_score AND 100 * negative_score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 5"""
