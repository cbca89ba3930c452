import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellindex.llm.hard_negatives import ALL, NONE, Settings, _best, hilbert, intervals, mine, products

SCHEMA = "vec_id long, embedding array<double>, label int, row long, team int, score double, `a.b` int, place string"


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (5, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    place = hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_all_scores():
    draw = np.random.default_rng(2)
    for big in (10, 1 << 28):
        a, rows = draw.integers(-big, big, (7, 6)), draw.integers(-big, big, (50, 6))
        least, most = intervals(a, rows.min(axis=0)[None], rows.max(axis=0)[None])
        scores = products(a, rows)
        assert scores.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in rows] for r in a]
        assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()


def test_best_of_windows():
    scores = np.array([[5, 9, 5, 1, NONE]])
    columns, found = _best(scores, np.array([[2, NONE + 1, 6]]), np.array([[9, 5, 8]]), 2)
    assert found[0].tolist() == [[9, 5], [5, 5], [NONE, NONE]]
    assert columns[0, 0].tolist() == [1, 0] and columns[0, 1].tolist() == [0, 2]


def plain(rows, anchor, low=80, high=100, k=5):
    """All pairs, with rows apart even where ids repeat."""
    good = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if all(abs(x * 256) + 1 < math.sqrt(2.0**63 / len(vector)) for x in vector):
            good.append((vec_id, label, [math.floor(256 * x) for x in vector]))

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    out = []
    for n, a in enumerate(good):
        if not anchor(a[0]):
            continue
        like = [(m, b) for m, b in enumerate(good) if len(b[2]) == len(a[2])]
        own = sorted((-score(a, b), b[0], m) for m, b in like if b[1] == a[1] and m != n)[:k]
        for s, p, _ in own:
            some = sorted((-score(a, b), b[0]) for _, b in like if b[1] != a[1] and low * -s <= 100 * score(a, b) <= high * -s)[:k]
            out += [(a[0], p, r + 1, b, -s, -t) for r, (t, b) in enumerate(some)]
    return sorted(out)


def cloud(n, seed, dims=6, labels=3):
    """Clusters with copies, so that scores tie, near a few centres."""
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        spread = draw.choice([0.0, 0.02, 0.3])
        rows.append((i, [c + draw.gauss(0, spread) for c in draw.choice(centres)], draw.randrange(labels)))
    return rows


ODD = [
    (None, [0.1] * 6, 1), (400, None, 1), (402, [0.1, None] * 3, 1), (404, [float("nan")] * 6, 1), (406, [float("inf")] * 6, 2),
    (408, [1e200] * 6, 1), (410, [1e-200] * 6, 1), (412, [0.0] * 6, 0), (414, [0.1] * 6, None), (416, [0.3, 0.4], 1), (418, [0.3, 0.5], 1),
    (420, [0.2, 0.5], 2), (422, [1e6] * 6, 1), (424, [9e5] * 6, 1), (426, [8.9e5] * 6, 2), (0, [0.5] * 6, 1), (0, [0.5] * 6, 1), (0, [0.5] * 6, 2),
    (428, [], 1), (430, [], 2),
]


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, 0.5, 1, "x") for r in rows], SCHEMA)


def mined(df, settings=Settings()):
    return sorted(map(tuple, mine(df, F.col("vec_id") % 2 == 0, settings).collect()))


@pytest.mark.parametrize(
    "settings",
    [Settings(), Settings(block=3, anchors=30, page=20, part=20, axes=3, bits=2), Settings(2, 3, 50, 120, block=1, anchors=40, part=60)],
)
def test_against_all_pairs(spark, settings):
    rows = cloud(110, 3) + ODD
    got = mined(table_of(spark, rows), settings)
    if settings.positives == settings.negatives:
        assert got == plain(rows, lambda i: i % 2 == 0)
    else:
        expected = [r for r in plain(rows, lambda i: i % 2 == 0, 50, 120, 200) if r[2] <= 3]
        assert set(got) <= set(expected) and {r[0] for r in got} <= {r[0] for r in expected}


def test_bounds_spare_blocks(spark):
    """Far clusters are not read: their intervals miss every window."""
    from cellindex.llm import hard_negatives as h

    draw = random.Random(5)
    rows = []
    for i in range(600):
        centre = [3.0 * (i % 6 == k) for k in range(6)]
        rows.append((i, [c + draw.gauss(0, 0.02) for c in centre], i // 6 % 2))
    settings = Settings(block=10, anchors=10)
    good = h._prepared(table_of(spark, rows), F.col("vec_id") % 10 == 0, settings, "vec_id", "label", "embedding")
    curve = h.Curve.fit([r.vector for r in good.collect()], settings)
    blocks = h.stored(h._blocks(h._placed(good, curve), 10), "blocks")
    anchors = h.stored(h._grouped(h.stored(h._anchors(blocks, curve, 5), "anchors"), 10), "teams")
    pairs = anchors.select("team").distinct().count() * blocks.count()
    assert 0 < h._choose(anchors, blocks, 2, True).count() < pairs / 3


def test_empty_and_alone(spark):
    assert mined(table_of(spark, [])) == []
    assert mined(table_of(spark, ODD[:6])) == []
    assert mined(table_of(spark, [(2, [0.5], 1)])) == []
    assert mined(table_of(spark, [(2, [0.5], 1), (4, [0.5], 1), (5, [0.5], 0)])) == [(2, 4, 1, 5, 16384, 16384), (4, 2, 1, 5, 16384, 16384)]
    assert ALL > 0 > NONE
