"""Nearest neighbours and near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from cellindex.llm import embedding_dedup, neighbours
from cellindex.llm.perfect_hash import PerfectHash
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, node long, score double"
ODD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]


def table(spark, vectors, labels, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame(
        [(i, [float(x) for x in v], None if l is None else int(l), 0, 0.0) for i, v, l in zip(ids, vectors, labels)]
        + [(900000 + k, v, 1, 0, 0.0) for k, v in enumerate(ODD)],
        SCHEMA,
    )


def clustered(n, dim, seed=0, labels=3):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((n // 8, dim))
    v = draw.standard_normal((n, dim))
    near = draw.random(n) < 0.5
    noise = draw.choice([0.02, 0.25], n)[:, None]
    v[near] = centres[draw.integers(0, len(centres), near.sum())] + (noise * draw.standard_normal((n, dim)))[near]
    return v.astype(np.float32), draw.integers(0, labels, n)


def test_chi_square():
    assert abs(neighbours.chi_square(neighbours.quantile(0.99, 8), 8) - 0.99) < 1e-9
    assert abs(neighbours.quantile(0.95, 2) + 2 * math.log(0.05)) < 1e-6


@pytest.mark.parametrize("settings", [neighbours.Settings(), neighbours.Settings(cell_rows=40, block_rows=30, block_queries=3, leaf=8)])
def test_neighbours(spark, settings):
    v, labels = clustered(1500, 24)
    rows = table(spark, v, labels)
    got = neighbours.nearest(rows.unionByName(rows.limit(40)), F.col("vec_id") % 10 == 0, settings).collect()
    x = v.astype(np.float64)
    hits = total = 0
    for q in range(0, 1500, 10):
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        order = np.lexsort((np.arange(1500), far))[:10]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert np.allclose([r.score for r in own], far[[r.vec_id for r in own]], rtol=1e-12)
        hits += len({r.vec_id for r in own} & set(order.tolist()))
        total += 10
    assert {r.query_id for r in got} == set(range(0, 1500, 10)) and hits / total >= 0.95


@pytest.mark.parametrize("power", [664, -664, 1010, -1030])
def test_distances_beyond_the_range_of_squares(spark, power):
    """Components far from one give the same neighbours, their distances at that scale, digit by digit."""
    v = clustered(300, 6)[0].astype(np.float64).round(3)
    v[17] = v[5]

    def found(w):
        rows = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(w)], "vec_id long, embedding array<double>")
        return sorted(map(tuple, neighbours.nearest(rows, F.col("vec_id") % 10 == 5).collect()))

    if power == -1030:  # below the smallest normal double, digits are lost before the search
        v = np.round(v * 8)
    plain, scaled = found(v), found(np.ldexp(v, power))
    assert [(q, k, i, math.ldexp(d, power)) for q, k, i, d in plain] == scaled


def test_few_and_no_vectors(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], 1, 0, 0.0), (3, [1.0, 1.0], 1, 0, 0.0), (2, [1.0, 1.0], 1, 0, 0.0), (None, [1.0, 0.0], 1, 0, 0.0), (5, [1.0], 1, 0, 0.0)], SCHEMA)
    got = neighbours.nearest(rows, F.col("vec_id") % 5 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0)]
    assert neighbours.nearest(rows.limit(0), F.lit(True)).collect() == []


def plain_links(rows):
    def unit(r):
        v = r.embedding
        if r.label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float64)
        return a / np.sqrt((a * a).sum())

    units = [unit(r) for r in rows]
    n, near = len(rows), [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i].label == rows[j].label and len(a) == len(b) and a @ b >= 0.93:
                near[i].append(j), near[j].append(i)
    label = [None] * n
    for i in range(n):
        todo = [i] if label[i] is None else []
        while todo:
            k = todo.pop()
            if label[k] is None:
                label[k] = i
                todo += near[k]
    least = {}
    for k, r in zip(label, rows):
        if r.vec_id is not None:
            least[k] = min(least.get(k, r.vec_id), r.vec_id)
    return [(r.vec_id, len(x), least.get(k), least.get(k) == r.vec_id and r.vec_id is not None) for r, x, k in zip(rows, near, label)]


@pytest.mark.parametrize("settings", [
    embedding_dedup.Settings(),
    embedding_dedup.Settings(chunk=60, room=3, tile=16, audit_nodes=100),
])
def test_near_duplicates(spark, settings):
    v, labels = clustered(420, 16, 1)
    v[5], labels[5] = v[4], labels[4]
    v[7], labels[7] = 1e30 * v[6] / np.abs(v[6]).max(), labels[6]
    ids = [None if k in (10, 11) else 1000 - k for k in range(420)]
    rows = table(spark, v, [None if k == 20 else int(x) for k, x in enumerate(labels)], ids)
    rows = rows.unionByName(rows.filter("vec_id = 996"))
    got = embedding_dedup.near_duplicates(rows, settings).collect()
    want = plain_links(rows.collect())
    assert sum(x[1] for x in want) > 100
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_recall_where_chunks_are_small(spark):
    """Refinement and audit make up for hyperplanes that part near vectors."""
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((150, 32))
    v = (np.repeat(centres, 6, axis=0) + 0.12 * draw.standard_normal((900, 32))).astype(np.float32)
    rows = table(spark, v, [1] * 900)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(rows, embedding_dedup.Settings(chunk=30)).collect()}
    want = {x[0]: x for x in plain_links(rows.collect())}
    assert sum(r.n_links for r in got.values()) >= 0.98 * sum(x[1] for x in want.values())
    assert all(got[k].n_links <= x[1] for k, x in want.items())


def test_links_between_tight_groups(spark):
    """Lists that are full of a node's own group do not hide its links with another."""
    draw = np.random.default_rng(8)
    v = []
    for _ in range(20):
        one, other = np.linalg.qr(draw.standard_normal((64, 2)))[0].T
        centres = np.repeat([one, 0.945 * one + np.sqrt(1 - 0.945**2) * other], 8, axis=0)
        v.append(centres + 0.002 * draw.standard_normal((16, 64)))
    rows = table(spark, np.concatenate(v).astype(np.float32), [1] * 320)
    got = embedding_dedup.near_duplicates(rows).collect()
    want = plain_links(rows.collect())
    assert len({x[2] for x in want if x[0] < 320}) == 20
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_pairs_beside_a_hot_group(spark):
    """A large group of near-equal vectors does not outweigh lost pairs, also where search alone does not find them."""
    draw = np.random.default_rng(6)
    hot = draw.standard_normal(32) + 0.005 * draw.standard_normal((300, 32))
    first = draw.standard_normal((250, 32))
    other = draw.standard_normal((250, 32))
    first /= np.linalg.norm(first, axis=1)[:, None]
    other -= (other * first).sum(axis=1)[:, None] * first
    other /= np.linalg.norm(other, axis=1)[:, None]
    second = 0.935 * first + np.sqrt(1 - 0.935**2) * other
    v = np.concatenate([hot, first, second]).astype(np.float32)
    rows = table(spark, v, [1] * 800)
    want = sorted(map(repr, plain_links(rows.collect())))
    # No explored neighbours, one weak turn: what is lost must be seen, and all pairs be compared.
    for settings in (
        embedding_dedup.Settings(chunk=20),
        embedding_dedup.Settings(chunk=20, planes=1, most_planes=1, meet=0.1, rounds=0, audit_nodes=64),
    ):
        got = sorted(map(repr, map(tuple, embedding_dedup.near_duplicates(rows, settings).collect())))
        assert len(set(got) - set(want)) <= (0 if settings.rounds == 0 else 0.02 * 800)


def test_sets_grow_with_hyperplanes():
    settings = embedding_dedup.Settings()
    once = 1 - math.acos(0.93) / math.pi
    assert settings.sets(0) == 1
    assert all((1 - once**bits) ** settings.sets(bits) <= 0.0101 for bits in range(1, 25))


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(table(spark, [], []).limit(0)).collect() == []
    rows = embedding_dedup.near_duplicates(table(spark, [], [])).collect()
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in rows) and len(rows) == len(ODD)


def test_perfect_hash():
    keys = np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64)
    found = PerfectHash.build(keys)
    assert sorted(found.slots(keys).tolist()) == list(range(5000))
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1], np.uint64))
