import random

import numpy as np
import pytest

from cellindex.llm import bitslice, simhash
from cellindex.llm.components import components
from tests.llm.conftest import DOCS, rows_of, words

xxhash = pytest.importorskip("xxhash")


def plain_print(text, size):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, linked):
    """Smallest id reachable for each row; ``linked`` judges two rows."""
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and linked(rows[i], rows[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for k, r in zip(label, rows):
        if r.doc_id is not None:
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    return [least.get(k) for k in label]


def similar(a, b, size=5):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(text, seed, n):
    draw, w = random.Random(seed), text.split()
    for _ in range(n):
        w[draw.randrange(len(w))] = f"new{draw.randrange(1000)}"
    return " ".join(w)


@pytest.mark.parametrize("radius", [0, 4, 10])
def test_distances_in_planes(radius):
    draw = np.random.default_rng(1)
    centre = draw.integers(0, 2**63, size=20, dtype=np.uint64)
    fp = draw.choice(centre, 700)
    for _ in range(7):
        fp = fp ^ (np.uint64(1) << draw.integers(0, 64, 700).astype(np.uint64))
    bounds = [(0, 100, 100), (100, 130, 200), (200, 500, 500), (500, 505, 700)]
    forest, hits = simhash._Forest(700, simhash.Rule(radius=radius), None), set()
    forest.add = lambda k, found, group: hits.update((k, int(x)) for x in found)
    simhash._compare_groups(fp, bounds, 0, forest)
    want = set()
    for s, m, e in bounds:
        for i in range(s, m):
            meet = range(m, e) if e > m else range(i + 1, m)
            want |= {(i, j) for j in meet if int(fp[i] ^ fp[j]).bit_count() <= radius}
    assert hits == want


def test_masks_leave_no_pair_out():
    for rule in (simhash.Rule(radius=4), simhash.Rule(radius=10), simhash.Rule(radius=3, agree=1)):
        draw = random.Random(rule.radius)
        for _ in range(300):
            flips = sum(1 << b for b in draw.sample(range(64), rule.radius))
            assert any(not m & flips for m in rule.masks())


def corpus(spark):
    base = [words(k, 60 + 10 * k) for k in range(12)]
    texts = base + [changed(base[k % 6], 100 + k, 1 + k % 4) for k in range(30)] + [base[0]] * 5 + ["", None, "x"]
    draw = random.Random(4)
    ids = draw.sample(range(1000), len(texts))
    return spark.createDataFrame(rows_of(*zip(ids, texts), (None, base[1]), (None, words(77, 30))), DOCS)


@pytest.mark.parametrize("radius,tile", [(4, 4096), (10, 4096), (10, 3)])
def test_groups_against_all_pairs(spark, radius, tile):
    docs = corpus(spark)
    rows = docs.collect()
    want = plain_groups(rows, lambda a, b: (plain_print(a.text, 4) ^ plain_print(b.text, 4)).bit_count() <= radius)
    want = sorted((r.doc_id or -1, plain_print(r.text, 4), w if w is not None else -1) for r, w in zip(rows, want))
    got = simhash.groups(docs, simhash.Rule(radius=radius, tile=tile)).collect()
    assert sorted((r.doc_id or -1, r.fp % 2**64, -1 if r.component_id is None else r.component_id) for r in got) == want


def test_small_tiles_leave_the_sampled_sizes(spark):
    """A bucket of many nodes is cut into tiles, and no link is lost."""
    centre = 0x0123456789ABCDEF
    prints = {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)}
    signed = [(p - (1 << 64) * (p >> 63),) for p in prints]
    nodes = spark.createDataFrame(signed, "fp long").selectExpr("fp AS node", "fp")
    rule = simhash.Rule(radius=2, tile=64)
    assert simhash._buckets(nodes, rule).filter("low < high").count() > 0
    roots = components(simhash.links(nodes, rule))
    assert roots.select("root").distinct().count() == 1 and roots.count() == len(prints) - 1


@pytest.mark.parametrize("tile_bytes", [8 << 20, 2000])
def test_similarity_and_first_of_each_group(spark, tile_bytes):
    rule = simhash.Rule(radius=10, similar=0.8, prints=2, tile_bytes=tile_bytes)
    docs = corpus(spark)
    rows = docs.collect()
    want = plain_groups(rows, lambda a, b: similar(a.text, b.text) >= 0.8)
    named = {(r.doc_id, r.text): w for r, w in zip(rows, want)}
    got = simhash.groups(docs, rule).collect()
    assert sorted((r.doc_id or -1, -1 if r.component_id is None else r.component_id) for r in got) == sorted(
        (d or -1, -1 if w is None else w) for (d, _), w in named.items()
    )
    kept = simhash.keep_first(docs, rule)
    assert kept.columns == docs.columns
    stay = [(r.doc_id, r.text) for r in kept.collect()]
    assert all(named[r] is None or named[r] == r[0] for r in stay)
    assert sorted(named[r] for r in stay if r[0] is not None) == sorted({w for w in want if w is not None})


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_similar_pairs_against_all_pairs(least):
    draw = np.random.default_rng(5)
    base = [draw.integers(0, 400, 40) for _ in range(5)]
    sets = [np.unique(np.append(b, draw.integers(0, 400, k))).astype("<u8") for b in base for k in (0, 2, 5, 9, 30)]
    sets += [sets[3], np.zeros(0, "<u8"), np.zeros(0, "<u8"), np.arange(4, dtype="<u8"), np.arange(5, dtype="<u8")]
    alike = [(i, j) for i in range(len(sets)) for j in range(i) if _share(sets[i], sets[j]) >= least]
    pairs = simhash.similar_pairs(sets, least)
    assert all(_share(sets[i], sets[j]) >= least for i, j in pairs)

    def labels(edges):
        label = list(range(len(sets)))
        for i, j in edges:
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
        return label

    assert labels(pairs) == labels(alike) and len(pairs) == len(sets) - len(set(labels(alike)))


def _share(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_odd_rows(odd_docs, no_docs):
    got = simhash.groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.component_id for r in got if r.doc_id in (1, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id in (4, 5, 6)} == {4}
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = simhash.keep_first(odd_docs, simhash.Rule(radius=10, similar=0.8)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "10", "2", "4", "7", "8", "9", "None", "None"])
    assert simhash.groups(no_docs).collect() == [] and simhash.keep_first(no_docs).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 140)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (None, 3), (2, 1)], "a int, b int")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 140)}}


def test_lanes_and_words():
    assert bitslice._below(np.array([-3, 0, 1, 64, 70])).tolist() == [0, 0, 1, 2**64 - 1, 2**64 - 1]
