from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from cellindex.llm import pieces as cut_pieces  # noqa: E402
from cellindex.llm.histogram_packing import Room, fillings, nnls, pack, pack_cell, padding, solve  # noqa: E402
from cellindex.llm.tokens import ID, public_path  # noqa: E402
from tests.llm.test_packing import PATH, whole_ids  # noqa: E402


def laid_out(lengths, room):
    """Pack lengths in one cell; every token lies in one piece and sequences have no holes. Returns the sequences' sizes."""
    values, counts = np.unique(lengths, return_counts=True)
    doc, start, size, sequence, offset = pack_cell(lengths, solve(dict(zip(values.tolist(), counts.tolist())), room), room)
    assert (size > 0).all()
    for group, first in ((doc, start), (sequence, offset)):
        order = np.lexsort((first, group))
        g, f, n = group[order], first[order], size[order]
        new = np.append(True, g[1:] != g[:-1])
        assert (f[new] == 0).all() and (f[1:] == (f + n)[:-1])[~new[1:]].all()
    assert (np.bincount(doc, size, len(lengths)) == lengths).all()
    sizes = np.bincount(sequence, size).astype(int)
    assert sizes.max() <= room.tokens
    return sizes, np.bincount(doc)


@pytest.mark.parametrize("tokens", [4096, 1000, 64, 7, 2])
@pytest.mark.parametrize("n", [1, 3, 40, 3000])
def test_all_tokens_are_placed(tokens, n):
    draw = np.random.default_rng(n)
    lengths = 1 + draw.lognormal(5, 1.2, n).astype(int) % (tokens - 1)
    sizes, _ = laid_out(lengths, Room(tokens))
    least = lengths.sum() / tokens
    assert len(sizes) <= 1.35 * least + 30
    if tokens & (tokens - 1) == 0:
        assert ((sizes == tokens) | (np.bitwise_count(sizes) == 1)).all()  # no padding at all


def test_few_documents_are_cut():
    draw = np.random.default_rng(7)
    lengths = 1 + draw.lognormal(5.5, 1.2, 8000).astype(int) % 4095
    sizes, pieces = laid_out(lengths, Room())
    assert len(sizes) <= 1.02 * lengths.sum() / 4096 and (pieces > 1).mean() < 0.1


@pytest.mark.parametrize("length", [1, 1023, 1024, 1025, 1366, 2048, 2049, 4095])
@pytest.mark.parametrize("powers", [True, False])
def test_one_length_alone(length, powers):
    room = Room(powers=powers)
    sizes, _ = laid_out(np.full(500, length), room)
    wasted = 4096 * len(sizes) - 500 * length
    assert (np.bitwise_count(sizes[sizes < 4096]) == 1).all() if powers else wasted <= 2 * 4096


def test_fillings_are_all_short_sums():
    def plain(total, least, depth, most):
        if total == 0:
            return {()}
        if depth == 0:
            return set()
        return {(k, *r) for k in range(least, min(most, total) + 1) for r in plain(total - k, least, depth - 1, k)}

    for total, least in ((1, 1), (12, 1), (12, 3), (30, 7)):
        assert sorted(fillings(total, least)) == sorted(plain(total, least, 4, total))


def test_nnls_meets_its_conditions():
    draw = np.random.default_rng(3)
    for _ in range(20):
        a, b = draw.integers(0, 4, (15, 40)).astype(float), draw.random(15)
        x = nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max(initial=0) < 1e-6
    true = np.array([0.0, 2.0, 0.0, 1.5])
    a = np.array([[1, 0, 2, 0], [0, 1, 1, 0], [1, 0, 0, 2], [0, 1, 0, 1.0]])
    assert np.allclose(nnls(a, a @ true), true)
    assert not nnls(a, np.zeros(4)).any() and not nnls(a, -np.ones(4)).any()


def test_recipes_use_up_a_histogram_that_they_fit():
    room = Room(64, least=64)
    histogram = {40: 300, 24: 200, 12: 200}
    recipes = solve(histogram, room)
    sizes, pieces = laid_out(np.repeat(list(histogram), list(histogram.values())), room)
    assert len(recipes) == 1 and (sizes == 64).sum() >= 299 and (pieces == 1).all()


def rebuilt(rows):
    """Ids of each document from its pieces, sequences checked; documents of one id apart by order of pieces."""
    sequences = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4 > 0
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
    return sequences


@pytest.mark.parametrize("parts,cell", [(1, 8192), (5, 4)])
def test_pieces_hold_all_ids(odd_docs, parts, cell, monkeypatch):
    if cell == 4:
        monkeypatch.setattr(cut_pieces, "NARROW", ID)
    rows = pack(odd_docs.repartition(parts), PATH, room=Room(64, cell=cell)).collect()
    sequences = rebuilt(rows)
    assert all(sum(r.length for r in own) <= 64 for own in sequences.values())
    docs = odd_docs.collect()
    expected, got = Counter(), Counter()
    for r, ids in zip(docs, whole_ids([r.text for r in docs], 2)):
        expected.update((r.doc_id, k, i, len(ids)) for k, i in enumerate(ids))
    for r in rows:
        got.update((r.doc_id, r.start + k, int(i), r.doc_tokens) for k, i in enumerate(np.frombuffer(r.ids, ID)))
    assert got == expected


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = []
    for parts in (1, 7):
        pieces = pack(docs.repartition(parts), public_path("word_bpe_49k.json")).cache()
        rebuilt(pieces.collect())
        found.append(padding(pieces).first())
    assert found[0].tokens == found[1].tokens
    for f in found:
        assert f.padding == 0 and f.sequences <= f.tokens / 4096 + 30


def test_empty_and_wrong(no_docs):
    assert pack(no_docs, PATH).collect() == []
    for wrong in ({"tokens": 0}, {"cell": 0}, {"least": 0}):
        with pytest.raises(ValueError):
            Room(**wrong)
