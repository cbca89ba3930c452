import math
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from cellindex.llm.packing import Capacity, Sequences, pack  # noqa: E402
from cellindex.llm.tokens import ID, public_path  # noqa: E402

PATH = public_path("word_bpe_49k.json")


def whole_ids(texts, end=1):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    return [x.ids + [end] for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, capacity):
    """All sequences are gapless and within every capacity; returns their number."""
    sequences = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4 and 1 <= r.length <= capacity.tokens
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= capacity.tokens
        assert len(own) <= (capacity.documents or math.inf)
        assert len(own) == 1 or sum(r.length**2 for r in own) <= (capacity.attention or math.inf)
    return len(sequences)


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(None, None), (3, None), (5, 64.0**2 * 1.0), (None, 64.0**2 * 0.3), (2, 100.0)])
def test_pieces_hold_all_ids_within_capacities(odd_docs, score, limits):
    capacity = Capacity(64, *limits, score=score)
    rows = pack(odd_docs, PATH, capacity=capacity, cell=7).collect()
    check(rows, capacity)
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
    expected = defaultdict(list)
    for r, ids in zip(odd_docs.collect(), whole_ids([r.text for r in odd_docs.collect()])):
        expected[r.doc_id].append(ids)
    for doc, texts in expected.items():
        pieces = sorted((x[i : i + 64] for x in texts for i in range(0, len(x), 64)))
        assert sorted(np.frombuffer(r.ids, ID).tolist() for r in got[doc]) == pieces
        assert all(r.start == 64 * r.piece for r in got[doc])


@pytest.mark.parametrize("partitions", [1, 8, 211])
def test_few_sequences(spark, partitions):
    """Against the least possible number, however the table is partitioned."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(partitions)
    capacity = Capacity(4096, 4096, 4096.0**2)
    rows = pack(docs, PATH, capacity=capacity).select("doc_id", "length", "sequence_id", "offset", "ids").collect()
    assert check(rows, capacity) <= math.ceil(1.01 * sum(r.length for r in rows) / 4096)


def test_each_capacity_binds():
    """Every capacity alone decides how many sequences there are."""
    lengths = np.full(600, 8)
    count = lambda **limits: int(Sequences(Capacity(64, **limits)).place(lengths)[0].max()) + 1
    assert count() == 75 and count(documents=3) == 200 and count(attention=2 * 64.0) == 300 and count(attention=60.0) == 600
    assert count(documents=8, attention=8 * 64.0) == 75


def plain_best_fit(lengths, capacity):
    """One piece after another against every sequence so far."""
    bins = []
    for length in sorted(lengths, reverse=True):
        need, best = capacity.needs(length), None
        for b in bins:
            if b[0] + length <= capacity.tokens and (b[1][1:] >= need[1:] - 1e-12).all():
                left = b[1] - need
                value = -(np.array(capacity.weights) * left**2).sum() if capacity.score == "norm" else b[1] @ (np.array(capacity.weights) * need)
                if best is None or value > best[0]:
                    best = (value, b)
        if best is None:
            bins.append([0, np.ones(3)])
            best = (0, bins[-1])
        best[1][0] += length
        best[1][1] = best[1][1] - need
    return sorted(b[0] for b in bins)


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_against_plain(score):
    draw = np.random.default_rng(4)
    for limits in ((None, None), (4, None), (None, 900.0), (6, 2000.0)):
        capacity = Capacity(64, *limits, weights=(1.0, 0.5, 2.0), score=score)
        lengths = draw.integers(1, 64, 1500)
        sequence, _ = Sequences(capacity).place(lengths)
        assert sorted(np.bincount(sequence, lengths).astype(int).tolist()) == plain_best_fit(lengths.tolist(), capacity)


def test_empty_and_wrong(no_docs):
    assert pack(no_docs, PATH).collect() == []
    for wrong in ({"tokens": 0}, {"documents": 0}, {"tokens": 9, "attention": 0.0}, {"score": "x"}):
        with pytest.raises(ValueError):
            Capacity(**wrong)


def test_ids_are_widened_in_small_batches():
    """A batch of thousands of full windows is not widened at once."""
    import numpy as np
    import pyarrow as pa

    from cellindex.llm.pieces import NARROW, wide_batches
    from cellindex.llm.tokens import ID

    ids = [np.full(4096, k, NARROW).tobytes() for k in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    out = list(wide_batches(iter([batch]), NARROW))
    assert max(b.column("ids").nbytes for b in out) < 4 << 20
    assert [k for b in out for k in b.column("doc_id").to_pylist()] == list(range(1000))
    assert [x for b in out for x in b.column("ids").to_pylist()] == [np.full(4096, k, ID).tobytes() for k in range(1000)]
