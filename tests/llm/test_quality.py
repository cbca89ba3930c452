import zlib

import numpy as np
import pytest

from cellindex.llm import quality
from cellindex.llm.passages import N_FEATURES, measure

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in got.items())
    held = [r for r in labels.collect() if got[r.doc_id].held_out]
    right = sum((got[r.doc_id].predicted == 1) == (r.quality == 1) for r in held)
    assert len(held) > 60 and right / len(held) >= 0.95
    assert all(got[r.doc_id].predicted for r in held if r.quality == 1)


def test_scores_do_not_depend_on_other_columns_or_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    one = {r.doc_id: r.score for r in quality.score(docs.limit(50), model).collect()}
    other = docs.limit(50).selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source").repartition(7)
    assert one == pytest.approx({r.doc_id: r.score for r in quality.score(other, model).collect()}, abs=1e-6)


def test_gradients():
    draw = np.random.default_rng(0)
    model = quality.Model(quality.Settings())
    model.parts = {k: 0.3 * draw.standard_normal(v.shape) for k, v in model.parts.items()}
    x, first, label = draw.standard_normal((30, N_FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0, 1])

    def loss():
        y = model.forward(x, first)["y"]
        return -np.mean(label * np.log(y) + (1 - label) * np.log(1 - y))

    found = model.gradients(x, first, label)
    for name, part in model.parts.items():
        place = tuple(draw.integers(0, n) for n in part.shape)
        was, step = part[place], 1e-5
        part[place] = was + step
        above = loss()
        part[place] = was - step
        below = loss()
        part[place] = was
        assert found[name][place] == pytest.approx((above - below) / (2 * step), rel=1e-3, abs=1e-7)


def test_passages():
    x, n = measure(["a b c d e", None, "", "Ab ab ab!!"], 2)
    assert n.tolist() == [3, 1, 1, 2] and x.shape == (7, N_FEATURES)
    both, _ = measure(["Ab ab ab!!"], 2)
    assert np.allclose(x[5:], both)
    assert x[3:5, -1].tolist() == [1, 1] and x[0, -1] == 0


def test_labels_of_other_documents_take_no_places(spark, odd_docs):
    others = [(k, k % 2) for k in range(1000, 3000)]
    labels = spark.createDataFrame(others + [(k, int(k < 4)) for k in range(1, 11)], "doc_id long, quality int")
    assert quality.train(odd_docs, labels, quality.Settings(train_rows=10)).learned
    assert not quality.train(odd_docs, labels.filter("quality = 1")).learned


def test_odd_rows_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 1), (None, 1), (99, 0), (7, None), (5, 0), (9, 0), (10, 1)], "doc_id long, quality int"
    )
    got = quality.judge(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    none = quality.judge(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
    assert quality.judge(no_docs, labels).collect() == []
    kept = quality.score(odd_docs, quality.Model(quality.Settings()), keep=True, name="__score")
    assert kept.columns == [*odd_docs.columns, "__score"] and kept.count() == odd_docs.count()
