import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from cellindex.llm import token_files  # noqa: E402
from cellindex.llm.tokens import public_path  # noqa: E402
from tests.llm.test_packing import whole_ids  # noqa: E402

PATH = public_path("word_bpe_49k.json")


@pytest.mark.parametrize("shards", [1, 4])
def test_round_trip(odd_docs, tmp_path, shards):
    folder = str(tmp_path / "files")
    entries = token_files.write(odd_docs, folder, PATH, end_id=2, shards=shards).cache()
    token_files.build_index(entries, folder, 3).collect()
    keys = odd_docs.select("doc_id").distinct()
    got = token_files.read(token_files.find(keys, folder, 3), folder).collect()
    rows = odd_docs.collect()
    want = sorted((repr(r.doc_id), np.array(x, "<u4").tobytes()) for r, x in zip(rows, whole_ids([r.text for r in rows], 2)))
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in got) == want
    order = [r.doc_id for r in entries.orderBy("shard", "document").collect()]
    assert order == sorted(order, key=lambda x: (x is not None, x))


def test_starts_follow_the_ids(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    got = {r.doc_id: r for r in token_files.round_trip(docs, str(tmp_path / "f"), PATH).collect()}
    at = 0
    rows = docs.orderBy("doc_id").collect()
    for r, ids in zip(rows, whole_ids([r.text for r in rows], 2)):
        raw = np.array(ids, "<u4").tobytes()
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, zlib.crc32(got[r.doc_id].ids)) == (at, len(ids), zlib.crc32(raw))
        at += len(ids)


def test_one_key_over_shards_and_absent_keys(spark, tmp_path):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(60)] + [(2, "b")], "doc_id long, text string")
    folder = str(tmp_path / "files")
    entries = token_files.write(docs, folder, PATH, shards=6).cache()
    assert entries.filter("doc_id = 1").select("shard").distinct().count() > 1
    token_files.build_index(entries, folder, 2).collect()
    asked = spark.createDataFrame([(1,), (3,), (None,)], "doc_id long")
    got = token_files.read(token_files.find(asked, folder, 2), folder).collect()
    assert len(got) == 60 and {r.doc_id for r in got} == {1} and len({bytes(r.ids) for r in got}) == 60


def test_equal_hashes_are_told_apart(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(token_files, "hash_of", lambda text: F.length(text).cast("long"))
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(30)], "doc_id long, text string")
    folder = str(tmp_path / "files")
    token_files.build_index(token_files.write(docs, folder, PATH).cache(), folder, 2).collect()
    got = token_files.read(token_files.find(docs, folder, 2), folder).collect()
    assert sorted(r.doc_id for r in got) == list(range(30))
    assert token_files.find(spark.createDataFrame([(77,)], "doc_id long"), folder, 2).collect() == []


def test_empty_table(no_docs, tmp_path):
    assert token_files.round_trip(no_docs, str(tmp_path / "files"), PATH).collect() == []
