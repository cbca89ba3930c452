from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import Row
from pyspark.sql import functions as F
from tests.llm.test_packing import check, whole_ids
from tests.llm.test_simhash import plain_groups, similar

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = pipeline.classify(spark, docs, FOLDER).cache()
    assert good.schema == docs.schema
    left = {r.doc_id for r in good.collect()}
    assert all(d in left for d, q in labels.items() if q == 1)

    unique = pipeline.remove_near_duplicates(spark, good, FOLDER).cache()
    assert unique.schema == docs.schema
    stay = sorted(r.doc_id for r in unique.collect())
    kept = sorted(left)
    want = plain_groups([Row(doc_id=d) for d in kept], lambda a, b: similar(texts[a.doc_id], texts[b.doc_id]) >= 0.8)
    assert stay == sorted(set(want))

    mixed = pipeline.mix_sources(spark, unique, FOLDER).cache()
    assert mixed.schema == docs.schema and {r.doc_id for r in mixed.collect()} <= set(stay)
    rows = pipeline.pack_sequences(spark, mixed, FOLDER).collect()
    check(rows, pipeline.CAPACITY)
    ids = dict(zip(texts, whole_ids(texts.values())))
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
    assert tokens == {d: n * len(ids[d]) for d, n in Counter(r.doc_id for r in mixed.collect()).items()}


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    key = ["doc_id", "piece", "start", "length"]
    one, other = (Counter(map(tuple, x.select(*key, F.crc32("ids")).collect())) for x in (docs, pipeline.run(spark, FOLDER)))
    assert one == other


def test_classifier_without_labels_keeps_all(spark, odd_docs, tmp_path):
    spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.classify(spark, odd_docs, str(tmp_path)).count() == odd_docs.count()


def test_columns_that_clash_stay(spark, odd_docs):
    inner = ("__score", "__copy", "__copies", "__place", "__kept_id", "__id", "__digest", "__source")
    docs = odd_docs.withColumns({c: F.lit(-1) for c in inner})
    for _, stage in pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.schema == docs.schema
        assert all(r[c] == -1 for r in found.collect() for c in inner)
