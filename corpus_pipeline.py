"""From raw documents to training sequences: classify, remove near-duplicates, mix, pack.

Every stage takes ``(spark, docs, sf_dir)`` and is written as Parquet before the
next one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellindex.llm import mixing, packing, quality, simhash
from cellindex.llm.shared import columns_of, free_prefix, stored, table
from cellindex.llm.tokens import public_path

#: Scores below this are rejected.
QUALITY = 0.7
#: Near-duplicates: 0.8 of the five-word shingles in common, by whole texts, among candidates within ten bits of one of two fingerprints.
NEAR = simhash.Rule(shingle=4, radius=10, agree=2, similar=0.8, sketch_shingle=5, prints=2)
#: The largest source is held at this share; the others keep their proportions.
WEIGHTS, REST = {"src0": 0.2}, 0.8
#: At most 64 documents share a sequence, and half the attention cost of one long document; a longer piece stands alone.
CAPACITY = packing.Capacity(tokens=4096, documents=64, attention=4096**2 / 2)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; all, if the labels taught it nothing."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.learned:
        return docs
    score = free_prefix(docs) + "score"
    scored = quality.score(docs, model, keep=True, name=score)
    return scored.filter(F.col(score) >= QUALITY).select(*columns_of(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs, NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their weights, in a new order."""
    own = free_prefix(docs)
    mixed = mixing.mix(docs, WEIGHTS, REST, names=(own + "copy", own + "copies", own + "place"))
    return mixed.select(*columns_of(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, sequence and place in it."""
    return packing.pack(docs, public_path("word_bpe_49k.json"), end_id=1, capacity=CAPACITY)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", remove_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
