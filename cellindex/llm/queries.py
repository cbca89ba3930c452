"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellindex.llm import embedding_dedup, filter_audit, hard_negatives, histogram_packing, license_scan, mixing, neighbours, packing, quality, simhash, token_counts, token_files, url_filter
from cellindex.llm.registry import QUERIES, SQL, query  # noqa: F401
from cellindex.llm.shared import table
from cellindex.llm.tokens import public_path
from cellindex.plans.scratch import work_dir

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


@query("op4_best_fit_packing")
def best_fit_packing(spark, folder):
    """As few sequences as possible: document count and attention cost get capacities that cannot bind."""
    room = packing.Capacity(tokens=4096, documents=4096, attention=float(4096**2))
    pieces = packing.pack(table(spark, folder, "documents"), public_path(WORD_BPE), end_id=1, capacity=room)
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query("op9_token_counts")
def section_tokens(spark, folder):
    """Every document counts: those of null or empty text have one row, section -1 without tokens."""
    return token_counts.count_tokens(table(spark, folder, "documents"), public_path(BYTE_BPE), rule="majority", empty=True)


@query("op1_simhash_near_dedup")
def simhash_near_dedup(spark, folder):
    """Groups of documents whose fingerprints of four-word shingles reach each other in steps of at most four bits."""
    found = simhash.groups(table(spark, folder, "documents"), simhash.Rule(shingle=4, radius=4))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_license_scan", license_scan.sql())
def licenses(spark, folder):
    return license_scan.scan(table(spark, folder, "documents"))


#: Target shares of the largest source and a few more; all others keep their proportions.
WEIGHTS, REST = {"src0": 0.15, "src1": 0.12, "src2": 0.08, "src3": 0.01}, 0.64


@query("op3_mixing", mixing.sql(WEIGHTS, REST))
def mixed(spark, folder):
    """Whole documents, repeated and in their new order."""
    return mixing.mix(table(spark, folder, "documents"), WEIGHTS, REST)


@query("op5_url_filter", url_filter.sql())
def urls_judged(spark, folder):
    rules = url_filter.rule_table(spark, url_filter.RULES)
    return url_filter.judge(table(spark, folder, "pages"), rules, default="allow")


@query("op10_quality_classifier")
def quality_scores(spark, folder):
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"), threshold=0.7)


@query("op7_token_files")
def token_files_read_back(spark, folder):
    """Every document written to the binary files and read back through the index."""
    files = work_dir(spark, "token-files")
    found = token_files.round_trip(table(spark, folder, "documents"), files, public_path(WORD_BPE), end_id=2)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_nearest_neighbours")
def nearest_neighbours(spark, folder):
    """Every row whose id is divisible by 100 against all rows."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op8_embedding_near_dedup")
def embedding_near_dedup(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"), embedding_dedup.Settings(threshold=0.93))


@query("op11_filter_audit", filter_audit.sql())
def filter_interactions(spark, folder):
    """All 120 orders of the five filters, for every language."""
    return filter_audit.audit_texts(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_histogram_packing")
def histogram_packed(spark, folder):
    """Sequences of at most 4096 tokens; those of a power of two need no padding."""
    pieces = histogram_packing.pack(table(spark, folder, "documents"), public_path(WORD_BPE), end_id=2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: The labels that count for hard negatives, in both languages.
SHIFTED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@query("op13_hard_negatives", hard_negatives.sql(SHIFTED))
def hard_negatives_mined(spark, folder):
    """Every row whose id is divisible by 100 against all rows, under labels of which a seventh are shifted."""
    rows = table(spark, folder, "embeddings").withColumn("label", F.expr(SHIFTED))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)
