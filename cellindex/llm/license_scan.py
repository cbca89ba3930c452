"""License scan by diagonal voting, in DataFrame operations only.

Every pair of neighbouring words of a text is hashed and joined to the places
of the same pair in short templates. A match of text place ``j`` with template
place ``i`` votes for the diagonal ``j - i``: a template that occurs unchanged
from word ``d`` puts all its votes on diagonal ``d``; one with words put in or
left out spreads over neighbouring diagonals, which are merged. Matches are
verified word by word before they vote, so hash collisions do not count.

The templates are a small fixed table: its size is checked before it is
broadcast, and texts are never shuffled. Votes are a bit for each place of the
template, so repeated rows and repeated votes change nothing.

Null texts count as empty, and a text without words has no matches. Null ids
and ids of several texts are kept apart by the digest of the text. Equal rows
give equal rows. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
#: Votes are bits of a long.
MOST_WORDS = 60
MOST_TEMPLATES = 10_000


@dataclass(frozen=True)
class Template:
    """Words of a license text; a ``phrase`` counts only where it stands whole."""

    label: str
    text: str
    phrase: bool = False


#: Phrases and their labels, and openings of well-known license texts.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
TEXTS = (
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("all-rights-reserved", "all rights reserved"),
)
DEFAULT = PHRASES + TEXTS


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    """The words in order; only A to Z are lower-cased."""
    return F.array_remove(F.split(lowered(text), BETWEEN), "")


def _grams(spark, templates: tuple[Template, ...]) -> DataFrame:
    rows = []
    for number, t in enumerate(templates):
        own = t.text.split()
        if not K <= len(own) <= MOST_WORDS:
            raise ValueError(f"a template has {K} to {MOST_WORDS} words: {t.text!r}")
        rows += [(number, t.label, t.phrase, len(own) - 1, i, a, b) for i, (a, b) in enumerate(zip(own, own[1:]))]
    if not templates or len(templates) > MOST_TEMPLATES:
        raise ValueError(f"1 to {MOST_TEMPLATES} templates are needed")
    schema = "template int, label string, phrase boolean, places int, i int, word string, next string"
    # At most 10,000 templates of 59 pairs: some tens of MB, whatever the corpus.
    return F.broadcast(spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64("word", "next")))


def matches(
    docs: DataFrame,
    templates: tuple[Template, ...] = DEFAULT,
    coverage: float = 0.8,
    gap: int = 3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Verified spans: ``doc_id``, ``digest``, ``label``, ``template``, ``phrase``, ``first``, ``last``, ``covered``, ``accepted``.

    ``first`` and ``last`` are word numbers from 0, ``covered`` the share of the template's pairs
    found there. Phrases are accepted whole only, texts from ``coverage`` on. Diagonals of a text at most ``gap``
    apart are one span.
    """
    own = docs.select(docs[key].alias("doc_id"), F.xxhash64(docs[text]).alias("digest"), words(docs[text]).alias("w"))
    paired = own.select("doc_id", "digest", F.posexplode(F.arrays_zip("w", F.expr("slice(w, 2, size(w))").alias("x"))))
    paired = paired.select("doc_id", "digest", F.col("pos").alias("j"), F.col("col.w").alias("w"), F.col("col.x").alias("x"))
    grams = _grams(docs.sparkSession, templates)
    voted = paired.withColumn("hash", F.xxhash64("w", "x")).join(grams, "hash")
    voted = voted.filter((F.col("w") == F.col("word")) & (F.col("x") == F.col("next")))
    names = ["doc_id", "digest", "template", "label", "phrase", "places"]
    diagonals = voted.groupBy(*names, (F.col("j") - F.col("i")).alias("d")).agg(
        F.expr("bit_or(shiftleft(1L, i))").alias("votes"), F.min("j").alias("first"), (F.max("j") + 1).alias("last")
    )
    along = Window.partitionBy("doc_id", "digest", "template").orderBy("d")
    far = F.col("phrase") | F.coalesce(F.col("d") - F.lag("d").over(along) > gap, F.lit(True))
    spans = diagonals.withColumn("far", far.cast("int"))
    spans = spans.withColumn("span", F.sum("far").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy(*names, "span").agg(
        F.bit_count(F.expr("bit_or(votes)")).alias("found"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    covered = F.col("found") / F.col("places")
    return spans.select(
        "doc_id",
        "digest",
        "label",
        "template",
        "phrase",
        "first",
        "last",
        covered.alias("covered"),
        F.when(F.col("phrase"), F.col("found") == F.col("places")).otherwise(covered >= coverage).alias("accepted"),
    )


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = DEFAULT,
    coverage: float = 0.8,
    gap: int = 3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: words, whole phrases and where they start, labels and a score.

    The score is the largest share of any template found in one span, 0 without any match.
    """
    found = matches(docs, templates, coverage, gap, key, text)
    whole = F.col("accepted") & F.col("phrase")

    def labels(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    per_doc = found.groupBy(F.col("doc_id").alias("found_id"), F.col("digest").alias("found_digest")).agg(
        F.sum(whole.cast("long")).alias("n_base"),
        F.min(F.when(whole, F.col("first"))).alias("first_word"),
        F.max(F.when(whole, F.col("first"))).alias("last_word"),
        labels(whole).alias("base_labels"),
        labels(F.col("accepted")).alias("labels"),
        F.max("covered").alias("score"),
    )
    rows = docs.select(
        docs[key].alias("doc_id"),
        F.xxhash64(docs[text]).alias("digest"),
        F.regexp_count(lowered(docs[text]), F.lit(WORD)).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest"))
    return rows.join(per_doc, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def sql(templates: tuple[Template, ...] = DEFAULT, coverage: float = 0.8, gap: int = 3) -> str:
    """The same in DuckDB's SQL, from whole word lists instead of hashes."""
    listed = ", ".join(f"({k}, '{t.label}', {str(t.phrase).lower()}, '{t.text}')" for k, t in enumerate(templates))
    return f"""
WITH given(template, label, phrase, txt) AS (VALUES {listed}),
gram AS (
  SELECT template, label, phrase, len(w) - 1 AS places, i - 1 AS i, w[i] AS a, w[i + 1] AS b
  FROM (SELECT *, string_split(txt, ' ') AS w FROM given), unnest(range(1, len(w))) AS r(i)),
doc AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
pair AS (SELECT k, j - 1 AS j, w[j] AS a, w[j + 1] AS b FROM doc, unnest(range(1, len(w))) AS r(j)),
diag AS (
  SELECT k, template, label, phrase, places, j - i AS d, list(DISTINCT i) AS votes, min(j) AS first
  FROM pair JOIN gram USING (a, b) GROUP BY ALL),
step AS (
  SELECT *, CASE WHEN NOT phrase AND d - lag(d) OVER (PARTITION BY k, template ORDER BY d) <= {gap}
            THEN 0 ELSE 1 END AS far FROM diag),
span AS (SELECT *, sum(far) OVER (PARTITION BY k, template ORDER BY d) AS s FROM step),
one AS (
  SELECT k, template, label, phrase, places, min(first) AS first,
         len(list_distinct(flatten(list(votes)))) AS found FROM span GROUP BY k, template, label, phrase, places, s),
hit AS (
  SELECT *, found / places AS covered,
         CASE WHEN phrase THEN found = places ELSE found / places >= {coverage} END AS accepted FROM one),
per AS (
  SELECT k, count(*) FILTER (accepted AND phrase) AS n_base, min(first) FILTER (accepted AND phrase) AS first_word,
         max(first) FILTER (accepted AND phrase) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (accepted AND phrase)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER (accepted)), ',') AS labels, max(covered) AS score
  FROM hit GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM doc LEFT JOIN per USING (k)"""
