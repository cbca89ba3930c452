"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source of size ``n`` and target weight ``w`` (of a mix as large as all input
times ``scale``) is to be seen ``w * total * scale / n`` times. Every document
draws its number of copies from a Poisson distribution of that mean: a uniform
number from a hash of its id and a seed is inverted through the distribution
function. Means above ``PIECE`` are sums of several independent draws, so the
function never underflows. Copies are then put in an order by another hash,
which is a global shuffle: sources, being only a factor of the mean, do not
cluster, and a source with a third of all rows is spread like any other.

The draw depends on id and seed only, so every run and every retried task
repeats it. Only one row per source is aggregated. The weight ``rest`` is for all
sources without a weight of their own, shared by size. A null source is a source
like any other, named by ``None`` in the weights; a null id draws like an empty one.
Rows that repeat an id draw the same number. Sources of weight 0 are left out; a
source that is not in the table takes no part, and the weights of the others are
scaled to sum to 1. Null and empty texts have size 0
(a source of such rows alone is left out when size is measured in characters).
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.llm.shared import columns_of, free_prefix, stored

PIECE = 8.0
#: Beyond this count a draw of mean 8 has less than 2 ** -60 left.
LONGEST = 64
#: Hex digits of the hash in use: 52 bits, exact in a double.
DIGITS = 13


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    whole = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    return (whole + 0.5) / float(16**DIGITS)


def rates(
    docs: DataFrame, weights: dict[str | None, float], rest: float, scale: float, source: str, size: Column
) -> DataFrame:
    """One row per source in use: ``name``, mean number of copies ``rate``, number of draws ``pieces``, and ``cdf``."""
    if rest < 0 or any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    target = docs.sparkSession.createDataFrame(
        [(s, float(w)) for s, w in weights.items()], "wanted string, weight double"
    )
    sizes = docs.groupBy(docs[source].cast("string").alias("name")).agg(F.sum(size).cast("double").alias("size"))
    sizes = sizes.filter("size > 0").join(target, F.col("name").eqNullSafe(F.col("wanted")), "left")

    def total(value: Column) -> Column:
        return sizes.agg(F.coalesce(F.sum(value), F.lit(0.0))).scalar()

    unnamed = F.when(F.col("weight").isNull(), F.col("size"))
    weight = F.coalesce("weight", F.lit(float(rest)) * F.col("size") / total(unnamed))
    every = total(F.col("weight")) + F.when(total(unnamed) > 0, F.lit(float(rest))).otherwise(0.0)
    rate = F.try_divide(weight, every) * total(F.col("size")) * F.lit(float(scale)) / F.col("size")
    used = sizes.select("name", rate.alias("rate")).filter("rate > 0")
    used = used.withColumn("pieces", F.ceil(F.col("rate") / PIECE).cast("int"))
    mean = F.col("rate") / F.col("pieces")
    first = F.exp(-mean)

    def next_of(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + p)).alias("all"))

    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("all"))
    return used.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST)), start, next_of, lambda acc: acc["all"]))


def copies(seed: str, key: Column, pieces: Column, cdf: Column) -> Column:
    """Sum over the draws of how many values of the distribution function lie at or below the uniform number."""
    drawn = F.transform(F.sequence(F.lit(1), pieces), lambda piece: uniform(seed, key, piece))
    return F.aggregate(drawn, F.lit(0), lambda acc, u: acc + F.size(F.filter(cdf, lambda c: c <= u)))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float],
    rest: float = 0.0,
    scale: float = 1.0,
    seed: str = "mix",
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    order: bool = True,
    names: tuple[str, str, str] = ("copy", "copies", "shuffle_key"),
) -> DataFrame:
    """All columns of ``docs``, the number of the copy (from 1), of copies and the shuffle key, in the order of the last.

    ``size`` measures a row (one by default, so weights are shares of documents).
    ``names`` are those of the new columns; columns of the table with such a name are replaced.
    """
    known = rates(docs, weights, rest, scale, source, F.lit(1) if size is None else size)
    own = free_prefix(docs)
    # Stored, so that Spark knows its size before it plans the join: documents are then not shuffled by
    # source, unless there are so many sources that a sort-merge join, split where skewed, is called for.
    known = stored(known.select(*[F.col(c).alias(own + c) for c in known.columns]), "rates")
    plain = docs.withColumns({own + "source": docs[source].cast("string"), own + "key": docs[key].cast("string")})
    columns = [c for c, n in zip(columns_of(docs), docs.columns) if n not in names]
    drawn = plain.join(known, F.col(own + "source").eqNullSafe(F.col(own + "name")))
    key_of, n, copy = F.col(own + "key"), F.col(own + "copies"), F.col(own + "copy")
    number = copies(seed, key_of, F.col(own + "pieces"), F.col(own + "cdf"))
    drawn = drawn.select(*columns, key_of, number.alias(own + "copies")).filter(n > 0)
    out = drawn.select("*", F.explode(F.sequence(F.lit(1), n)).alias(own + "copy"))
    place = F.md5(F.concat_ws(":", F.lit(seed + "-order"), F.coalesce(key_of, F.lit("")), copy.cast("string")))
    out = out.select(*columns, *[c.alias(n) for c, n in zip((copy, n, place), names)])
    return out.repartitionByRange(names[2]).sortWithinPartitions(names[2]) if order else out


def sql(weights: dict[str | None, float], rest: float, scale: float = 1.0, seed: str = "mix") -> str:
    """The same in DuckDB's SQL, for sizes in documents."""
    quoted = ", ".join(f"({'NULL' if s is None else repr(s)}, {float(w)!r}::DOUBLE)" for s, w in weights.items())
    number = "(('0x' || substr(md5('{0}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || piece), 1, {1}))::BIGINT + 0.5)"
    return f"""
WITH RECURSIVE given(wanted, weight) AS (VALUES {quoted}),
sizes AS (
  SELECT name, size, weight FROM (SELECT source AS name, CAST(count(*) AS DOUBLE) AS size FROM documents GROUP BY 1)
  LEFT JOIN given ON name IS NOT DISTINCT FROM wanted),
totals AS (
  SELECT sum(size) AS total, coalesce(sum(size) FILTER (weight IS NULL), 0) AS unnamed,
         coalesce(sum(weight), 0) AS named FROM sizes),
rate AS (
  SELECT name, coalesce(weight, {float(rest)!r}::DOUBLE * size / unnamed)
           / (named + CASE WHEN unnamed > 0 THEN {float(rest)!r}::DOUBLE ELSE 0 END) * total * {float(scale)!r}::DOUBLE / size AS rate
  FROM sizes, totals),
used AS (SELECT *, CAST(ceil(rate / {PIECE}) AS INT) AS pieces, rate / ceil(rate / {PIECE}) AS mean FROM rate WHERE rate > 0),
cdf(name, mean, k, p, s) AS (
  SELECT name, mean, 0, exp(-mean), exp(-mean) FROM used
  UNION ALL SELECT name, mean, k + 1, p * mean / (k + 1), s + p * mean / (k + 1) FROM cdf WHERE k < {LONGEST}),
doc AS (SELECT row_number() OVER () AS r, * FROM documents),
draw AS (
  SELECT r, source, {number.format(seed, DIGITS)} / {float(16**DIGITS)!r}::DOUBLE AS u
  FROM doc JOIN used ON source IS NOT DISTINCT FROM used.name, unnest(range(1, pieces + 1)) AS d(piece)),
drawn AS (
  SELECT r, count(s) AS copies FROM draw JOIN cdf ON source IS NOT DISTINCT FROM cdf.name AND s <= u GROUP BY r)
SELECT doc.* EXCLUDE (r), CAST(copy AS INT) AS copy, CAST(copies AS INT) AS copies,
       md5('{seed}-order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS shuffle_key
FROM drawn JOIN doc USING (r), unnest(range(1, copies + 1)) AS c(copy)"""
