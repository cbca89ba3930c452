"""URL rules by a sort-merge range join, in DataFrame operations only.

A host is reversed label by label, so that all its subdomains follow it, and a
rule's host with the start of its path becomes an interval of keys. Keys and
interval ends are sorted together and swept: an interval that opens is pushed
on a stack, one that closes is taken off, and a key belongs to the innermost
interval open there. Intervals of prefixes are nested or apart, never crossing,
so the stack is plain SQL: a running sum gives its depth, and the last interval
opened at that depth is its top.

A rule with a path also fits subdomains, whose keys lie elsewhere; so a URL is
swept once below each suffix of its host that has rules. Distinct URLs are
swept, and of a host with many URLs several parts, each with the host's rules,
so that no host lands in one task whole.

The longest rule wins: the longer host, then the longer path. Of rules for one
place ``block`` wins. Null URLs and those without ``://`` have an empty host
and path and match nothing. Repeated rows and ids give a row each. An empty
table gives an empty result, an empty set of rules the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: URLs of one host that are swept together, at least.
PART = 256

#: The rules of the registered query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_table(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, verdict string")


def _suffixes(host: Column) -> Column:
    """The host itself and every host above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, the rule that decides (or null), and the verdict.

    ``rules`` has ``rule_host``, ``rule_path`` and ``verdict``; its rows with nulls are ignored.
    """
    rows = pages.select(pages[key].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    rules = rules.select(F.translate("rule_host", UPPER, LOWER).alias("rule_host"), "rule_path", "verdict").dropna()
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))  # block over allow

    wanted = rules.groupBy("rule_host").agg(F.count(F.lit(1)).alias("n_rules"))
    distinct = rows.filter("host <> ''").select("host", "path").distinct()
    below = distinct.select("host", "path", F.explode(F.array_distinct(_suffixes(F.col("host")))).alias("rule_host"))
    below = below.join(wanted.select("rule_host"), "rule_host", "left_semi")

    # A host's URLs are swept in parts, larger if it has many rules, as each part repeats them.
    parts = below.groupBy("rule_host").agg(F.count(F.lit(1)).alias("n")).join(wanted, "rule_host")
    size = F.greatest(F.lit(PART), F.col("n_rules") * 4)
    parts = parts.select("rule_host", F.ceil(F.col("n") / size).cast("int").alias("parts"))

    def keyed(path: Column) -> Column:
        return F.encode(F.concat(reversed_host(F.col("rule_host")), F.lit("\x00"), path), "UTF-8")

    urls = below.join(parts, "rule_host").select(
        "rule_host",
        F.pmod(F.xxhash64("host", "path"), "parts").cast("int").alias("part"),
        keyed(F.col("path")).alias("at"),
        F.lit(1).alias("kind"),
        F.lit(0).alias("step"),
        "host",
        "path",
        F.lit(None).cast("struct<rule_host:string,rule_path:string,verdict:string>").alias("rule"),
    )
    open_, close = keyed(F.col("rule_path")), F.concat(keyed(F.col("rule_path")), F.lit(b"\xff"))
    opened = F.struct("rule_host", "rule_path", "verdict")
    ends = rules.join(parts, "rule_host").select(
        "rule_host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), opened.alias("rule"),
        F.explode(F.array(
            F.struct(open_.alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step")),
            F.struct(close.alias("at"), F.lit(2).alias("kind"), F.lit(-1).alias("step")),
        )).alias("e"),
    )
    nothing = F.lit(None).cast("string")
    ends = ends.select(
        "rule_host", "part", "e.at", "e.kind", "e.step", nothing.alias("host"), nothing.alias("path"),
        F.when(F.col("e.step") == 1, F.col("rule")).alias("rule"),
    )
    sweep = Window.partitionBy("rule_host", "part").orderBy("at", "kind", F.length("at"))
    up_to = sweep.rowsBetween(Window.unboundedPreceding, 0)
    # Dealt by host and part by name: after a join by host the windows would be content with its partitions, and a hot
    # host would stay whole.
    swept = urls.unionByName(ends).repartition("rule_host", "part")
    events = swept.withColumn("depth", F.sum("step").over(up_to))
    level = Window.partitionBy("rule_host", "part", "depth").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last("rule", ignorenulls=True).over(level)
    hit = events.withColumn("top", F.when(F.col("depth") > 0, top)).filter("kind = 1 AND top IS NOT NULL")
    longest = F.struct(F.length("top.rule_host"), F.length("top.rule_path"), F.col("top").alias("top"))
    best = hit.groupBy(F.col("host").alias("hit_host"), F.col("path").alias("hit_path")).agg(F.max(longest)["top"].alias("top"))

    same = (F.col("host") == F.col("hit_host")) & (F.col("path") == F.col("hit_path"))
    return rows.join(best, same, "left").select(
        "page_id",
        "host",
        "path",
        F.concat("top.rule_host", "top.rule_path").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )


def sql(rules: Iterable[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {listed}),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
page AS (
  SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (
  SELECT k, max_by(rule_host || rule_path, (length(rule_host), length(rule_path))) AS rule,
         max_by(verdict, (length(rule_host), length(rule_path))) AS verdict
  FROM page JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM page LEFT JOIN best USING (k)"""
