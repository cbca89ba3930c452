"""What every order of a chain of filters removes, from decision diagrams of failure masks.

Every row gets a mask: one bit for each filter that it fails. Masks are counted
per part in Spark, so what is left of a part is a table of at most ``2 ** n``
rows, whatever the size of the data. From it one diagram per part is built: a
level for each filter, a node for each different remainder, with the numbers of
rows that come through it. A chain of filters is the diagram's order of
levels, and its steps are the path on which every filter passes: what turns
off at a node is removed there, what goes on is kept. One order becomes
the next by swapping two neighbouring levels in place, which leaves all nodes
above and below as they are.

A filter may also ask for repeats (``REPEAT``): the row's text is equal to that of a
row with a smaller id, whether that one is removed or not. Equal texts have equal
128-bit prefixes of SHA-256; a group of copies is counted before it is
shuffled, so its size does not matter.

Null texts count as empty, and a null part is the empty string. Null ids are neither smaller nor
larger than others, so their rows repeat nothing. Repeated rows count each;
of rows that share the smallest id none is a repeat. A document is good or toxic if any
row of the labels says so. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPEAT = "repeat"
#: Orders grow as the factorial of the filters; more of these need their orders named.
MOST_IN_ALL_ORDERS = 7
#: Masks of a part grow as a power of two.
MOST_FILTERS = 16

STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


# Failure conditions on texts. Each is NULL-free.


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def text_rules(text: str = "text") -> dict[str, Column]:
    """The five filters of the registered query over a text column, by their letters."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = _words(body)
    capitals = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(body),
        "D": body.rlike(r"[#$%&*|]"),
        "E": F.lit(REPEAT),
    }


def failure_masks(
    docs: DataFrame,
    labels: DataFrame,
    rules: Mapping[str, Column],
    repeat: str | None = None,
    part: str = "lang",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Columns ``part``, ``mask``, ``n``, ``good`` and ``toxic``: at most ``2 ** n`` rows for each part.

    ``rules`` are failure conditions, bit 0 first; ``repeat`` names the one among them that asks
    for repeats, whose condition is not read.
    """
    if len(rules) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    fails = [F.lit(0) if n == repeat else F.when(c, 1 << k).otherwise(0) for k, (n, c) in enumerate(rules.items())]
    mask = sum(fails, F.lit(0)).cast("int").alias("mask")
    digest = F.lit(None).cast("binary")
    if repeat is not None:
        digest = F.substring(F.unhex(F.sha2(F.coalesce(docs[text], F.lit("")), 256)), 1, 16)
    rows = docs.select(
        docs[key].alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), mask, digest.alias("digest")
    )
    # Counted first, so that repeated rows of one id are one row when labels are joined.
    rows = rows.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("c"))
    marks = labels.groupBy(labels[key].alias("id")).agg(
        F.coalesce(F.bool_or(labels["quality"] == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(labels["toxic"] == 1), F.lit(False)).alias("toxic"),
    )
    no = F.lit(False)
    marked = rows.join(marks, "id", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    if repeat is None:
        counted = marked.withColumnRenamed("c", "n")
    else:
        counted = _repeats(marked, 1 << list(rules).index(repeat))
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _repeats(marked: DataFrame, bit: int) -> DataFrame:
    """Numbers of rows by part, marks and mask, with ``bit`` set for rows that repeat one of a smaller id."""
    known = F.col("id").isNotNull()
    alike = ["digest", "part", "mask", "good", "toxic"]
    # A group of copies is a few rows from here on: those of its smallest ids and how many there are in all.
    few = marked.groupBy(*alike).agg(
        F.sum("c").alias("n"),
        F.min(F.when(known, F.struct("id", "c"))).alias("first"),
        F.coalesce(F.sum(F.when(~known, F.col("c"))), F.lit(0)).alias("nameless"),
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first.id") == F.col("least"), F.col("first.c")).otherwise(0)
    passing = F.col("nameless") + F.coalesce(own, F.lit(0))
    both = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), passing.alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), (F.col("n") - passing).alias("n")),
        )
    )
    split = few.withColumn("least", least).select("part", "good", "toxic", both.alias("e"))
    return split.select("part", "good", "toxic", "e.mask", "e.n").filter("n > 0")


# Diagrams


Counts = tuple[int, int, int]
NONE: Counts = (0, 0, 0)


def _plus(a: Counts, b: Counts) -> Counts:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


class Node:
    """A remainder of masks: those that pass this level's filter go to ``low``, the others to ``high``."""

    __slots__ = ("low", "high", "counts")

    def __init__(self, low: "Node | None", high: "Node | None", counts: Counts):
        self.low, self.high, self.counts = low, high, counts


EMPTY = Node(None, None, NONE)


class Diagram:
    """Counts by mask, with one level for each filter in ``order``; equal remainders are one node."""

    def __init__(self, n: int, masks: Mapping[int, Counts]):
        self.order = list(range(n))
        self.levels: list[dict[tuple[int, int], Node]] = [{} for _ in range(n)]
        ends: dict[Counts, Node] = {}
        at = {m: ends.setdefault(c, Node(None, None, c)) for m, c in masks.items() if c != NONE}
        self.ends = ends
        for level in reversed(range(n)):
            bit = 1 << level
            at = {m: self._node(level, at.get(m, EMPTY), at.get(m | bit, EMPTY)) for m in {m & ~bit for m in at}}
        self.root = at.get(0, EMPTY)

    def _node(self, level: int, low: Node, high: Node) -> Node:
        if low is EMPTY and high is EMPTY:
            return EMPTY
        known = self.levels[level]
        key = (id(low), id(high))
        if key not in known:
            known[key] = Node(low, high, _plus(low.counts, high.counts))
        return known[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of this level and the next; only nodes of these two change."""
        nodes = list(self.levels[level].values())
        below = self.levels[level + 1]  # held, so that no new node takes the place of an old one
        self.levels[level], self.levels[level + 1] = {}, {}
        for node in nodes:
            low, high = node.low, node.high
            passing = self._node(level + 1, low.low or EMPTY, high.low or EMPTY)
            failing = self._node(level + 1, low.high or EMPTY, high.high or EMPTY)
            node.low, node.high = passing, failing
            self.levels[level][id(passing), id(failing)] = node
        below.clear()
        order = self.order
        order[level], order[level + 1] = order[level + 1], order[level]

    def reorder(self, order: Sequence[int]) -> None:
        """Bring the levels into this order by swaps of neighbours."""
        for level, wanted in enumerate(order):
            for k in reversed(range(level, self.order.index(wanted))):
                self.swap(k)

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Along the path where all filters pass: the filter, what it removes, and what is kept after it."""
        node = self.root
        for name in self.order:
            removed, kept = (node.high or EMPTY).counts, (node.low or EMPTY).counts
            yield name, removed, kept
            node = node.low or EMPTY

    def size(self) -> int:
        return sum(map(len, self.levels)) + len(self.ends)


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places to swap, one after another, so that ``n`` things run through all their orders once.

    The largest thing walks through an order of the others to one end; then these take their own next step.
    """
    if n < 2:
        return
    others, left = neighbour_swaps(n - 1), True
    while True:
        yield from reversed(range(n - 1)) if left else range(n - 1)
        step = next(others, None)
        if step is None:
            return
        # While the largest stands at the left end, the others are one place further right.
        yield step + 1 if left else step
        left = not left


def _orders(diagram: Diagram, wanted: list[list[int]] | None) -> Iterator[None]:
    """Bring the diagram into each order in turn: the given ones, or all."""
    if wanted is None:
        yield
        for level in neighbour_swaps(len(diagram.order)):
            diagram.swap(level)
            yield
    else:
        for order in wanted:
            diagram.reorder(order)
            yield


def all_steps(n: int, masks: Mapping[int, Counts], wanted: list[list[int]] | None = None) -> list[tuple]:
    """Per order and step: order, step, filter, kept, removed, redundant, unique, good, toxic, and the filter's sum of removed."""
    diagram = Diagram(n, masks)
    fails, alone = [0] * n, [0] * n
    for f in range(n):
        others = [k for k in range(n) if k != f]
        diagram.reorder([f, *others])
        fails[f] = next(diagram.steps())[1][0]
        diagram.reorder([*others, f])
        alone[f] = list(diagram.steps())[-1][1][0]
    found, total = [], [0] * n
    for _ in _orders(diagram, wanted):
        order = tuple(diagram.order)
        for k, (f, removed, kept) in enumerate(diagram.steps()):
            total[f] += removed[0]
            found.append((order, k + 1, f, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2]))
    return [(*row, total[row[2]]) for row in found]


def audit(masks: DataFrame, names: Sequence[str], orders: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """One row per part, order and step, from ``failure_masks``; see ``STEPS`` for the columns.

    ``names`` are the filters, bit 0 first, of one letter each or joined as they are. Without
    ``orders`` all of them are taken. ``shapley`` sums what a filter removes over the orders taken.
    """
    names, n = list(names), len(names)
    wanted = None if orders is None else [[names.index(x) for x in order] for order in orders]
    if wanted is None and n > MOST_IN_ALL_ORDERS:
        raise ValueError(f"{factorial(n)} orders are too many: name some")
    if wanted is not None and any(sorted(w) != list(range(n)) for w in wanted):
        raise ValueError("an order names every filter once")

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(a), int(b), int(c)) for m, a, b, c in rows[["mask", "n", "good", "toxic"]].itertuples(index=False)}
        part = rows["part"].iloc[0]
        steps = [(part, "".join(names[f] for f in order), k, *rest) for order, k, _, *rest in all_steps(n, counts, wanted)]
        return pd.DataFrame(steps, columns=[c.split()[0] for c in STEPS.split(", ")])

    return masks.groupBy("part").applyInPandas(of_part, STEPS)


def audit_texts(docs: DataFrame, labels: DataFrame, part: str = "lang", orders: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """The five filters of ``text_rules`` over documents, in all orders or the given ones."""
    rules = text_rules()
    return audit(failure_masks(docs, labels, rules, repeat="E", part=part), list(rules), orders)


def sql() -> str:
    """The same in DuckDB's SQL, from masks alone."""
    orders = ["".join(p) for p in permutations("ABCDE")]
    return f"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS least FROM t),
m AS (SELECT part, doc_id,
  CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
o AS (SELECT unnest({orders!r}) AS filter_order),
s AS (SELECT filter_order, step, CAST(1 << (ascii(substr(filter_order, step, 1)) - 65) AS INTEGER) AS bit,
  CAST(coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(substr(filter_order, k, 1)) - 65))), 0) AS INTEGER) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
r AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
  coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
  coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
  coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""
