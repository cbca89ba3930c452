"""Connected components of a graph given as a table of edges.

Alternating star contraction: every node first hands its larger neighbours to
its smallest neighbour, then its smaller ones. Each half step is a grouped
minimum, which combines before its shuffle, and a join, which Spark splits if
one node has very many edges. The edges are written after every round, so that
lost executors cost one round at most, until they form stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellindex.llm.shared import stored


def _hand_over(edges: DataFrame, keep_centre: bool) -> DataFrame:
    """Edges (u, v) to (v, m) with m the smallest of u and its v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = edges.join(least, "u")
    if keep_centre:
        joined = joined.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        pairs = joined.select("e.u", F.col("e.m").alias("v"))
    else:
        pairs = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pairs.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node reachable, for every node with an edge.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type; order, repeats
    and loops do not matter, and edges with a null end are ignored. Nodes that are
    their own root are not listed.
    """
    current = (
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    current = stored(current, "edges")
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        current = stored(_hand_over(_hand_over(both, False), True), "edges")
        # Stars: no node is both a leaf and a centre, and no leaf has two centres.
        tail = current.join(current.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if tail.isEmpty() and current.groupBy("u").count().filter("count > 1").isEmpty():
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
