"""Connected components of a distributed edge list, by alternating star rounds.

Large star links every larger neighbour of a node to the node's least
neighbour; small star does the same for the smaller ones.  Both are a
min-aggregation (combined before the shuffle) and a join, so a hub with a third
of all edges never meets in one group.  Rounds stop when the edges stand still;
each round is cut by a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.common import settle


def _star(edges: DataFrame) -> DataFrame:
    """(node, neighbour) pairs -> distinct (a, b), a > b: neighbour -> least of node and neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node of its component."""
    e = settle(edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).filter("a <> b").distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        e = settle(_star(large))
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
