"""Connected components by alternating large-star and small-star steps on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import spread_join, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the edges (a, b); roots and nodes without edges are absent.

    The steps go on until every component is a star, one node with all others linked to it alone; their number grows with the
    logarithm of the longest path.  Links always go from a larger node to a smaller one, so a star's centre is its smallest
    node.  A hub's neighbours are dealt over several tasks.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while True:
        size, stars = _shape(edges)
        if stars:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        # large star: a node's larger neighbours link to the smallest of its neighbourhood
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = spread_join(both, least, "u", "n", 2 * size).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = spread_join(large, low, "u", "n", 2 * size).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "cc")


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """(number of the distinct edges (u, v), whether each u has one edge and is no v)."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    size, broken = nodes.agg(F.sum("up"), F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
    return size or 0, not broken
