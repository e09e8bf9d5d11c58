"""Connected components of an edge list, with joins and map-side sums only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))  # see _small_star
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # stored first: then both sides of the join are shuffled for it alone, and Spark may split a hot node
    least = settle(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b): root is the smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), whose number grows with the logarithm of the
    longest path; each step's edges, never more than the input's, are in the checkpoint folder before the next one.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        now = settle(_small_star(settle(_large_star(now))))
        # a forest of stars: every node has one parent, and no parent has one
        parents = now.groupBy("a").count().where("count > 1").select("a").union(now.select("a").join(now.select(F.col("b").alias("a")), "a", "left_semi"))
        if parents.isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
