"""Connected components of an edge table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, table


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each neighbour that is larger than a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(apart(least, "a"), "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these. Edges run from the larger node to the smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(apart(least, "a"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component for all nodes of edges (a, b) but those that are the smallest of their component.

    Each round writes its edges as a table, so a lost executor costs one round; a component of diameter d takes about
    log2(d) rounds. Ends when every node has one link and no node is both linked and linked to.
    """
    current = table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        current = table(_small_star(_large_star(current)))
        twice = current.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        chained = current.select("a").join(current.select(F.col("b").alias("a")), "a", "left_semi")
        if twice.unionByName(chained).isEmpty():
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
