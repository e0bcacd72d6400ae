"""Distributed union-find: connected components by alternating star steps.

Edges live in tables; every step is an aggregate and a join, both by node.
The minimum of a node's neighbours is a partial aggregate; it is written
before the join, so the join is either broadcast (when Spark finds the table
small) or a shuffled join whose hot nodes adaptive execution can split.
Every round is written to the shared folder, which cuts the lineage.  The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _done(edges: DataFrame) -> bool:
    """Are the edges a forest of stars already: one edge down from every node, to a node without any?"""
    ends = edges.select(F.col("b").alias("a")).distinct()
    return edges.groupBy("a").count().filter("count > 1").isEmpty() and edges.join(ends, "a", "left_semi").isEmpty()


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), name)
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    low = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), name)
    moved = edges.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node reachable."""
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), name)
    first = True
    while not _done(e):
        # links to a few hubs are nearly stars: the first step is a small one
        wide = e if first else materialize(_large_star(e, name), name)
        e = materialize(_small_star(wide, name), name)
        first = False
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
