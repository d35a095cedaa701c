"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.tables import written

MOST_ROUNDS = 60


def _lowest(edges: DataFrame) -> DataFrame:
    """Each edge ``(a, b)`` with ``m``, the smallest of a and all its neighbours."""
    lowest = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return edges.join(lowest.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).drop("_a")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _lowest(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = _lowest(down)
    hung = stars.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(stars.select("a", F.col("m").alias("b")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one or is such a smaller one, but not both."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node that each node of an edge reaches.

    Ends when all edges are stars around their smallest nodes; the number of
    rounds grows with the logarithm of the longest path. Every round is written
    to the shared folder. Null ends, loops and repeated edges are allowed and
    change nothing.
    """
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = edges.where("a <> b").distinct()
    for _ in range(MOST_ROUNDS):
        edges = written(_small_star(_large_star(edges)).distinct())
        if _are_stars(edges):
            break
    # Now every edge leads from a node to the smallest of its component.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
