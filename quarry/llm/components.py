"""Connected components of an undirected edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself; partial sums keep hubs from meeting in one task."""
    return edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    pairs = _both(edges)
    joined = pairs.join(_least(pairs), "a").filter(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them; here a > b in every edge."""
    joined = edges.join(_least(edges), "a")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(joined.select("a", F.col("least").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (a, b).

    The number of rounds grows with the logarithm of the longest path, and each round's edges are
    written to the shared folder. It ends once every node hangs on its component's least node.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct(), "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first())
    before = state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        if (now := state(edges)) == before:
            break
        before = now
    labels = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return labels.unionByName(labels.select(F.col("component").alias("node"), "component").distinct())
