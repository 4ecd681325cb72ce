"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    linked = both.join(least, F.col("a") == F.col("node")).filter("b > node")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b"))  # repeats go with the next step's


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    linked = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; longs); the root is a component's smallest node.

    Smallest neighbours are found by partial aggregation and joined back, so a
    node with any number of neighbours is split like any skewed join key. Each
    round is written, so that a lost executor repeats one round at most. A round
    that changes nothing ends the work: by then every edge leads to a root.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    mark = None
    while True:
        edges = stage(edges, f"{name}-star")
        # Sums of 31-bit hashes cannot overflow for any number of edges that fits a disk.
        now = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"), F.sum(F.crc32(F.concat_ws(",", "a", "b").cast("binary"))).alias("c")).first()
        if tuple(now) == mark or not now.n:
            break
        mark = tuple(now)
        edges = _small_star(_large_star(edges))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
