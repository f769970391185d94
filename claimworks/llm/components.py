"""Connected components of a link table, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import checkpointed


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (both.where("v > u").join(least, "u").where("v != m")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return (joined.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns) that is not its component's least.

    Rounds of large and small stars shorten every path until each node hangs on
    its component's least node; the number of rounds grows with the logarithm of
    the longest path. Each round is written to the checkpoint folder.
    """
    edges = checkpointed(edges.toDF("a", "b").where("a != b"))
    state = None
    while True:
        edges = checkpointed(_small(_large(edges)))
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if now == state:
            return edges.toDF("node", "root")
        state = now
