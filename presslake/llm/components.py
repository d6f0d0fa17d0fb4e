"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node of its component.

    Each round is written to the checkpoint folder; the number of rounds grows with the logarithm of the longest
    chain. A node with very many links is spread by the joins' skew split, its sums by partial aggregation.
    """
    kept = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        large = _large_star(kept).where("a <> b").distinct()
        kept = written(_small_star(large).where("a <> b").distinct(), "links")
        now = kept.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = kept.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
