"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagweave.storage import release, stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest one: those above the node (large), or those below and the node itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        linked = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, whole numbers); the root is the smallest in reach.

    Each round is two groupings and joins over the edges, staged; a node with many
    neighbours is split by the join and never gathered. Rounds grow with the
    logarithm of the longest chain. No edges give an empty result.
    """
    edges = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        large = stage(_stars(edges, True), "large")
        small = stage(_stars(large, False), "small")
        release(edges, large)
        edges = small
        now = tuple(small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
