"""Connected components over an edge table, by alternating star contractions. Nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import discard, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")) if large else edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = both.join(least, "u")
    if large:
        hung = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        hung = hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)
    return hung.where("u != v").distinct()


def connected_components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge.

    Edges may repeat and point either way; those with a null end and loops are ignored, except that a loop is no edge and so names
    no node. Each round is written to the shared folder. The number of rounds grows with the logarithm of the nodes.
    """
    a, b = F.col(first), F.col(second)
    now = stored(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )  # u > v throughout
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    mark, before = None, []
    while True:
        # The last two rounds are kept.
        discard(*before[:-1])
        before = [*before[-1:], now]
        now = stored(_stars(_stars(now, large=True), large=False), "stars")
        # A star forest no longer changes: each node hangs on one root, and no root hangs on another.
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            discard(*before)
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct()
            )
        mark = seen
