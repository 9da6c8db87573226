"""Connected components of a large graph, by rounds of joins whose input is a table each time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.tables import keep


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges a, b.

    Each round hangs the larger neighbours of every node, then the smaller ones, below the smallest; both keep what
    is connected, and the rounds end, after about log(length of the longest chain), when every node hangs below the
    root of a star. Nothing but a count and a checksum comes to the driver. Neighbours are only ever aggregated, so a
    node with very many of them is no problem for memory; joins on it are split as skewed.
    """
    now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), label)
    before = None
    while True:
        state = now.select(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b").distinct()
            )
        before = state
        both = now.union(now.select("b", "a"))
        lows = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(lows, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lows, "a")
        small = small.select("a", F.col("low").alias("b")).union(small.select(F.col("b").alias("a"), F.col("low").alias("b")))
        now = keep(small.filter("a != b").distinct(), label)
