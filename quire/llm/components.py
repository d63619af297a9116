"""Connected components of a graph too large for one machine: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, stash, tidy


@tidy
def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """``v, root`` for every vertex of ``edges(u, v)``, both bigint: root is the smallest vertex of v's component.

    Each round attaches the neighbours of every vertex to the smallest of them, first the larger ones, then the smaller
    ones, until nothing changes; the number of rounds grows with the logarithm of the longest path. A vertex with very
    many neighbours is no bottleneck: minima are summed up before the shuffle, and the written minima are joined, which
    Spark broadcasts if they are small by their file size and otherwise deals a hot vertex to several tasks.
    Self-loops and repeated edges are fine; an empty table gives no rows.
    """
    now = stash(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    last = None
    for _ in range(rounds):
        # large star: every neighbour larger than u goes to the smallest of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stash(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), name)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stash(large, name)
        drop(least, now)
        # small star: u and its smaller neighbours go to the smallest of them
        least = stash(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = stash(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        drop(least, large)
        # when a round leaves the edges as they are, all are stars
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u") % 1_000_003)).head()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("v"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("v"), "root").distinct())
