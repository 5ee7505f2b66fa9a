"""Connected components by star contraction; every round is a pair of shuffles, no driver state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import drop_stash, stash


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node in its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    low = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = low.groupBy("u").agg(F.min("v").alias("m"))
    moved = low.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its smallest node.

    Self-loops and repeated edges are ignored; a node without edges does not appear. Nulls are dropped.
    The work left is a star forest when a round changes nothing, which takes about the logarithm of
    the longest shortest path. Each round is written to the shared folder.
    """
    now = stash(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if tuple(got) == mark or got[0] == 0:
            break
        mark = tuple(got)
        after = stash(_small_star(_large_star(now).distinct()).filter("u <> v").distinct(), "cc")
        drop_stash(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
