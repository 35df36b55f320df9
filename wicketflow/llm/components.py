"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of `edges` (a, b); root is the smallest node reachable.

    Each round hangs every node under the smallest node next to it, first the larger, then
    the smaller neighbours, so the number of rounds grows as the logarithm of the size. The
    links never leave Spark; only their count and a checksum reach the driver. Each round is
    written to the shared folder, so a lost executor repeats one round at most. A hub's rows
    are split by adaptive execution. Links from a node to itself and repeated or null links
    are allowed and change nothing.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = stage(edges.where(F.col("a") != F.col("b"))
                  .select(a.alias("u"), b.alias("v")).distinct(), "links")
    before = None
    while True:
        links = stage(_small_star(_large_star(links)).distinct(), "links")
        after = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                      .first())
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = (both.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))
