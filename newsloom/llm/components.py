"""Connected components of a large set of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least_neighbour(both).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least_neighbour(down)
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node reachable.

    Each round runs both star steps over the links and writes them. The rounds grow with the
    logarithm of the longest chain. Smallest neighbours are found with partial aggregation, and
    joined back in a join whose skewed partitions are split, so a hub does not land in one task.
    """
    def state(table: DataFrame) -> tuple:
        return table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = scratch.save(edges.where("a != b").distinct(), "links")
    before = state(now)
    while before[0]:
        step = scratch.save(_large_star(now).distinct(), "large")
        new = scratch.save(_small_star(step).distinct(), "small")
        after = state(new)
        scratch.drop(step, now)
        now = new
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
