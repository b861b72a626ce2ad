"""Connected components of stored links by alternating star steps.

A step turns the links of each node into links to its smallest neighbour, first towards larger
neighbours, then towards smaller ones. All is joins and aggregates; no neighbour list is
collected. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import attach, stored


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node that can be reached."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(edges)
    while True:
        edges = stored(_small_star(stored(_large_star(edges, mark[0])), 2 * mark[0]))
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Number of links and two sums without carry over their hashes: equal only if nothing changed."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(x or 0 for x in row)


def _towards(sides: DataFrame, total: int) -> DataFrame:
    """The links (u, v) with the smallest of u and its neighbours as ``m``."""
    least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))
    return attach(sides, least, "u", "degree", total)


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    sides = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _towards(sides, 2 * count).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    linked = attach(edges, least, "u", "degree", total)
    moved = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
