"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arbolytics.session import stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)")).first())


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node that has a link to another one.

    Each step joins nodes with the smallest of their neighbours, which is found with partial
    sums, so a node with very many links is no bottleneck. Steps are staged; they end when the links no
    longer change, after a number of rounds that grows with the logarithm of the longest path.
    """
    links = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Every larger neighbour of u is linked to the smallest node around u.
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stage(large, "links")
        # Every smaller neighbour of u, and u, is linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct())
        links, before = stage(small, "links"), state
        state = _state(links)
        if state == before:
            break
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())
