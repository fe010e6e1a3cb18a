"""Normalised neighbour sums over an edge table (graph convolution without weights)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from arbolytics.session import stage


def with_self_loops(edges: DataFrame, vertices: DataFrame, vertex: str = "vertex") -> DataFrame:
    """Adds one edge from every vertex to itself."""
    loops = vertices.select(F.col(vertex).alias("src"), F.col(vertex).alias("dst"))
    return edges.select("src", "dst").unionByName(loops)


def propagate_once(edges: DataFrame, features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x'_i = sum over edges j -> i of x_j / sqrt(outdeg(j) * indeg(i)).

    The source's factor is applied per vertex before the join and the target's
    after the sum, so each edge only carries numbers to add; sums are built
    per task before the shuffle.
    """
    out_degree = edges.groupBy(F.col("src").alias("vertex")).agg(F.count(F.lit(1)).alias("d_out"))
    scaled = features.join(out_degree, "vertex").select(
        F.col("vertex").alias("src"),
        *[(F.col(c) / F.sqrt("d_out")).alias(c) for c in columns])
    sums = (edges.join(scaled, "src").groupBy(F.col("dst").alias("vertex"))
            .agg(*[F.sum(c).alias(c) for c in columns], F.count(F.lit(1)).alias("d_in")))
    return sums.select("vertex", *[(F.col(c) / F.sqrt("d_in")).alias(c) for c in columns])


def propagate(edges: DataFrame, features: DataFrame, columns: Sequence[str], hops: int = 2) -> DataFrame:
    """``hops`` rounds. Vertices without an incoming edge drop out; add self-loops first.

    Edges and the rounds in between are staged, so no round computes the
    previous one again.
    """
    if hops > 1:
        edges = stage(edges, "propagation-edges")
    for i in range(hops):
        features = propagate_once(edges, features, columns)
        if i < hops - 1:
            features = stage(features, "propagation-round")
    return features


def neighbour_summaries(edges: DataFrame, features: DataFrame, columns: dict[str, str], names: dict[str, str] | None = None) -> DataFrame:
    """For each target of the edges (src, dst) one aggregate (``min``, ``max`` or ``avg``) of each column over its sources.

    Unlike sums over neighbours, the least and the greatest keep what a single neighbour has. Each is built
    per task before the shuffle. ``names`` renames the results.
    """
    kinds = {"min": F.min, "max": F.max, "avg": F.avg}
    found = edges.select("src", "dst").join(features.withColumnRenamed("vertex", "src"), "src")
    return found.groupBy(F.col("dst").alias("vertex")).agg(
        *[kinds[kind](c).alias((names or {}).get(c, c)) for c, kind in columns.items()])
