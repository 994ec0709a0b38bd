"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import landed


def _star(edges: DataFrame, low: DataFrame, *, large: bool) -> DataFrame:
    """Hang neighbours of each node on the smallest of them.

    ``edges (u, v)`` has v < u. The large step moves each node's larger neighbours, the small step
    its smaller ones and itself.
    """
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = edges.join(low, "u")
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            hung.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node of the component) for every node of an edge.

    ``edges`` has two columns of integer ids; direction, repeats and loops do not matter. Each
    step is an aggregation and a join on the node; rounds grow with the logarithm of the longest
    path, and each ends in a table of the shared folder. Nothing reaches the driver but counts.
    """
    a, b = (F.col(c) for c in edges.columns)
    edges = (
        edges.where(a != b)
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = landed(edges, "edges")
    before = None
    while True:
        ends = edges.groupBy("u").agg(F.min("v").alias("m"))
        starts = edges.groupBy(F.col("v").alias("u")).agg(F.min("v").alias("m"))
        low = ends.union(starts).groupBy("u").agg(F.min("m").alias("m"))
        edges = _star(edges, low, large=True)
        edges = _star(edges, edges.groupBy("u").agg(F.min("v").alias("m")), large=False)
        edges = landed(edges, "edges")
        # finished when the edges are stars: a fingerprint of the table stays the same
        after = edges.agg(
            F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
