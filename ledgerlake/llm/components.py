"""Connected components of links between long ids, by alternating stars.

A large star hangs all larger neighbours of a node onto its smallest neighbour, a small star
hangs a node and its smaller neighbours onto the smallest one; after some rounds every
component is one star. Every step is a grouping by node with partial sums and a join, so a
hub is never gathered in one task, and every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (u, v) with u > v, after one large or small star."""
    if small:
        near = edges
    else:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    joined = near.join(least, "u")
    if small:
        moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.where("u != m").select("u", F.col("m").alias("v"))
        return moved.unionByName(own).distinct()
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, root) for every node of `links` (a, b) but the roots, which are the smallest.

    The rounds are written to `folder`, the last one stays there as the result.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(edges.distinct(), "links", folder)
    state = None
    while True:
        edges = materialize(_star(_star(edges, small=False), small=True), "links", folder)
        sums = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state == tuple(sums):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(sums)
