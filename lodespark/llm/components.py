"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its smallest neighbour or itself."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    across = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return across.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``edges`` (u, v), the smallest node naming it.

    Each step is a grouping with partial minima and a join on the node; a node with many links
    is a skewed join key, which Spark splits. Steps are written to the shared folder, so
    that the lineage stays short. A node linked only with itself, or with null, has no row.
    """
    current = stage(
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = _mark(current)
    while True:
        current = stage(_small_star(_large_star(current).distinct()).distinct())
        before, mark = mark, _mark(current)
        if mark == before:
            break
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)


def _mark(edges: DataFrame) -> tuple:
    code = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(code), F.sum("v")).first())
