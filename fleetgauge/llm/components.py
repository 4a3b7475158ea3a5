"""Connected components of a graph by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them. Edges have ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (u, v)``, the root being its component's least.

    Each round takes the stars of larger and of smaller neighbours; it ends when a round changes
    nothing, after a number of rounds about the logarithm of the longest path. The minima are
    aggregated before they are shuffled; the joins may be split, so a node with very many
    neighbours is no single task. Each round is written, which ends the lineage.
    """
    ordered = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stage(ordered.distinct(), "edges")
    before = None
    while True:
        large = _large_star(current).filter("u <> v")
        after = stage(_small_star(large), "stars")
        sums = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == before:
            break
        current, before = after, sums
    roots = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
