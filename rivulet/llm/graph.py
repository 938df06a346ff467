"""Connected components of an edge list by alternating large-star and small-star steps
(Kiveris et al., 2014): joins and minimum aggregates only, O(log^2) rounds, no edge or
component ever on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge, ``root`` the smallest node of its
    component. ``edges`` has long columns ``a`` and ``b``; loops and repeats are allowed."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u != v").distinct(), "cc-edges")
    mark = None
    while True:
        e = stored(_small_star(_large_star(e)).distinct(), "cc-edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
