"""Connected components of links between ids, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordspan.llm.common import stage


def large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it. Edges point from larger to smaller."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """a, b: each linked id but the smallest of its component, and that smallest id.

    Links of an id with itself and repeated links don't matter. Only minima are gathered for an id, and joins on a hub
    are split where they are skewed, so no task holds a component. Every round is written to the shared folder; rounds
    grow with the logarithm of the longest chain.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = stage(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges
        before, edges = now, stage(small_star(large_star(edges)))
