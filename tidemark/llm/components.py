"""Connected components of a link table, by alternating stars."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _are_stars(edges: DataFrame) -> bool:
    """Does every node have one smaller neighbour, or none, and then no larger one's?"""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    node = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("low"))
    return node.where("up > 1 or up = 1 and low = 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; the component is its
    smallest node.

    ``links`` has two long columns a, b.  Each round joins every node's larger
    neighbours to its smallest one (large star), then every node with its
    smaller neighbours to the smallest (small star).  Minima are aggregated
    map-side and joined back, so a node with very many links is not gathered in
    one task.  The links are written to the shared folder after each round;
    the driver only learns whether all are stars.
    """
    a, b = F.col("a"), F.col("b")
    edges = stage(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while not _are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stage(star.select("e.u", "e.v").where("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(edges.select("v", "v").distinct())
