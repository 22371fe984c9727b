"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour, or to itself if that is smaller."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    # repeated rows go in the small star
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours and the node itself move to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    own = least.select(F.col("m").alias("u"), "v")
    return moved.union(own).where("u < v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Does every node have one smaller neighbour, which has none itself?"""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select(F.col("u").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    counts = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return counts.where("below + above > 1").isEmpty()


def stars(edges: DataFrame, group: str = "") -> DataFrame:
    """(u, v) for every node v of ``edges`` (u, v with u < v) that is not the smallest of its component, u; stored in ``group``.

    Each round is a few grouped joins whose partial minima keep a node with many neighbours cheap, and is written
    before the next, which takes the number of rounds to the logarithm of the longest path.  Ends when only stars are
    left, which takes one grouping to see.
    """
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars", group)
        if _settled(edges):
            return edges


def components(edges: DataFrame, group: str = "") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v with u < v); the component is its smallest node.

    The result reads a table stored in ``group``; see :func:`stars`.
    """
    edges = stars(edges, group)
    hubs = edges.select(F.col("u").alias("node")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(hubs.select("node", F.col("node").alias("component")))
