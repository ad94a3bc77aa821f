"""Connected components of links between numbered nodes, by alternating star rounds on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.sources.storage import store


def _settled(edges: DataFrame) -> bool:
    """Does every node have one larger-to-smaller edge, to a node that has none?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("ups"), F.sum("down").alias("downs"))
    return ends.filter("ups > 1 or (ups = 1 and downs > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours its smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node (edges run from larger to smaller) ties itself and its smaller neighbours to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for each node of ``links`` (``a``, ``b``); the component is its smallest node.

    Smallest neighbours are found by aggregation and joined back, so a node with very many links is reduced before
    it moves. Rounds end when every node is tied to its smallest one directly.
    """
    edges = store(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while not _settled(edges):
        edges = store(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
