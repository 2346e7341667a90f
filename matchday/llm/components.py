"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.scratch import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down, to a node that has none."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    chained = edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi")
    return several.unionByName(chained).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b. Returns node, root (the smallest node of its component) for every node but the roots.

    Each round joins links with the smallest neighbour of each node, a partial aggregate; the rounds grow with the logarithm of
    the longest path. No node's neighbours are ever gathered. An empty table gives an empty one.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = written(
            large.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
