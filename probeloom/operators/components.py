"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from ..spread import spread_join


def _stars(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, and none that points is pointed to."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not nodes.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """Columns node and component, the smallest node reachable, for each node of links (columns a and b, a <> b).

    Large-star and small-star steps in turn: each replaces a node's links by links to the smallest neighbour, until
    every component is a star. The number of rounds grows with the logarithm of a component's size. Minima are
    combined before the shuffle, and links of a node with very many of them get its minimum by a broadcast, so they
    aren't gathered anywhere.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = spread_join(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        large = materialize(large, "large-star")
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, down, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
