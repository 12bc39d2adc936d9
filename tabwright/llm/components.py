"""Connected components of a graph held as a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("r").alias("l"), F.col("l").alias("r")))
    least = both.groupBy("l").agg(F.min("r").alias("m")).select("l", F.least("m", "l").alias("m"))
    return both.where("r > l").join(least, "l").select(F.col("r").alias("l"), F.col("m").alias("r"))


def _small(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them. Links go from l down to r."""
    least = links.groupBy("l").agg(F.min("r").alias("m"))
    others = links.join(least, "l").where("r <> m").select(F.col("r").alias("l"), F.col("m").alias("r"))
    return others.unionByName(least.select("l", F.col("m").alias("r")))


def _is_stars(links: DataFrame) -> bool:
    """Whether each node has one link at most, and none if it is linked to."""
    ends = links.select(F.explode(F.array(F.struct(F.col("l").alias("node"), F.lit(1).alias("out")), F.struct(F.col("r").alias("node"), F.lit(0).alias("out")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.min("e.out").alias("least"))
    return nodes.where("out > 1 or out > 0 and least = 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``links`` (l, r); the component is its smallest node.

    Each step is two grouped minima and joins whose hot nodes Spark splits; its result is written, so no lineage grows.
    The steps end when every node has one link and no node that is linked to has a link itself.
    """
    now = materialise(links.select(F.greatest("l", "r").alias("l"), F.least("l", "r").alias("r")).where("l <> r").distinct())
    while not _is_stars(now):
        now = materialise(_small(_large(now).distinct()).distinct())
    nodes = now.select(F.col("l").alias("node"), F.col("r").alias("component"))
    return nodes.unionByName(now.select(F.col("r").alias("node"), F.col("r").alias("component")).distinct())
