"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _stars(edges: DataFrame) -> bool:
    """Whether every link leads from a leaf (a), which has no other, to a smaller centre (b)."""
    many = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    inner = edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi")
    return edges.where("b > a").select("a").unionByName(many).unionByName(inner).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node), for every node of the links (a, b).

    Links are turned into stars by two alternating steps: every node hands its larger neighbours, and then its
    smaller ones, to the smallest node it knows, until only stars are left. The number of rounds grows with the logarithm of the longest path.
    The smallest neighbours are written before they are joined, so Spark can split the rows of a node with very many links.
    A step makes at most two rows of each link, and they are written as files of so many rows, not one for each shuffle partition.
    """
    most = 2 * links.count()
    edges = settle(links.select("a", "b").where("a != b").distinct(), "links", most)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least", most)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        large = settle(large.distinct(), "large", most)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = settle(down.groupBy("a").agg(F.min("b").alias("m")), "least", most)
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = settle(small.where("a != b").distinct(), "links", most)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node")).distinct().join(stars.select("node"), "node", "left_anti")
    return settle(stars.unionByName(centres.select("node", F.col("node").alias("component"))), "components", most)
