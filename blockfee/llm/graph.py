"""Connected components of links, without a node's neighbours ever meeting in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def connected(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is connected with, ``root``, for all nodes of ``links`` (a, b).

    Large-star and small-star steps in turn: each node hands its larger, then its smaller
    neighbours on to the smallest. Only minima are aggregated, which Spark combines before
    the shuffle, and the number of rounds grows with the logarithm of a component's
    size. Each round is stored; a link from a node to itself just names the node.
    """
    pairs = stored(_distinct(links), "links")
    while not _all_at_roots(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = _distinct(_star(both, F.col("b") > F.col("a")))
        pairs = stored(_distinct(_star(pairs, F.lit(True))), "links")
    roots = pairs.select("b").distinct().select("b", F.col("b").alias("a"))
    return pairs.unionByName(roots).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def _star(pairs: DataFrame, moved) -> DataFrame:
    """Each b that ``moved`` takes is linked to the smallest neighbour of its a, and so is a."""
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    handed = pairs.join(least, "a").where(moved).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return handed.unionByName(least.select("a", F.col("least").alias("b")))


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _all_at_roots(pairs: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most, and that one has none."""
    smaller = pairs.where("a > b").groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most"))
    if not smaller.where("least < most").isEmpty():
        return False
    inner = smaller.select(F.col("a").alias("b"))
    return pairs.where("a > b").join(inner, "b", "left_semi").isEmpty()
