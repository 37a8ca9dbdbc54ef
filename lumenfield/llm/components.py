"""Connected components of a graph of links, as alternating large-star and small-star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import stash


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links`` (``a``, ``b``); the component is its smallest node.

    Each step is an aggregation and a join over the links, written to the shared folder, so nothing is
    gathered on the driver but a count and a checksum. The number of steps grows with the logarithm of
    the longest path. An empty input gives an empty result; null ends are ignored.
    """
    edges = stash(links.filter("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    before = signature(edges)
    while before[0]:
        edges = stash(small_star(large_star(edges)), "stars")
        after = signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return roots.union(edges.select("u", "u")).distinct()


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Each node joins its larger neighbours to the least node around it."""
    both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).union(edges.select("u", "v"))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node joins itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.union(least.select("v", F.col("m").alias("u"))).filter("v != u").distinct()
