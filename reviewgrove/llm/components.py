"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrove.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` from edges ``a, b``: the smallest node that can be reached.

    Rounds of large-star and small-star: every node hands its neighbours on to the smallest one it sees, until all
    edges point at the smallest node of their component. A round shuffles narrow rows only and ends in a written table;
    a node with very many neighbours is summed up before the shuffle, and Spark splits its join.
    """
    now = stage(_oriented(edges), "edges")
    while True:
        # Large star: the larger neighbours of a node go to the smallest of its neighbourhood.
        upward = now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        both = now.select(F.col("a").alias("u"), "b").unionByName(upward.select("u", F.col("v").alias("b")))
        least = both.groupBy("u").agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stage(upward.join(least, "u").filter("v <> m").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b")), "large-star")
        # Small star: the smaller neighbours of a node, and the node, go to the smallest of them.
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small_least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(_oriented(linked.unionByName(small_least.select("a", F.col("m").alias("b")))), "small-star")
        # Done when no node that others point at points further on.
        if not now.select("a").join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return (
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
