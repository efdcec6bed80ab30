"""Connected components of links held as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, staged


def _stars(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them, then the larger ones.

    The staged ``edges`` are deleted.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Read back from a table, so that the join can split a node with very many neighbours.
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    large = (both.join(least, "a").where(F.col("b") > F.col("a"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
    large = staged(large)
    low = staged(large.groupBy("a").agg(F.min("b").alias("m")))
    small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .unionByName(low.select("a", F.col("m").alias("b"))))
    small = staged(small.distinct())
    free(edges, least, large, low)
    return small


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: every node of ``edges`` (a, b) with the smallest node it is linked to.

    Stars are contracted until each node hangs on one other only and no chain is left, in
    about as many rounds as the logarithm of the longest chain. Every round is written to
    the shared folder. Null and self links are left out.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        edges = _stars(edges)
        nodes = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        open_ = nodes.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where(
            "down > 1 or (down > 0 and up > 0)")
        if open_.isEmpty():
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
