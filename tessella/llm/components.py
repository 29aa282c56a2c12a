"""Connected components of a link table, by alternating large-star and small-star rounds over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("s")).first()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that has a link, and the smallest node of its component (that node itself has no row).

    Each round is written to the shared folder. Hot nodes are aggregated before the shuffle and joined, never gathered; the
    least neighbours are written before the join, so that Spark can split what one hub's rows make too large.
    """
    edges = stored(_small_star(edges), "links")
    before = _mark(edges)
    while before.n:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges
