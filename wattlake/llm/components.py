"""Connected components of an edge table by alternating large and small stars.

Every round is two aggregations and two joins over the edges, written to the shared
folder; nothing is collected but a count and a checksum of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, comp): comp is the smallest node reachable; only nodes with an edge."""
    spark = edges.sparkSession
    e = stage(spark, _orient(edges), "cc-edges")
    mark = _mark(e)
    while True:
        e = stage(spark, _small_star(stage(spark, _large_star(e), "cc-large")), "cc-small")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    # stars: every node points at its smallest one
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(e.select("b", "b")).distinct()


def _orient(e: DataFrame) -> DataFrame:
    return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is joined to the smallest node around it."""
    both = e.union(e.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _orient(both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are joined to the smallest of them."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    out = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _orient(out.union(low.select("a", "m")))
