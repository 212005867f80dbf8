"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.llm.arrays import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return edges.select(F.explode(ends).alias("e")).select("e.a", "e.b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = around.filter("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    ends = F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))
    return tied.select(F.explode(ends).alias("e")).select("e.a", F.col("e.m").alias("b"))


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)``: its smallest reachable id.

    Alternating star contraction: the passes grow with the logarithm of the
    longest path, each is a grouping and a join whose hot nodes are combined
    before the shuffle, and only counts reach the driver. Edges whose ends are
    equal are left out; repeated edges do no harm; no edges give no rows.
    """
    now = edges.filter("a <> b").select("a", "b")
    seen = None
    while True:
        now = _small_star(_large_star(now)).filter("a <> b").distinct()
        now = stored(now, spark, "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("id")).distinct()
    own = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return own.unionAll(roots.select("id", F.col("id").alias("component")))
