"""Connected components of an edge table (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u points to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours point to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): v is the smallest id reachable from u, for every u that is not it.

    ``edges`` has long columns u and v; loops and repeated edges do no harm.
    The edges of each round are written, so a lost executor costs one round.
    Rounds grow with the logarithm of the longest chain; every step is a
    partial minimum per node and a join, so a hub's edges are never gathered.
    """
    now = written(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.count(F.lit(1))
    was = None
    while (sign := tuple(now.agg(*mark).first())) != was:
        was = sign
        before, now = now, written(_small_star(_large_star(now)), "edges")
        discard(before)
    return now
