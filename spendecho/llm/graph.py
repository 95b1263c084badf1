"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, written


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Ties each node's neighbours (all larger ones, or the smaller ones and the
    node) to the smallest node next to it."""
    if larger_only:
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lows = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = both.join(lows, "a")
    tied = joined.filter(F.col("b") > F.col("a") if larger_only else F.col("b") != F.col("low"))
    tied = tied.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not larger_only:
        tied = tied.union(lows.select("a", F.col("low").alias("b")))
    return tied.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), of any order and repeated;
    root is the smallest node that can be reached. Each round is written, so a lost
    executor costs one round; rounds grow with the logarithm of the longest chain."""
    seen, state = written(edges.select("a", "b").filter("a <> b").distinct(), "edges"), None
    while True:
        large = written(_star(seen, True), "large-star")
        discard(seen)
        seen = written(_star(large, False), "small-star")
        discard(large)
        now = seen.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    roots = seen.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return seen.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
