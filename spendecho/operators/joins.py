"""Joins and rankings that stay even when one key holds a large share of the rows.

Look-ups are plain left or anti joins against unique keys: the adaptive planner
splits the partition of a hot key on the left side, however many hot keys there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BROADCAST_ROWS = 50_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most max_rows + 1 rows, so the check itself is bounded."""
    return df.limit(max_rows + 1).count() <= max_rows


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key. The rank filter also runs before the shuffle, so
    each task sends at most one row per key, however many there are."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their row counts.

    Aggregates first, so a hot key is one row before anything is joined.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_key")).agg(
        F.count("*").alias("n_rows")
    )
    parents = parent.select(F.col(parent_key).alias("_key"))
    return keys.join(parents, "_key", "left_anti").withColumnRenamed("_key", child_key)
