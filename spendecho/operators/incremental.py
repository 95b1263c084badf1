"""Watermarked increments and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import WATERMARK_FLOOR
from .joins import first_per_key


def watermark(target: DataFrame, column: str) -> Column:
    """Greatest value in the target as a scalar subquery, floor when empty."""
    floor = F.lit(WATERMARK_FLOOR).cast("timestamp_ntz")
    return target.agg(F.coalesce(F.max(column), floor).alias("mark")).scalar()


def newer_rows(
    source: DataFrame, target: DataFrame, column: str, lookback: Column | None = None
) -> DataFrame:
    """Rows strictly newer than the target's maximum: ties and late rows are
    skipped unless a lookback interval is given."""
    mark = watermark(target, column)
    if lookback is not None:
        mark = mark - lookback
    return source.filter(F.col(column) > mark)


def upsert(target: DataFrame, increment: DataFrame, key: str) -> DataFrame:
    """Delete the increment's keys from the target, then insert the increment."""
    kept = target.join(increment.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(increment.select(*target.columns))


def merge_increment(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    return upsert(target, newer_rows(source, target, column), key)


def current_rows(versions: DataFrame, key: str, column: str) -> DataFrame:
    """The same result read from an append-only table of increments: since each
    increment is strictly newer, the newest version of a key is its live row.

    Appending costs the size of the increment; the target is never rewritten.
    Increments read with a lookback are not strictly newer: they belong in `upsert`.
    """
    return first_per_key(versions, [key], [F.col(column).desc()])
