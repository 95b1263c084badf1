"""Slowly changing history (type 2), kept as an append-only log of versions.

A version row holds the tracked columns and `valid_from`. Its end is the start
of the key's next version, so closing a row needs no rewrite: a run appends
only what changed, and a run on unchanged input appends nothing. Keys that
leave the source keep their open version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import surrogate_key
from ..schemas import SNAPSHOT_CHECKS
from .joins import first_per_key


def first_versions(source: DataFrame, key: str, checks: list[str], run_ts: Column) -> DataFrame:
    return source.select(key, *checks, run_ts.cast("timestamp_ntz").alias("valid_from"))


def changed_versions(
    log: DataFrame,
    source: DataFrame,
    run_ts: Column,
    key: str = "feedback_id",
    checks: list[str] = SNAPSHOT_CHECKS,
) -> DataFrame:
    """Versions to append: new keys, and keys with any tracked column changed
    (NULL-safe)."""
    live = first_per_key(log, [key], [F.col("valid_from").desc()]).select(
        key, F.struct(*checks).alias("_live")
    )
    now = source.select(key, *checks)
    same = F.struct(*checks).eqNullSafe(F.col("_live"))
    changed = now.join(live, key, "left").filter(~same)
    return first_versions(changed, key, checks, run_ts)


def changed_by_log(
    versions: DataFrame, run_ts: Column, key: str = "feedback_id", checks: list[str] = SNAPSHOT_CHECKS,
    column: str = "_enriched_at",
) -> DataFrame:
    """The same from a log of source versions that carry what they replace in
    `_replaced`: `versions` are those since the last run. Neither the history nor the
    rest of the source is read. Of several versions of a key the newest counts, against
    what stood before the first of them."""
    by_key = versions.groupBy(key).agg(
        F.max_by(F.struct(*checks), column).alias("_now"), F.min_by("_replaced", column).alias("_before")
    )
    before = F.when(F.col("_before").isNotNull(), F.struct(*[F.col(f"_before.{c}").alias(c) for c in checks]))
    changed = by_key.filter(~F.col("_now").eqNullSafe(before)).select(key, "_now.*")
    return first_versions(changed, key, checks, run_ts)


def apply_run(log: DataFrame, source: DataFrame, run_ts: Column, **kw) -> DataFrame:
    return log.unionByName(changed_versions(log, source, run_ts, **kw))


def with_validity(log: DataFrame, key: str = "feedback_id") -> DataFrame:
    """The log as a type 2 table. A key has one version per run at most, so
    its window group is small."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return (
        log.withColumn("valid_to", following)
        .withColumn("version_key", surrogate_key(key, "valid_from"))
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at a moment (start inclusive, end exclusive)."""
    return history.filter(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )


def reclassified(
    log: DataFrame, key: str = "feedback_id", columns: list[str] = SNAPSHOT_CHECKS
) -> DataFrame:
    """What changed and when: every later version next to the one before it."""
    w = Window.partitionBy(key).orderBy("valid_from")
    before = [F.lag(c).over(w).alias(f"old_{c}") for c in columns]
    after = [F.col(c).alias(f"new_{c}") for c in columns]
    numbered = log.select(
        key, F.col("valid_from").alias("changed_at"), F.row_number().over(w).alias("_n"),
        *before, *after,
    )
    return numbered.filter(F.col("_n") > 1).drop("_n")
