"""Layered tables and their Parquet exports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..plans.marts import served
from ..schemas import GOLD_TABLES
from . import files
from .observed import observed

PUBLISHED = "_published"
SWAPPING, SWAPPED = "__writing", "__whole"  # names of a table on its way to replace another
LAYERS = ("raw", "staging", "marts", "snapshots")


def create_layers(spark: SparkSession, prefix: str = "") -> dict[str, str]:
    names = {layer: f"{prefix}{layer}" for layer in LAYERS}
    for name in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return names


Bucket = tuple[int, str]  # number of buckets, key


def save(
    df: DataFrame,
    table: str,
    mode: str,
    partition_by: str | None = None,
    bucket: Bucket | None = None,
) -> None:
    """Write a catalog table.

    Partitioned output is rebalanced first: large partitions are split over
    tasks and small ones share a file. Bucketed output is shuffled by the
    bucket key, so that each task writes one bucket instead of a file in every
    bucket; later joins and rankings on that key then need no shuffle.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if bucket:
        df = df.repartition(*bucket)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket:
        writer = writer.bucketBy(*bucket).sortBy(bucket[1])
    writer.saveAsTable(table)


def replace_table(
    df: DataFrame, table: str, partition_by: str | None = None, bucket: Bucket | None = None
) -> DataFrame:
    save(df, table, "overwrite", partition_by, bucket)
    return df.sparkSession.table(table)


def replace_partitions(df: DataFrame, table: str, partition_by: str, by: list[str] | None = None) -> None:
    """Replace the partitions that `df` has rows of; the others stay. With `by`, their
    files are laid out as `append_clustered` does."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    rows = df.select(*spark.table(table).columns)
    if by:
        rows = rows.repartitionByRange(partition_by, *by).sortWithinPartitions(partition_by, *by)
    else:
        rows = rows.hint("rebalance", partition_by)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")  # a table does not take it as an option of the write
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)


def append_table(df: DataFrame, table: str, bucket: Bucket | None = None) -> None:
    save(df, table, "append", bucket=bucket)


def append_clustered(df: DataFrame, table: str, partition_by: str, by: list[str]) -> None:
    """Append rows in files that each hold a range of `by` within a partition, sorted, so
    that statistics of files and row groups tell which of them a filter on `by` needs.
    `partition_by` has no NULLs. Small ranges are joined by the adaptive planner."""
    rows = df.repartitionByRange(partition_by, *by).sortWithinPartitions(partition_by, *by)
    rows.write.mode("append").partitionBy(partition_by).format("parquet").saveAsTable(table)


def swap_table(df: DataFrame, table: str, bucket: Bucket | None = None) -> None:
    """Replace a table that `df` is read from. The new rows are whole in a table beside it
    before the old one goes; `finish_swap` ends a swap that was stopped in between."""
    spark, new = df.sparkSession, f"{table}{SWAPPED}"
    finish_swap(spark, table)
    save(df, f"{table}{SWAPPING}", "overwrite", bucket=bucket)
    spark.sql(f"ALTER TABLE {table}{SWAPPING} RENAME TO {new}")
    finish_swap(spark, table)


def finish_swap(spark: SparkSession, table: str) -> None:
    """A table of the second name is whole, whatever became of the old one."""
    if spark.catalog.tableExists(f"{table}{SWAPPED}"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {table}{SWAPPED} RENAME TO {table}")


def _published(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; 0 if nothing is published."""
    found = [n for n in files.names(spark, f"{folder}/{PUBLISHED}") if n.isdigit()]
    if not found:
        return 0, {}
    return int(max(found)), json.loads(files.read_text(spark, f"{folder}/{PUBLISHED}/{max(found)}"))


def export_marts(
    spark: SparkSession, marts: str, folder: str, names: list[str] = GOLD_TABLES
) -> dict[str, int]:
    """Each mart as a Parquet dataset, with its row count from the write.

    All are written into a folder of their own; a manifest that is renamed into place
    makes them the current set, all at once. A failure leaves the set before. That one
    stays for a while, for readers who have opened it; older ones are removed."""
    number, before = _published(spark, folder)
    version, counts = f"version-{number + 1:012d}-{uuid.uuid4().hex[:8]}", {}
    for name in names:
        seen = Observation()
        rows = served(spark.table(f"{marts}.{name}")).drop("month", "_loaded_at")
        df = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        df.write.parquet(f"{folder}/{version}/{name}")
        counts[name] = observed(seen, "rows")
    told = json.dumps({"version": version, "rows": counts})
    if not files.publish(spark, f"{folder}/{PUBLISHED}/{number + 1:012d}", told):
        raise RuntimeError(f"export {number + 1} of {folder} was published by another driver")
    for old in files.names(spark, folder):
        if old.startswith("version-") and old not in (version, before.get("version")):
            files.remove(spark, f"{folder}/{old}")
    return counts


def exported(spark: SparkSession, folder: str) -> dict[str, str]:
    """Where each mart of the current set lies. Read one set from one call."""
    _, told = _published(spark, folder)
    return {name: f"{folder}/{told['version']}/{name}" for name in told.get("rows", ())}
