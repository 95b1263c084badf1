"""Word splitting in SQL expressions, scratch tables, and totals in a global order."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import remove_scratch, scratch_path

#: While a scratch table is written: its shuffle files go with the job, and Python
#: gets texts in batches of a size that fits several tasks of an executor.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written under the shared folder and read back. Cuts the lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = {k: spark.conf.get(k) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove tables of `written` that nothing reads any more."""
    for df in frames:
        remove_scratch(df.sparkSession, df.scratch)


#: Rows of a table up to which `small` has it broadcast; rows are narrow there.
SMALL = 100_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """`df` to be broadcast if a count of a written table finds few rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """`df.mapInArrow`, with this package on the workers' path where they share the
    folder it lies in (elsewhere it is shipped with --py-files)."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return df.mapInArrow(run, schema)


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and \\t to \\r; NULL has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))


def running_totals(rows: DataFrame, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """`rows` with, per entry of `sums`, the total over all rows that come before
    in `order` (a total order). Rows are range sorted; each partition adds up its
    own rows, and one row per partition carries the offsets."""
    part, first = "_part", Window.unboundedPreceding
    ranged = written(
        rows.withColumns({f"_{k}": v for k, v in sums.items()}).orderBy(*order).withColumn(part, F.spark_partition_id()),
        label,
    )
    offsets = ranged.groupBy(part).agg(*[F.sum(f"_{k}").alias(f"_o{k}") for k in sums])
    before = Window.orderBy(part).rowsBetween(first, -1)
    offsets = offsets.select(part, *[F.coalesce(F.sum(f"_o{k}").over(before), F.lit(0)).alias(f"_o{k}") for k in sums])
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(first, -1)
    own = {k: F.coalesce(F.sum(f"_{k}").over(inside), F.lit(0)) for k in sums}
    joined = ranged.withColumns(own).join(offsets, part)
    joined = joined.withColumns({k: F.col(k) + F.col(f"_o{k}") for k in sums})
    return joined.drop(part, *[f"_{k}" for k in sums], *[f"_o{k}" for k in sums])
