"""CSV files to Bronze tables."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..schemas import AD_SCHEMA, FEEDBACK_SCHEMA
from ..session import workers_import_package
from .ledger import Ledger, uri, usable
from .observed import observed
from .tables import Bucket, save

NULL_TOKENS = ("", "NULL")
#: Tasks that look at headers.
PROBES = 64


@dataclass(frozen=True)
class Dataset:
    file: str
    table: str
    schema: T.StructType
    text_only: bool = False  # messy source: every column stays text


DATASETS = {
    d.table: d
    for d in (
        Dataset("meta_ads.csv", "meta_ads", AD_SCHEMA),
        Dataset("google_ads.csv", "google_ads", AD_SCHEMA),
        Dataset("tiktok_ads.csv", "tiktok_ads", AD_SCHEMA),
        Dataset("customer_feedback.csv", "customer_feedback", FEEDBACK_SCHEMA, text_only=True),
    )
}


def _columns(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.rstrip("\r").removeprefix("\ufeff")]), ()))


#: Bytes of a file that are looked at first for its header; more only if it is longer.
PREFIX = 1 << 16


def first_line(stream, step: int = PREFIX) -> str | None:
    """The first line that is not blank, read `step` bytes at a time."""
    held = b""
    while True:
        more = stream.read(step)
        held += more
        *lines, rest = held.split(b"\n")
        for line in lines if more else [*lines, rest]:
            if line.removeprefix(b"\xef\xbb\xbf").strip():
                return line.decode(errors="replace")
        if not more:
            return None
        held = rest


def _probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The header lines of files, opened by the task."""
    from pyarrow import fs

    for frame in frames:
        lines = []
        for path in frame["file"]:
            full = "file:///" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
            store, place = fs.FileSystem.from_uri(full)
            with store.open_input_stream(place, compression="detect") as stream:
                lines.append(first_line(stream))
        yield frame.assign(line=lines)


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the header of every file, by its URI. Tasks read a prefix of each, whatever its
    size; where they cannot open the store without Spark, the first split is read."""
    found = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))
    first = found.head()
    if first is None or usable(Ledger(uri(spark, first.file).rsplit("/", 1)[0])):
        workers_import_package(spark)
        return found.repartition(PROBES).mapInPandas(_probe, "file string, line string")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("i"), "value",
    )
    return lines.filter((F.col("at") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "i").alias("line"))


def header_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by the order of their columns. One order, as is usual, is one row to the
    driver and stands for the whole path; the files are named only where orders differ."""
    lines = header_lines(spark, path).filter("line IS NOT NULL").withColumn("line", F.rtrim("line", F.lit("\r")))
    orders: dict[tuple[str, ...], list[str]] = {}
    for row in lines.select("line").distinct().collect():
        orders.setdefault(_columns(row.line), []).append(row.line)
    if len(orders) < 2:
        return {order: [path] for order in orders}
    named = lines.groupBy("line").agg(F.collect_list("file").alias("files")).collect()
    return {order: [unquote(f) for row in named if row.line in alike for f in row.files] for order, alike in orders.items()}


def read_csv(
    spark: SparkSession, path: str, dataset: Dataset, null_tokens: tuple[str, ...] = NULL_TOKENS
) -> DataFrame:
    """Columns by header name, cast to the declared types. Files of one folder may
    have their columns in different orders; each order is read on its own.

    A missing path fails here, before anything is written. A malformed row or a
    bad number fails the job. Free text may hold line breaks, so those files
    are read whole per file: land them as many files, not one.
    """
    # With column pruning the parser would let a row with too few fields pass.
    reader = spark.read.option("columnPruning", False)
    groups = [files for _, files in sorted(header_groups(spark, path).items())] or [path]

    def value(field: T.StructField):
        c = F.col(field.name)
        return F.when(~c.isin(list(null_tokens)), c).cast(field.dataType).alias(field.name)

    parts = [
        reader.csv(
            files, header=True, sep=",", quote='"', escape='"', mode="FAILFAST",
            multiLine=dataset.text_only, enforceSchema=False,
        ).select(*[value(f) for f in dataset.schema])
        for files in groups
    ]
    return reduce(DataFrame.unionByName, parts)


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.localtimestamp())


def read_all(
    spark: SparkSession, folder: str, datasets: dict[str, Dataset] = DATASETS
) -> dict[str, DataFrame]:
    """Every input, checked for existence before the first write."""
    return {t: read_csv(spark, f"{folder}/{d.file}", d) for t, d in datasets.items()}


def land(df: DataFrame, table: str, truncate: bool = False, bucket: Bucket | None = None) -> int:
    """Append to (or replace) a Bronze table; returns the rows written, counted
    during the write. Appending the same files twice doubles them."""
    seen = Observation()
    out = with_load_time(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    save(out, table, "overwrite" if truncate else "append", bucket=bucket)
    return observed(seen, "rows")
