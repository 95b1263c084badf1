"""The enrichment cache, keyed by (content_hash, model_version): a base and deltas.

    <path>/*.json               deltas: JSON lines, added by every round of enrichment
    <path>/_base/<name>         bases: Parquet, bucketed and sorted by content_hash
    <path>/_generations/<n>     which base counts, and which deltas it holds already

`fold` merges the deltas into a new base. The new base is written beside the old one
and counts from the moment its generation file is renamed into place; only then are the
folded deltas removed. A failure before that leaves the old base and all deltas, one
after it leaves deltas that the generation says to pass over. The base before the last
one stays until the next fold, for readers that have opened it.

A look-up joins the base bucket by bucket, without shuffling it, and parses only deltas.
A cache that is one JSON-lines file can be read and not folded.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.enrichment import SEQUENCE, Layers
from ..operators.joins import first_per_key
from ..schemas import CACHE_SCHEMA
from ..session import materialize
from . import files

KEY = ["content_hash", "model_version"]
#: SEQUENCE is when a record was written, in microseconds of the writing driver's clock.
FILE_SCHEMA = T.StructType([*CACHE_SCHEMA.fields, T.StructField(SEQUENCE, T.LongType())])
BASES, GENERATIONS = "_base", "_generations"
DATABASE = "spendecho_cache"
BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class Generation:
    number: int
    base: str
    buckets: int
    base_bytes: int
    folded: frozenset[str]


def generation(spark: SparkSession, path: str) -> Generation | None:
    """The newest published one."""
    found = [n for n in files.names(spark, f"{path}/{GENERATIONS}") if n.isdigit()]
    if not found:
        return None
    told = json.loads(files.read_text(spark, f"{path}/{GENERATIONS}/{max(found)}"))
    return Generation(int(max(found)), told["base"], told["buckets"], told["base_bytes"], frozenset(told["folded"]))


def delta_files(spark: SparkSession, path: str, at: Generation | None) -> dict[str, int]:
    """Names and bytes of the files that the base does not hold."""
    if files.is_file(spark, path):
        return {"": 1}
    found = {n: size for n, size in files.names(spark, path).items() if size and n[0] not in "_."}
    return {n: size for n, size in found.items() if not (at and n in at.folded)}


def _newest(layered: DataFrame) -> DataFrame:
    """One record per key: the greatest sequence, without one the newest layer, file and place."""
    order = [F.col(SEQUENCE).desc_nulls_last(), *[F.col(c).desc() for c in ("_layer", "_t", "_f", "_b", "_i")]]
    return first_per_key(layered, KEY, order).select(*FILE_SCHEMA.names)


def _deltas(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """All records of the delta files with their place. Blank lines have no key."""
    lines = spark.read.schema(FILE_SCHEMA).json([f"{path}/{n}" if n else path for n in sorted(names)])
    return lines.select(
        *FILE_SCHEMA.names, F.lit(1).alias("_layer"),
        F.col("_metadata.file_modification_time").alias("_t"), F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"),
    ).filter(F.col("content_hash").isNotNull() & F.col("model_version").isNotNull())


def _base(spark: SparkSession, path: str, at: Generation) -> DataFrame:
    """The base as a bucketed table; this catalog learns of it when it is first read."""
    name = f"{DATABASE}.g{hashlib.md5(f'{path}/{at.base}'.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FILE_SCHEMA)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (content_hash) SORTED BY (content_hash) "
            f"INTO {at.buckets} BUCKETS LOCATION '{path}/{BASES}/{at.base}'"
        )
    return spark.table(name)


def open_cache(spark: SparkSession, path: str) -> Layers:
    """The base and the newest record per key of the deltas, each unique by key."""
    at = generation(spark, path)
    names = list(delta_files(spark, path, at))
    parts = [_base(spark, path, at)] if at else []
    if names:
        parts.append(materialize(_newest(_deltas(spark, path, names)), "cache-deltas"))
    return Layers(parts or [spark.createDataFrame([], FILE_SCHEMA)], at.buckets if at else None)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """One record per key, with its write sequence: the greatest sequence wins, in files
    without one the position (newest file, then place in the file), before that of the
    base. A cache that does not exist yet is empty."""
    at = generation(spark, path)
    return _merged(spark, path, at, list(delta_files(spark, path, at)))


def _merged(spark: SparkSession, path: str, at: Generation | None, names: list[str]) -> DataFrame:
    base = _base(spark, path, at).select(*FILE_SCHEMA.names) if at else None
    if not names:
        return base if at else spark.createDataFrame([], FILE_SCHEMA)
    deltas = _deltas(spark, path, names)
    if not at:
        return _newest(deltas)
    old = base.withColumn("_layer", F.lit(0)).withColumns({c: F.lit(None) for c in ("_t", "_f", "_b", "_i")})
    return _newest(deltas.unionByName(old.select(*[F.col(f.name).cast(f.dataType) for f in deltas.schema])))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    return read_versions(spark, path).select(*CACHE_SCHEMA.names)


def _write(records: DataFrame, path: str, mode: str) -> None:
    records.select(*sorted(records.columns)).write.mode(mode).json(path, ignoreNullFields=False)


def write_cache(cache: DataFrame, path: str) -> None:
    """A cache as JSON lines in a folder of its own: rows in key order, fields in name
    order. What was there is replaced, so it must not be what `cache` reads."""
    _write(cache.orderBy(*KEY), path, "overwrite")


def append_cache(records: DataFrame, path: str, sequence: int | None = None) -> None:
    """Add records as new deltas: a checkpoint that a rerun resumes from."""
    at = time.time_ns() // 1000 if sequence is None else sequence
    _write(records.select(*CACHE_SCHEMA.names, F.lit(at).cast("long").alias(SEQUENCE)), path, "append")


def fold_due(spark: SparkSession, path: str, most_files: int = 1000, share: float = 0.1) -> bool:
    """Whether deltas are many files, or a `share` of the base's bytes."""
    if files.is_file(spark, path):
        return False
    at = generation(spark, path)
    found = delta_files(spark, path, at)
    return len(found) > most_files or bool(at and sum(found.values()) > share * at.base_bytes)


def fold(spark: SparkSession, path: str, buckets: int | None = None) -> Generation:
    """Merge the deltas into a new base and publish it. One driver folds at a time; of
    two, the second to publish fails and nothing it wrote counts."""
    if files.is_file(spark, path):
        raise ValueError(f"a cache in one file cannot be folded: {path}")
    at = generation(spark, path)
    deltas = delta_files(spark, path, at)
    total = sum(deltas.values()) + (at.base_bytes if at else 0)
    n = buckets or max(1, -(-total // BUCKET_BYTES))
    base, number = uuid.uuid4().hex, at.number + 1 if at else 1
    merged = _merged(spark, path, at, list(deltas)).repartition(n, "content_hash")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    place = f"{path}/{BASES}/{base}"
    name = f"{DATABASE}.g{hashlib.md5(f'{path}/{base}'.encode()).hexdigest()}"
    merged.write.bucketBy(n, "content_hash").sortBy("content_hash").option("path", place).format("parquet").saveAsTable(name)
    size = sum(files.names(spark, place).values())
    there = files.names(spark, path)
    held = sorted({*deltas, *(at.folded if at else ())} & set(there))
    told = json.dumps({"base": base, "buckets": n, "base_bytes": size, "folded": held})
    if not files.publish(spark, f"{path}/{GENERATIONS}/{number:012d}", told):
        raise RuntimeError(f"generation {number} of {path} was published by another driver")
    for delta in held:
        files.remove(spark, f"{path}/{delta}")
    keep = {base, at.base if at else None}
    for old in set(files.names(spark, f"{path}/{BASES}")) - keep:
        spark.sql(f"DROP TABLE IF EXISTS {DATABASE}.g{hashlib.md5(f'{path}/{old}'.encode()).hexdigest()}")
        files.remove(spark, f"{path}/{BASES}/{old}")
    return generation(spark, path)
