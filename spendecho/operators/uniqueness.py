"""Uniqueness of a growing table, checked load by load.

State of a key column, in a folder:

    filter/   bits of the keys' hashes, in blocks of 32,768, a few rows per load
    keys/     the keys themselves, by hash bucket

A load's keys are first looked up in the filter, which is about `BITS` bits a key. Only
those that it may hold are looked up among the keys, and only in their buckets. A load
without a repeated key so reads the filter and no key. Filter bits are written before
keys: a load that stops in between leaves bits without keys, which cost a look-up and
hide nothing. NULL keys are passed over.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BITS, HASHES = 16, 4
BUCKETS = 64


class KeyState:
    """`expected` keys in all sizes the filter; more make it less sharp, never wrong.
    Give the same number each time."""

    def __init__(self, spark: SparkSession, folder: str, expected: int):
        self.spark, self.folder, self.bits = spark, folder, max(1, expected) * BITS

    def _read(self, part: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _places(self, key: Column) -> Column:
        """Where a key's bits are."""
        return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(self.bits)) for i in range(HASHES)])

    def _maybe(self, keys: DataFrame) -> DataFrame:
        """The keys whose bits are all set: all that are known, and few others."""
        bits = self._read("filter", "block long, bits binary")
        if bits is None:
            return keys.limit(0)
        at = keys.withColumn("_place", F.explode(F.array_distinct(self._places(F.col("key")))))
        at = at.withColumns({"block": F.expr("bitmap_bucket_number(_place)"), "_bit": F.expr("bitmap_bit_position(_place)")})
        blocks = bits.join(at.select("block").distinct(), "block", "left_semi").groupBy("block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        octet = "cast(conv(hex(substring(bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
        isset = F.expr(f"({octet} & shiftleft(1, cast(_bit % 8 as int))) <> 0")
        unset = at.join(blocks, "block", "left").filter(~F.coalesce(isset, F.lit(False)))
        return keys.join(unset.select("key").distinct(), "key", "left_anti")

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of `keys` (column key) that an earlier load had."""
        maybe = self._maybe(keys).withColumn("_bucket", self._bucket(F.col("key")))
        buckets = [r[0] for r in maybe.select("_bucket").distinct().collect()]  # at most BUCKETS
        state = self._read("keys", f"key {keys.schema['key'].dataType.simpleString()}, bucket int") if buckets else None
        if state is None:
            return maybe.limit(0).drop("_bucket")
        state = state.filter(F.col("bucket").isin(buckets)).select("key")
        return maybe.drop("_bucket").join(state, "key", "left_semi")

    @staticmethod
    def _bucket(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")

    def check(self, rows: DataFrame, column: str) -> DataFrame:
        """(key, n_rows, seen_before) of the load's keys that stand more than once in it
        or stood in an earlier load. Adds nothing."""
        counted = self._counted(rows, column)
        before = self.known(counted.select("key")).withColumn("_known", F.lit(True))
        found = counted.join(before, "key", "left").withColumn("seen_before", F.coalesce("_known", F.lit(False)))
        return found.filter("n_rows > 1 OR seen_before").select("key", "n_rows", "seen_before")

    def _counted(self, rows: DataFrame, column: str) -> DataFrame:
        return rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n_rows"))

    def add(self, rows: DataFrame, column: str) -> None:
        """Take the load's keys into the state. Adding a load again changes no answer."""
        keys = self._counted(rows, column).select("key")
        places = keys.select(F.explode(self._places(F.col("key"))).alias("_place"))
        bits = places.groupBy(F.expr("bitmap_bucket_number(_place)").alias("block")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(_place))").alias("bits")
        )
        bits.write.mode("append").parquet(f"{self.folder}/filter")
        fresh = keys.withColumn("bucket", self._bucket(F.col("key"))).repartition("bucket")
        fresh.write.mode("append").partitionBy("bucket").parquet(f"{self.folder}/keys")
