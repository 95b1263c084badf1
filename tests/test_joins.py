import collections
import re

import pytest
from pyspark.sql import functions as F

from spendecho.operators import joins


def skewed(spark, n=3000):
    """A third of the rows share one key, some keys are NULL."""
    return spark.range(n).select(
        F.concat(F.lit("r"), "id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
    )


def lookup(spark):
    return spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), "id").union(
        spark.createDataFrame([("hot", 9999)], "k string, id long")
    )


def rows(df):
    return sorted((r.row_id, r.k or "", r.id if r.id is not None else -1) for r in df.collect())


def test_hot_key_of_a_lookup_is_split(spark):
    """The adaptive planner cuts the hot partition of a plain left join; no row is lost."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = skewed(spark, 20_000).repartition(8)
        got = left.join(lookup(spark), "k", "left")
        assert got.count() == 20_000
        joined = got.collect()
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan or "skewed" in plan, plan
    assert sum(r.k == "hot" and r.id == 9999 for r in joined) == 6667


def test_fits_broadcast(spark):
    assert joins.fits_broadcast(spark.range(10), 10)
    assert not joins.fits_broadcast(spark.range(11), 10)


def test_first_per_key_limits_before_the_shuffle(spark):
    df = skewed(spark).withColumn("v", F.xxhash64("row_id"))
    got = joins.first_per_key(df, ["k"], [F.col("v").desc()])
    best = collections.defaultdict(lambda: -(2**63))
    for r in df.collect():
        best[r.k] = max(best[r.k], r.v)
    assert {r.k: r.v for r in got.collect()} == dict(best)
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    exchange = plan.index("Exchange hashpartitioning")
    assert re.search(r"WindowGroupLimit .*Partial", plan[exchange:])


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "x string")
    parent = spark.createDataFrame([("b",), ("d",)], "y string")
    got = {r.x: r.n_rows for r in joins.orphans(child, "x", parent, "y").collect()}
    assert got == {"a": 2, "c": 1}
