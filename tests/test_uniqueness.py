"""Uniqueness across loads, and history from a log of versions."""

import shutil

import pytest
from pyspark.sql import functions as F

from spendecho.operators import history, uniqueness
from spendecho.schemas import SNAPSHOT_CHECKS


def keys(spark, first, last, prefix="k"):
    return spark.range(first, last).select(F.concat(F.lit(prefix), "id").alias("k"))


def found(state, rows):
    return {r.key: (r.n_rows, r.seen_before) for r in state.check(rows, "k").collect()}


def test_duplicates_in_and_across_loads(spark, tmp_path):
    state = uniqueness.KeyState(spark, str(tmp_path / "s"), 5000)
    first = keys(spark, 0, 3000).union(keys(spark, 5, 7)).union(spark.createDataFrame([(None,), (None,)], "k string"))
    assert found(state, first) == {"k5": (2, False), "k6": (2, False)}
    state.add(first, "k")
    second = keys(spark, 2990, 4000).union(keys(spark, 2999, 3001)).union(spark.createDataFrame([(None,)], "k string"))
    assert found(state, second) == {**{f"k{i}": (1, True) for i in range(2990, 2999)}, "k2999": (2, True), "k3000": (2, False)}
    state.add(second, "k")
    state.add(second, "k")  # again: the same answers
    assert found(state, keys(spark, 3999, 4001)) == {"k3999": (1, True)}
    assert len(found(state, keys(spark, 0, 4000))) == 4000


def test_new_keys_read_no_key(spark, tmp_path):
    """With the kept keys gone, a load of new keys is still judged: the filter is enough."""
    state = uniqueness.KeyState(spark, str(tmp_path / "s"), 100_000)
    state.add(keys(spark, 0, 5000), "k")
    shutil.rmtree(tmp_path / "s/keys")
    (tmp_path / "s/keys").mkdir()
    (tmp_path / "s/keys/bucket=0").mkdir()
    (tmp_path / "s/keys/bucket=0/broken.parquet").write_text("not a table")
    assert found(state, keys(spark, 0, 5000, "new")) == {}
    with pytest.raises(Exception, match="broken.parquet"):
        found(state, keys(spark, 0, 5000))


def test_a_small_filter_is_only_less_sharp(spark, tmp_path):
    state = uniqueness.KeyState(spark, str(tmp_path / "s"), 10)
    state.add(keys(spark, 0, 2000), "k")
    assert set(found(state, keys(spark, 1990, 4000))) == {f"k{i}" for i in range(1990, 2000)}


def test_a_stop_between_filter_and_keys(spark, tmp_path, monkeypatch):
    state = uniqueness.KeyState(spark, str(tmp_path / "s"), 1000)
    state.add(keys(spark, 0, 10), "k")
    with monkeypatch.context() as patch:
        patch.setattr(state, "_bucket", lambda key: F.raise_error(F.lit("lost")).cast("int"))
        with pytest.raises(Exception, match="lost"):
            state.add(keys(spark, 10, 20), "k")
    assert found(state, keys(spark, 5, 15)) == {f"k{i}": (1, True) for i in range(5, 10)}
    state.add(keys(spark, 10, 20), "k")
    assert len(found(state, keys(spark, 5, 15))) == 10


def test_no_state_yet(spark, tmp_path):
    state = uniqueness.KeyState(spark, str(tmp_path / "s"), 0)
    assert found(state, keys(spark, 0, 3)) == {}
    assert found(state, keys(spark, 0, 3).limit(0)) == {}


def test_history_by_log_of_several_versions(spark):
    """Versions since the last run: back and forth is no change, a new key is one."""
    checks = ", ".join(f"{c} string" for c in SNAPSHOT_CHECKS)
    before = "_replaced struct<" + ", ".join(f"{c}: string" for c in SNAPSHOT_CHECKS) + ">"
    a, b, c = ("p", "c1", "t", "m1"), ("n", None, "t", "m1"), ("n", "c2", "t", "m2")
    rows = [("same", *b, 1, a), ("same", *a, 2, b), ("moved", *b, 1, a), ("moved", *c, 2, b), ("new", *a, 1, None), ("null", *b, 1, b),
            ("to null", *b, 1, ("n", "c1", "t", "m1"))]
    versions = spark.createDataFrame(rows, f"feedback_id string, {checks}, _enriched_at int, {before}")
    at = F.lit("2025-01-03 00:00:00").cast("timestamp_ntz")
    got = {r.feedback_id: tuple(r)[1:5] for r in history.changed_by_log(versions, at).collect()}
    assert got == {"moved": c, "new": a, "to null": b}
