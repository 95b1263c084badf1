import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from spendecho.operators import history, incremental
from spendecho.sources.sample_tables import ntz
from spendecho.streaming import increments

SCHEMA = "feedback_id string, v int, _enriched_at timestamp_ntz"


def day(n):
    return dt.datetime(2025, 1, n)


def frame(spark, *rows):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in rows], SCHEMA)


def as_dict(df):
    return {r.feedback_id: r.v for r in df.collect()}


def test_increment_replaces_skips_ties_and_late_rows(spark):
    target = frame(spark, ("a", 1, 1), ("b", 1, 5))
    source = frame(spark, ("a", 2, 6), ("c", 2, 7), ("tie", 2, 5), ("late", 2, 3), ("b", 9, 5))
    got = incremental.merge_increment(target, source, "feedback_id", "_enriched_at")
    assert as_dict(got) == {"a": 2, "b": 1, "c": 2} and got.count() == 3


def test_first_run_takes_everything_and_rerun_nothing(spark):
    source = frame(spark, ("a", 1, 1), ("b", 1, 5))
    first = incremental.merge_increment(frame(spark).limit(0), source, "feedback_id", "_enriched_at")
    assert as_dict(first) == {"a": 1, "b": 1}
    assert incremental.newer_rows(source, first, "_enriched_at").count() == 0


def test_lookback(spark):
    target = frame(spark, ("b", 1, 5))
    source = frame(spark, ("late", 2, 4), ("older", 2, 1))
    got = incremental.newer_rows(source, target, "_enriched_at", F.expr("interval 2 days"))
    assert set(as_dict(got)) == {"late"}


def test_log_reads_like_the_upsert(spark):
    target = frame(spark, ("a", 1, 1), ("b", 1, 5))
    source = frame(spark, ("a", 2, 6), ("c", 2, 7), ("tie", 2, 5))
    log = target.union(incremental.newer_rows(source, target, "_enriched_at"))
    got = incremental.current_rows(log, "feedback_id", "_enriched_at")
    assert as_dict(got) == as_dict(incremental.merge_increment(target, source, "feedback_id", "_enriched_at"))


def test_stream_appends_only_newer_rows(spark, tmp_path):
    label = uuid.uuid4().hex  # the shared folder outlives a test run
    folder, table = str(tmp_path / "in"), f"stream_log_{label}"
    schema = frame(spark).schema

    def deliver(*rows):
        frame(spark, *rows).coalesce(1).write.mode("append").parquet(folder)
        stream = increments.enriched_stream(spark, folder, schema)
        q = increments.drain(stream, table, "_enriched_at", label=label, bucket=(4, "feedback_id"))
        q.awaitTermination()

    deliver(("a", 1, 1), ("b", 1, 5))
    deliver(("a", 2, 6), ("tie", 2, 5), ("late", 2, 2))
    deliver(("c", 3, 7))
    got = incremental.current_rows(spark.table(table), "feedback_id", "_enriched_at")
    assert as_dict(got) == {"a": 2, "b": 1, "c": 3}
    assert spark.table(table).count() == 4


CHECKS = ["sentiment", "resolved_campaign_id", "themes", "model_version"]


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "feedback_id string, " + ", ".join(f"{c} string" for c in CHECKS))


T = ["2025-01-01 00:00:00", "2025-01-02 00:00:00", "2025-01-03 00:00:00"]


@pytest.fixture
def two_runs(spark):
    first = source(
        spark, ("same", "positive", "M1", "[]", "m1"), ("flip", "positive", "M1", "[]", "m1"),
        ("set", "neutral", None, "[]", "m1"), ("unset", "neutral", "M1", "[]", "m1"),
        ("model", "neutral", None, "[]", "m1"), ("gone", "neutral", None, "[]", "m1"),
    )
    second = source(
        spark, ("same", "positive", "M1", "[]", "m1"), ("flip", "negative", "M1", "[]", "m1"),
        ("set", "neutral", "M2", "[]", "m1"), ("unset", "neutral", None, "[]", "m1"),
        ("model", "neutral", None, "[]", "m2"), ("new", "mixed", None, "[]", "m1"),
    )
    log = history.first_versions(first, "feedback_id", CHECKS, ntz(T[0]))
    return log, second, history.apply_run(log, second, ntz(T[1]))


def test_history_versions(two_runs):
    rows = history.with_validity(two_runs[2]).collect()
    by_key = {}
    for r in sorted(rows, key=lambda r: r.valid_from):
        by_key.setdefault(r.feedback_id, []).append(r)
    assert {k: len(v) for k, v in by_key.items()} == {
        "same": 1, "flip": 2, "set": 2, "unset": 2, "model": 2, "gone": 1, "new": 1,
    }
    old, new = by_key["flip"]
    assert old.valid_to == new.valid_from and not old.is_current and new.is_current
    assert new.valid_to is None and by_key["gone"][0].is_current
    assert sum(r.is_current for r in rows) == 7
    assert len({r.version_key for r in rows}) == len(rows)


def test_history_rerun_adds_nothing(two_runs):
    _, second, log = two_runs
    assert history.changed_versions(log, second, ntz(T[2])).count() == 0


def test_as_of(two_runs):
    versions = history.with_validity(two_runs[2])
    before = {r.feedback_id: r.sentiment for r in history.as_of(versions, ntz("2025-01-01 12:00:00")).collect()}
    at = {r.feedback_id: r.sentiment for r in history.as_of(versions, ntz(T[1])).collect()}
    assert before["flip"] == "positive" and "new" not in before
    assert at["flip"] == "negative" and at["gone"] == "neutral" and len(at) == 7


def test_reclassified(two_runs):
    got = {r.feedback_id: r for r in history.reclassified(two_runs[2]).collect()}
    assert set(got) == {"flip", "set", "unset", "model"}
    assert (got["flip"].old_sentiment, got["flip"].new_sentiment) == ("positive", "negative")
    assert got["set"].old_resolved_campaign_id is None and got["set"].new_resolved_campaign_id == "M2"
