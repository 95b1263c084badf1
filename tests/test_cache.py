"""The cache's generations and layers, and the ledger of answers."""

import pytest
from pyspark.sql import functions as F

from spendecho.operators import enrichment as enr
from spendecho.schemas import CACHE_SCHEMA
from spendecho.sources import cache as cache_files
from spendecho.sources import files
from spendecho.sources import ledger as ledger_files

from test_enrichment import feedback_of, record


def records_of(spark, *records):
    return spark.createDataFrame(list(records), CACHE_SCHEMA)


def content(spark, path):
    return {(r.content_hash, r.model_version): r.sentiment for r in cache_files.read_cache(spark, path).collect()}


def many(spark, n, sentiment="positive"):
    return records_of(spark, *[record(f"h{i:05d}", f"m{i % 3}", sentiment) for i in range(n)])


def test_folding_keeps_every_record(spark, tmp_path):
    path = str(tmp_path / "cache")
    cache_files.append_cache(many(spark, 300), path)
    cache_files.append_cache(records_of(spark, record("h00001", "m1", "mixed"), record("x", "m1")), path)
    before = content(spark, path)
    first = cache_files.fold(spark, path, buckets=4)
    assert content(spark, path) == before and len(before) == 301 and before["h00001", "m1"] == "mixed"
    assert (first.number, cache_files.delta_files(spark, path, first)) == (1, {})
    cache_files.append_cache(records_of(spark, record("h00002", "m2", "negative"), record("y", "m9")), path)
    changed = {**before, ("h00002", "m2"): "negative", ("y", "m9"): "positive"}
    assert content(spark, path) == changed
    assert cache_files.fold(spark, path, buckets=3).number == 2 and content(spark, path) == changed
    cache_files.fold(spark, path)
    assert content(spark, path) == changed
    assert len(files.names(spark, f"{path}/_base")) == 2  # the last base and the one before it


@pytest.mark.parametrize("step", ["write", "publish", "clean"])
def test_a_failed_fold_loses_nothing(spark, tmp_path, monkeypatch, step):
    """Wherever a fold ends, the whole cache reads back, and the next fold succeeds."""
    path = str(tmp_path / "cache")
    cache_files.append_cache(many(spark, 200), path)
    cache_files.fold(spark, path)
    cache_files.append_cache(many(spark, 90, "negative"), path)
    expected = content(spark, path)
    assert sorted(expected.values()) == ["negative"] * 90 + ["positive"] * 110

    def fail(*args, **kw):
        raise RuntimeError("disk full")

    with monkeypatch.context() as patch:
        if step == "write":  # the job that writes the base fails in its tasks
            merged = cache_files._merged
            broken = F.when(F.col("content_hash") == "h00150", F.raise_error(F.lit("disk full"))).otherwise(F.col("sentiment"))
            patch.setattr(cache_files, "_merged", lambda *a: merged(*a).withColumn("sentiment", broken))
        elif step == "publish":
            patch.setattr(files, "publish", fail)
        else:
            patch.setattr(files, "remove", fail)
        with pytest.raises(Exception, match="disk full"):
            cache_files.fold(spark, path)
    assert content(spark, path) == expected
    found = enr.looked_up(spark.createDataFrame([(h,) for h, _ in expected], "content_hash string").distinct(), cache_files.open_cache(spark, path), "m1")
    assert {(r.content_hash, r.sentiment) for r in found.collect()} == {(h, s) for (h, _), s in expected.items()}
    cache_files.fold(spark, path)
    assert content(spark, path) == expected and cache_files.delta_files(spark, path, cache_files.generation(spark, path)) == {}


def test_two_folds_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cache")
    cache_files.append_cache(many(spark, 30), path)
    publish = files.publish

    def late(session, place, text):
        assert publish(session, place, text)  # the other driver
        return publish(session, place, text)

    monkeypatch.setattr(files, "publish", late)
    with pytest.raises(RuntimeError, match="another driver"):
        cache_files.fold(spark, path)
    assert len(cache_files.delta_files(spark, path, None)) > 0


def test_base_is_looked_up_without_a_shuffle(spark, tmp_path):
    """Only texts are dealt into buckets, and JSON is read of the deltas alone."""
    path = str(tmp_path / "cache")
    cache_files.append_cache(many(spark, 500), path)
    cache_files.fold(spark, path, buckets=4)
    cache_files.append_cache(records_of(spark, record("h00003", "m0", "negative"), record("h00004", "m7", "mixed"), record("new", "m1")), path)
    texts = spark.createDataFrame([(f"h{i:05d}",) for i in range(0, 600, 3)] + [("h00004",), ("new",)], "content_hash string")
    cache = cache_files.open_cache(spark, path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = enr.looked_up(texts, cache, "m0")
        plan = got._jdf.queryExecution().executedPlan().toString()
        base = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple").split("Bucketed: true")
        missing = enr.texts_to_enrich(texts.withColumn("feedback_id", F.lit("f")), cache, "m0")
        lost = {r.content_hash for r in missing.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(base) == 2 and "json" not in plan.lower().split("bucketed: true")[0].rsplit("filescan", 1)[-1]
    lines = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple").splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[:scan]):  # the operators over the base's scan, up to the join
        if depth(line) < at:
            above, at = [*above, line], depth(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above), "\n".join(lines)
    rows = {r.content_hash: (r.model_version, r.sentiment) for r in got.collect() if r._hit}
    assert rows["h00003"] == ("m0", "negative") and rows["h00004"] == ("m7", "mixed") and rows["new"] == ("m1", "positive")
    assert rows["h00006"] == ("m0", "positive") and "h00597" not in rows
    assert lost == {f"h{i:05d}" for i in range(501, 600, 3)} | {"h00004", "new"}


@pytest.mark.parametrize("layered", [False, True])
def test_layers_give_what_the_merged_cache_gives(spark, tmp_path, layered):
    """The same rows and counts from base and deltas as from one table, late sequences included."""
    path = str(tmp_path / "cache")
    cache_files.append_cache(many(spark, 60), path, 10)
    if layered:
        cache_files.fold(spark, path, buckets=2)
    cache_files.append_cache(many(spark, 20, "negative"), path, 12)
    cache_files.append_cache(many(spark, 30, "mixed"), path, 9)  # written late, an older sequence
    keys = spark.createDataFrame([(f"f{i}", f"h{i % 70:05d}") for i in range(200)], "feedback_id string, content_hash string")
    at = F.lit("2025-01-02 00:00:00").cast("timestamp_ntz")
    one, parts = cache_files.read_cache(spark, path), cache_files.open_cache(spark, path)
    for model in ("m0", "m2", "m9"):
        rows = [sorted(map(str, enr.assemble(keys, c, model, at).collect())) for c in (one, parts)]
        assert rows[0] == rows[1] and len(rows[0]) == 200
        assert enr.run_summary(keys, one, model).head() == enr.run_summary(keys, parts, model).head()
    assert sorted(content(spark, path).values()).count("negative") == 20


def test_fold_due(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert not cache_files.fold_due(spark, path)
    cache_files.append_cache(many(spark, 500), path)
    assert not cache_files.fold_due(spark, path) and cache_files.fold_due(spark, path, most_files=0)
    cache_files.fold(spark, path)
    cache_files.append_cache(many(spark, 1), path)
    assert not cache_files.fold_due(spark, path)
    cache_files.append_cache(many(spark, 500), path)
    assert cache_files.fold_due(spark, path)
    (tmp_path / "one.jsonl").write_text('{"content_hash":"h","model_version":"m"}\n')
    assert not cache_files.fold_due(spark, str(tmp_path / "one.jsonl"), most_files=0)
    with pytest.raises(ValueError, match="one file"):
        cache_files.fold(spark, str(tmp_path / "one.jsonl"))


def counting(folder, fail_at=None):
    """An enricher that notes each batch it is sent, and fails at one row."""
    def enrich(batch):
        import uuid

        if fail_at and any(r["feedback_id"] == fail_at for r in batch):
            raise RuntimeError("no answer")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(r["feedback_id"] for r in batch))
        return [{"feedback_id": r["feedback_id"], "sentiment": "positive", "themes": ["price"], "language": None} for r in batch[1:]]

    return enrich


def sent(folder):
    return sorted(x for f in folder.iterdir() for x in f.read_text().split("\n"))


def test_a_failed_task_sends_only_the_rest(spark, tmp_path):
    """One task of ten batches fails at the sixth: its second run sends five."""
    calls = tmp_path / "calls"
    calls.mkdir()
    ledger = ledger_files.Ledger(ledger_files.uri(spark, str(tmp_path / "cache/_answers/m")))
    assert ledger_files.usable(ledger)
    feedback = feedback_of(spark, 100)
    todo = enr.texts_to_enrich(enr.feedback_keys(feedback), records_of(spark), "m")
    texts = enr.enricher_input(feedback, todo)
    with pytest.raises(Exception, match="no answer"):
        enr.run_enricher(texts, counting(str(calls), "FB_00055"), 10, 1, ledger).collect()
    assert sent(calls) == [f"FB_{i:05d}" for i in range(50)]
    got = enr.run_enricher(texts, counting(str(calls)), 10, 1, ledger)
    first = sorted(map(str, got.collect()))
    assert sent(calls) == [f"FB_{i:05d}" for i in range(100)] and len(first) == 90
    assert sorted(map(str, got.collect())) == first and len(sent(calls)) == 100  # read again: nothing is sent
    left = ledger_files.left_over(spark, str(tmp_path / "cache/_answers/m"))
    assert sorted(map(str, left.select(*got.columns).collect())) == first
    assert not list((tmp_path / "cache").rglob("_*.json-*"))


def test_batches_without_answers_are_noted(tmp_path):
    ledger = ledger_files.Ledger(f"file://{tmp_path}/answers")
    key = ledger_files.batch_key([["f1", "h1"]])
    assert ledger.get(key) is None
    ledger.put(key, [])
    assert ledger.get(key) == []
    ledger.put(key, [{"feedback_id": "f1", "themes": ["a", "\n"]}])
    assert ledger.get(key) == [{"feedback_id": "f1", "themes": ["a", "\n"]}]
    assert not ledger_files.usable(ledger_files.Ledger("nowhere://x/y"))
