import csv
import datetime as dt
import itertools

import pytest

from spendecho.operators.quality import QualityError
from spendecho.plans import checks, marts, pipeline
from spendecho.schemas import AD_SCHEMA, FEEDBACK_SCHEMA, GOLD_TABLES
from spendecho.sources import cache as cache_files
from spendecho.sources.tables import exported

PLATFORMS = {"meta": "mt", "google_ads": "gg", "tiktok": "tk"}


def ad_rows(channel, prefix):
    for day, c, a in itertools.product(range(1, 41), (1, 2), (1, 2)):
        date = dt.date(2024, 1, 1) + dt.timedelta(days=day)
        yield [date, channel, f"{prefix}-c{c}", f"{channel} — {c}", "traffic", f"{prefix}-set-{c}{a}", "s & t",
               0 if day % 10 == 0 else 100 * day, day, f"{10 + day}.25", day % 3, f"{20 * day}.10", "0.5000", "USD"]


def feedback_rows(first, last):
    for i in range(first, last):
        campaign = f"{list(PLATFORMS.values())[i % 3]}-c{i % 2 + 1}" if i % 4 else ""
        text = f"I saw {campaign or 'nothing'}, \"number\" {i % 40}\nsecond line"
        yield [f"FB_{i:06d}", ["2024-03-05", "3/5/24", "soon", ""][i % 4], ["FB", "GMB", "tt", "Yotpo"][i % 4],
               ["5", "4.0", "★★☆☆☆", ""][i % 4], text, "—", campaign]


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def landing_files(folder, first=0, last=120):
    folder.mkdir()
    for channel, prefix in PLATFORMS.items():
        write_csv(folder / f"{channel if channel != 'google_ads' else 'google'}_ads.csv",
                  AD_SCHEMA.names, ad_rows(channel, prefix))
    write_csv(folder / "customer_feedback.csv", FEEDBACK_SCHEMA.names, feedback_rows(first, last))
    return str(folder)


def make_enricher(sentiment="positive"):
    def enrich(batch):
        out = []
        for r in batch:
            words = r["review_text"].split()
            named = words[2].rstrip(",")
            rid = named if "-c" in named else ""
            out.append({
                "feedback_id": r["feedback_id"], "sentiment": sentiment, "sentiment_confidence": 0.9,
                "themes": ["price", "shipping"], "language": "EN", "campaign_reference": named,
                "resolved_campaign_id": rid, "resolution_confidence": 0.8,
            })
        return out

    return enrich


def settings(tmp_path, day, **kw):
    base = dict(
        landing_dir=str(tmp_path / "landing"), cache_path=str(tmp_path / "cache"), model="m1",
        run_ts=dt.datetime(2025, 1, day), prefix=f"t{abs(hash(str(tmp_path))) % 10**8}_", truncate=True,
        enricher=make_enricher(), batch_size=25, rounds=3, buckets=4,
        export_dir=str(tmp_path / "export"),
    )
    base.update(kw)
    return pipeline.Settings(**base)


def test_runs_end_to_end_and_daily(spark, tmp_path):
    landing_files(tmp_path / "landing")
    first = settings(tmp_path, 2)
    result = pipeline.run_pipeline(spark, first)
    assert result["loaded"] == {"meta_ads": 160, "google_ads": 160, "tiktok_ads": 160, "customer_feedback": 120}
    assert result["summary"] == {"feedback_rows": 120, "cache_hits": 0, "to_enrich": 120,
                                 "resolved_rows": 90, "fallback_rows": 0}
    assert set(result["exported"]) == set(GOLD_TABLES)
    assert result["exported"]["fct_ad_spend"] == 3 * 144
    assert result["exported"]["fct_feedback"] == 120
    assert result["exported"]["fct_feedback_themes"] == 240
    assert result["exported"]["dim_campaigns"] == 6

    run = pipeline.Run(spark, first)
    facts = run.table("marts", "fct_feedback")
    spend = spark.read.parquet(exported(spark, f"{tmp_path}/export")["fct_ad_spend"])
    assert dict(spend.dtypes)["spend"] == "double" and "month" not in spend.columns
    best = run.table("marts", "fct_campaign_performance").collect()
    assert len(best) == 6 and all(r.feedback_count == r.positive_count > 0 for r in best)
    assert set(pipeline.sentiment_page(run)) >= {"sentiment_mix", "resolved_share"}

    # Bucketed by feedback_id: current rows and the fact join need no shuffle.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = run.staged()
        joined = marts.fct_feedback(staged["stg_feedback_enriched"], staged["stg_customer_feedback"])
        for df in (run.table("marts", "fct_feedback"), joined, run.history()):
            plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
            assert "Exchange" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

    # The same inputs again, a day later: nothing new anywhere.
    pipeline.run_pipeline(spark, settings(tmp_path, 3))
    assert run.table("marts", "fct_feedback_log").count() == 120
    assert run.table("snapshots", "feedback_enrichment_log").count() == 120
    assert run.table("raw", "feedback_enriched_log").count() == 120
    snapshot = run.table("snapshots", "feedback_enrichment_snapshot")
    assert sorted(map(str, snapshot.select(*run.history().columns).collect())) == sorted(map(str, run.history().collect()))
    assert {str(r._enriched_at)[:10] for r in facts.collect()} == {"2025-01-02"}

    # New feedback and another model: every row is reclassified.
    (tmp_path / "day4").mkdir()
    landing_files(tmp_path / "day4" / "landing", 0, 150)
    third = settings(tmp_path, 4, landing_dir=str(tmp_path / "day4" / "landing"), model="m2",
                     enricher=make_enricher("negative"))
    result = pipeline.run_pipeline(spark, third)
    assert result["exported"]["fct_feedback"] == 150
    facts = run.table("marts", "fct_feedback")
    assert {(r.sentiment, r.model_version) for r in facts.collect()} == {("negative", "m2")}
    assert run.table("marts", "fct_feedback_log").count() == 270
    versions = run.history()
    assert versions.count() == 270 and versions.filter("is_current").count() == 150

    # Offline replay of the first model from the cache.
    offline = settings(tmp_path, 5, landing_dir=third.landing_dir, enricher=None)
    result = pipeline.run_pipeline(spark, offline)
    assert result["summary"]["to_enrich"] < 150 and result["summary"]["fallback_rows"] == 0


def test_first_rows_without_keeping_the_cache(spark, tmp_path):
    landing_files(tmp_path / "landing")
    s = settings(tmp_path, 2, limit=6, keep_cache=False, declared=[], export_dir=None)
    result = pipeline.run_pipeline(spark, s)
    assert result["summary"]["feedback_rows"] == result["summary"]["to_enrich"] == 6
    assert result["summary"]["fallback_rows"] == 0
    run = pipeline.Run(spark, s)
    assert run.table("marts", "fct_feedback").count() == 6
    assert not (tmp_path / "cache").exists()


def test_failed_check_blocks_the_export(spark, tmp_path):
    landing_files(tmp_path / "landing")
    (tmp_path / "landing" / "tiktok_ads.csv").unlink()
    rows = [[*r[:9], "20000.00", *r[10:]] for r in ad_rows("tiktok", "tk")]
    write_csv(tmp_path / "landing" / "tiktok_ads.csv", AD_SCHEMA.names, rows)
    with pytest.raises(QualityError, match="marts.fct_ad_spend.spend between: 144"):
        pipeline.run_pipeline(spark, settings(tmp_path, 2))
    assert not (tmp_path / "export").exists()


def test_a_stopped_run_is_resumed(spark, tmp_path):
    """What was answered before the stop is not sent again, cached or only in the ledger."""
    landing_files(tmp_path / "landing")
    calls = tmp_path / "calls"
    calls.mkdir()
    honest, folder = make_enricher(), str(calls)

    def enrich(batch, stop):
        import uuid

        if stop and any(r["feedback_id"] == "FB_000119" for r in batch):
            raise RuntimeError("no answer")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(r["feedback_id"] for r in batch))
        return honest(batch)

    one_round = settings(tmp_path, 2, enricher=lambda batch: enrich(batch, True), batch_size=5, rounds=2, export_dir=None)
    with pytest.raises(Exception, match="no answer"):
        pipeline.run_pipeline(spark, one_round)
    kept = cache_files.read_cache(spark, one_round.cache_path).count()
    left = [f for f in (tmp_path / "cache/_answers").rglob("*.json") if f.name[0] not in "._"]
    assert left
    result = pipeline.run_pipeline(spark, settings(
        tmp_path, 3, enricher=lambda batch: enrich(batch, False), batch_size=5, rounds=2, export_dir=None))
    assert result["summary"]["cache_hits"] >= kept and result["summary"]["fallback_rows"] == 0
    texts = [x for f in calls.iterdir() for x in f.read_text().split("\n")]
    assert len(set(texts)) == 100 and len(texts) - len(set(texts)) <= 10  # a batch may end with its task
    assert not [f for f in (tmp_path / "cache/_answers").rglob("*.json")]


def test_a_second_day_costs_its_increment(spark, tmp_path):
    """Appended feedback: only new texts are hashed, sent and written."""
    landing_files(tmp_path / "landing", 0, 80)
    first = settings(tmp_path, 2, truncate=False, declared=[], export_dir=None)
    pipeline.run_pipeline(spark, first)
    run = pipeline.Run(spark, first)
    landing_files(tmp_path / "next", 80, 120)
    for f in ("meta_ads.csv", "google_ads.csv", "tiktok_ads.csv"):
        write_csv(tmp_path / "next" / f, AD_SCHEMA.names, [])
    result = pipeline.run_pipeline(spark, settings(
        tmp_path, 3, landing_dir=str(tmp_path / "next"), truncate=False, declared=[], export_dir=None))
    assert result["summary"]["feedback_rows"] == 120
    log = run.table("raw", "feedback_enriched_log").groupBy("_enriched_at").count().collect()
    assert {str(r._enriched_at)[:10]: r["count"] for r in log} == {"2025-01-02": 80, "2025-01-03": 40}
    assert run.table("raw", "feedback_key_log").count() == 120
    assert run.table("marts", "fct_feedback_log").count() == 120
    with pytest.raises(ValueError, match="later than the last"):
        run.enrich()


def test_each_text_is_sent_once(spark, tmp_path):
    """Answers are written before they are checked, whatever the size of the catalog."""
    landing_files(tmp_path / "landing")
    calls = tmp_path / "calls"
    calls.mkdir()
    honest, folder = make_enricher(), str(calls)

    def counted(batch):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(r["review_text"] for r in batch))
        return honest(batch)

    pipeline.run_pipeline(spark, settings(tmp_path, 2, enricher=counted, rounds=None, export_dir=None))
    texts = [t for f in calls.iterdir() for t in f.read_text().split("second line") if t.strip()]
    assert len(texts) == len(set(texts)) == 100


def test_buckets_follow_the_bytes():
    assert [pipeline.buckets_for(n) for n in (0, 1, pipeline.BUCKET_BYTES + 1, 10**12)] == [1, 1, 2, 3726]


def test_no_scratch_is_left(spark, tmp_path):
    from spendecho import session

    landing_files(tmp_path / "landing")
    mark = session.scratch_mark()
    pipeline.run_pipeline(spark, settings(tmp_path, 2, export_dir=None))
    assert session.scratch_mark() == mark


def test_precision_gate_blocks(spark, tmp_path):
    landing_files(tmp_path / "landing")

    honest = make_enricher()  # a closure travels to the workers, a test module does not

    def wrong(batch):
        return [{**a, "resolved_campaign_id": "mt-c1"} for a in honest(batch)]

    with pytest.raises(QualityError, match="resolution precision"):
        pipeline.run_pipeline(spark, settings(tmp_path, 2, enricher=wrong))


def test_declared_checks():
    kinds = [c.kind for c in checks.DECLARED]
    assert len(kinds) == 76
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 44, "unique": 14, "between": 7, "accepted_values": 6, "relationship": 4, "length_between": 1,
    }
