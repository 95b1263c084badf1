"""Marts and report views that follow their rows: equal to the rebuild, old rows unread."""

import datetime as dt
import shutil
from pathlib import Path

from test_pipeline import ad_rows, landing_files, make_enricher, settings, write_csv

from spendecho.operators import maintained
from spendecho.plans import marts, pipeline, views
from spendecho.schemas import AD_SCHEMA


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def table_path(spark, name):
    found = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").head().data_type
    return Path(found.removeprefix("file:"))


def rebuilt(run):
    """What the marts and views are when everything is computed anew."""
    spend, facts, staged = run.table("marts", "fct_ad_spend"), run.table("marts", "fct_feedback"), run.staged()
    summary, themes = marts.fct_campaign_summary(spend), marts.fct_feedback_themes(staged["stg_feedback_enriched"])
    return {
        "fct_channel_daily": marts.fct_channel_daily(spend),
        "fct_campaign_summary": summary,
        "dim_campaigns": marts.dim_campaigns(spend),
        "fct_feedback_themes": themes,
        "fct_campaign_performance": marts.fct_campaign_performance(summary, facts),
        "theme_counts": views.theme_counts(themes, facts),
        "top_themes": views.top_themes(themes, facts, 10),
        "language_split": views.language_split(facts),
        "resolution_confidence": views.resolution_confidence(facts),
        "resolved_share": views.resolved_share(facts),
    }


def kept(run):
    page = pipeline.sentiment_page(run)
    return {n: page[n] if n in page else run.table("marts", n).drop("month") for n in (
        "fct_channel_daily", "fct_campaign_summary", "dim_campaigns", "fct_feedback_themes", "fct_campaign_performance",
        "theme_counts", "top_themes", "language_split", "resolution_confidence", "resolved_share")}


def more_ads(folder, first, last):
    """New days, and more rows on days that were loaded already."""
    for channel, prefix in pipeline_platforms():
        new = [[r[0] + dt.timedelta(days=first), *r[1:]] for r in ad_rows(channel, prefix) if r[0].day <= last]
        write_csv(folder / f"{channel if channel != 'google_ads' else 'google'}_ads.csv", AD_SCHEMA.names, new)


def pipeline_platforms():
    from test_pipeline import PLATFORMS

    return PLATFORMS.items()


def test_increments_equal_the_rebuild(spark, tmp_path):
    """A first load, appended ads and feedback with another model, and a day on which nothing comes."""
    landing_files(tmp_path / "landing", 0, 80)
    first = settings(tmp_path, 2, truncate=False, declared=[], export_dir=None)
    pipeline.run_pipeline(spark, first)
    run = pipeline.Run(spark, first)
    landing_files(tmp_path / "next", 60, 120)
    more_ads(tmp_path / "next", 20, 25)
    second = settings(tmp_path, 3, landing_dir=str(tmp_path / "next"), truncate=False, declared=[], export_dir=None,
                      model="m2", enricher=make_enricher("negative"))
    pipeline.run_pipeline(spark, second)
    for day in (3, 4):
        mine, theirs = kept(run), rebuilt(run)
        for name, df in theirs.items():
            assert rows(mine[name]) == rows(df), name
        if day == 3:
            for f in (tmp_path / "next").iterdir():
                f.write_text(f.read_text().splitlines()[0] + "\n")
            pipeline.run_pipeline(spark, settings(tmp_path, 4, landing_dir=str(tmp_path / "next"), truncate=False, declared=[], export_dir=None, model="m2"))
    assert run.table("marts", "voice_sum_log").select("as_of").distinct().count() == 2
    # Replaced Bronze starts the spend marts again.
    pipeline.run_pipeline(spark, settings(tmp_path, 5, declared=[], export_dir=None, model="m2"))
    mine, theirs = kept(run), rebuilt(run)
    for name in ("fct_channel_daily", "fct_campaign_summary", "dim_campaigns", "fct_campaign_performance"):
        assert rows(mine[name]) == rows(theirs[name]), name


def test_old_months_are_not_read(spark, tmp_path):
    """With the first load's files gone, an append still gives lifetime figures of both."""
    landing_files(tmp_path / "landing", 0, 40)
    first = settings(tmp_path, 2, truncate=False, declared=[], export_dir=None)
    pipeline.run_pipeline(spark, first)
    run = pipeline.Run(spark, first)
    before = {r.campaign_id: r for r in run.table("marts", "fct_campaign_summary").collect()}
    old = table_path(spark, run.name("marts", "fct_ad_spend"))
    kept_daily = run.table("marts", "fct_channel_daily").filter("month = '2024-01'").count()
    for part in list(old.glob("month=2024-01")):
        shutil.rmtree(part)
    (tmp_path / "next").mkdir()
    landing_files(tmp_path / "next" / "landing", 40, 41)
    more_ads(tmp_path / "next" / "landing", 90, 12)  # the months after
    run = pipeline.Run(spark, settings(tmp_path, 3, landing_dir=str(tmp_path / "next" / "landing"), truncate=False, declared=[], export_dir=None))
    run.load()
    spark.catalog.refreshTable(run.name("marts", "fct_ad_spend"))
    run.build_spend(run.staged())
    after = {r.campaign_id: r for r in run.table("marts", "fct_campaign_summary").collect()}
    new = [r for channel, prefix in pipeline_platforms() for r in ad_rows(channel, prefix) if r[0].day <= 12 and r[7]]
    for c, r in after.items():
        mine = [x for x in new if x[2] == c]
        assert r.total_days_active == before[c].total_days_active + len({x[0] for x in mine})
        assert r.total_impressions == before[c].total_impressions + sum(x[7] for x in mine)
    assert run.table("marts", "fct_channel_daily").filter("month = '2024-01'").count() == kept_daily > 0


def test_a_stop_between_facts_and_states(spark, tmp_path, monkeypatch):
    """Spend rows that a stopped run has appended are counted by the next, once."""
    landing_files(tmp_path / "landing", 0, 20)
    first = settings(tmp_path, 2, truncate=False, declared=[], export_dir=None)
    pipeline.run_pipeline(spark, first)
    (tmp_path / "next").mkdir()
    landing_files(tmp_path / "next" / "landing", 20, 21)
    more_ads(tmp_path / "next" / "landing", 30, 9)
    run = pipeline.Run(spark, settings(tmp_path, 3, landing_dir=str(tmp_path / "next" / "landing"), truncate=False, declared=[], export_dir=None))
    run.load()
    with monkeypatch.context() as patch:
        patch.setattr(maintained, "spend_states", lambda *a: 1 / 0)
        try:
            run.build_spend(run.staged())
            raise AssertionError
        except ZeroDivisionError:
            pass
    run.build_spend(run.staged())
    summary = marts.fct_campaign_summary(run.table("marts", "fct_ad_spend"))
    assert rows(run.table("marts", "fct_campaign_summary")) == rows(summary)
    total = run.table("raw", "meta_ads").filter("impressions > 0").count() * 3
    assert run.table("marts", "fct_ad_spend").count() == total


def test_days_of_several_loads_count_once(spark):
    days = [("2024-01-31", 1), ("2024-02-01", 2), ("2024-02-29", 3), ("2024-01-31", 4), (None, 5)]
    spend = spark.createDataFrame(days, "date string, n int").selectExpr(
        "cast(date as date) as date", "'meta' as channel", "'c' as campaign_id", "'n' as campaign_name", "'o' as objective",
        "cast(n as bigint) as impressions", "cast(n as bigint) as clicks", "cast(n as decimal(12,2)) as spend",
        "cast(0 as bigint) as conversions", "cast(n as decimal(12,2)) as conversion_value")
    parts = [maintained.spend_states(spend.filter(f)) for f in ("impressions < 3", "impressions >= 3")]
    (got,) = maintained.campaign_summary(parts[0].unionByName(parts[1])).collect()
    assert (got.total_days_active, got.total_impressions, str(got.total_spend), got.avg_cpa) == (3, 15, "15.00", None)
    assert rows(maintained.campaign_summary(maintained.spend_states(spend))) == rows(marts.fct_campaign_summary(spend))
