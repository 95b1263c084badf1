"""Feedback laid out for slices: equal to the facts, most of it unread; logs replaced safely."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_maintained import rows, table_path
from test_pipeline import landing_files, make_enricher, settings

from spendecho.operators import slices, staging
from spendecho.plans import marts, pipeline, views
from spendecho.sources import tables

SLICERS = [
    dict(date_from=dt.date(2024, 3, 1), date_to=dt.date(2024, 3, 31)),
    dict(channels=["meta", "tiktok"]),
    dict(date_to=dt.date(2024, 3, 5), channels=["google_reviews"]),
    dict(campaigns=["mt-c1", "gg-c2"]),
    dict(date_from=dt.date(2030, 1, 1)),
]


def from_facts(run, **slicers):
    facts = views.slice_feedback(run.table("marts", "fct_feedback"), **slicers)
    themes = run.table("marts", "fct_feedback_themes")
    return {
        "theme_counts": views.theme_counts(themes, facts), "top_themes": views.top_themes(themes, facts, 10),
        "language_split": views.language_split(facts), "resolution_confidence": views.resolution_confidence(facts),
        "resolved_share": views.resolved_share(facts),
    }


def assert_slices_follow(run, n=1):
    for slicers in SLICERS[:n]:
        page = pipeline.sentiment_page(run, **slicers)
        for name, df in from_facts(run, **slicers).items():
            assert rows(page[name]) == rows(df), (name, slicers)


def test_slices_follow_the_facts(spark, tmp_path):
    """A first load; a second with another model, which replaces rows; months folded; a
    day without news; the log dropped and laid out anew."""
    landing_files(tmp_path / "landing", 0, 80)
    kept = dict(truncate=False, declared=[], export_dir=None)
    pipeline.run_pipeline(spark, settings(tmp_path, 2, **kept))
    run = pipeline.Run(spark, settings(tmp_path, 2, **kept))
    log = run.name("marts", pipeline.SLICE_LOG)
    assert run.table("marts", pipeline.SLICE_LOG).filter("sign < 0").isEmpty()
    assert_slices_follow(run)
    landing_files(tmp_path / "next", 60, 120)
    second = settings(tmp_path, 3, landing_dir=str(tmp_path / "next"), model="m2", enricher=make_enricher("negative"), **kept)
    pipeline.run_pipeline(spark, second)
    assert run.table("marts", pipeline.SLICE_LOG).filter("sign < 0").count() > 0
    assert_slices_follow(run, len(SLICERS))
    assert run.compact_slices(most_files=0) == ["2024-03", slices.UNDATED] and run.compact_slices(most_files=100) == []
    spark.catalog.refreshTable(log)
    assert run.table("marts", pipeline.SLICE_LOG).count() == run.table("marts", "fct_feedback").count() == 120
    assert_slices_follow(run)
    run.build_feedback(run.staged())
    assert run.table("marts", pipeline.SLICE_LOG).count() == 120
    facts = rows(run.table("marts", "fct_feedback"))
    for layer, name in pipeline.COMPACTED:
        run.compact_log(layer, name, "_loaded_at" if name == pipeline.KEY_LOG else "_enriched_at")
    assert rows(run.table("marts", "fct_feedback")) == facts and run.table("marts", pipeline.FACT_LOG).count() == 120
    spark.sql(f"DROP TABLE {log}")
    run.build_feedback(run.staged())
    assert_slices_follow(run)


def test_signs_cancel_over_missed_runs(spark):
    """Versions of several runs that the log has missed: only the live one at the mark goes."""
    at = [dt.datetime(2025, 1, d) for d in (1, 2, 3)]
    labels = dict(sentiment_confidence=0.5, product_mentions="[]", competitor_mentions="[]", campaign_reference="",
                  resolution_confidence=0.5, content_hash="h", model_version="m")
    found = [(i, s, t) for i, s, t in [("a", "positive", at[0]), ("b", "neutral", at[0]), ("a", "neutral", at[1]), ("a", "negative", at[2]), ("c", "positive", at[2])]]
    enriched = spark.createDataFrame(
        [(i, s, '["x"]', "en", None, t) for i, s, t in found],
        "feedback_id string, sentiment string, themes string, language string, resolved_campaign_id string, _enriched_at timestamp_ntz",
    ).withColumns({k: F.lit(v) for k, v in labels.items()})
    feedback = spark.createDataFrame(
        [("a", dt.date(2024, 1, 5), "meta"), ("b", None, None)],
        "feedback_id string, posted_date date, source_channel string",
    ).withColumns({"rating_value": F.lit(None).cast("double"), "_loaded_at": F.lit(at[0]).cast("timestamp_ntz")})
    facts = marts.fct_feedback(staging.stage_enriched(enriched), feedback)
    since = F.lit(at[0]).cast("timestamp_ntz")
    first = slices.signed_rows(facts.filter(F.col("_enriched_at") <= since), enriched)
    assert sorted((r.feedback_id, r.month, r.sign) for r in first.collect()) == [("a", "2024-01", 1), ("b", "undated", 1)]
    later = slices.signed_rows(facts, enriched, since)
    assert sorted((r.feedback_id, r.sentiment, r.sign) for r in later.collect()) == [
        ("a", "negative", 1), ("a", "positive", -1), ("c", "positive", 1)]
    live = slices.netted(first.unionByName(later))
    assert sorted((r.feedback_id, r.sentiment) for r in live.collect()) == [("a", "negative"), ("b", "neutral"), ("c", "positive")]


def scanned(df):
    """Rows that leave the scan before any filter."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        below = node.children()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        todo += [below.apply(i) for i in range(below.size())]
    return found


def test_a_slice_leaves_row_groups_unread(spark, tmp_path):
    n, name = 60_000, f"slices_{abs(hash(str(tmp_path))) % 10**8}"
    rows_ = spark.range(n).select(
        F.concat(F.lit("FB_"), "id").alias("feedback_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 7919 % 60).cast("int")).alias("posted_date"),
        F.element_at(F.array(*map(F.lit, ("google", "meta", "tiktok"))), (F.col("id") % 3 + 1).cast("int")).alias("source_channel"),
        F.lit(1).cast("long").alias("sign"),
    ).withColumn("month", slices.month_of(F.col("posted_date")))
    spark.conf.set("parquet.block.size", "4096")
    try:
        tables.append_clustered(rows_, name, "month", slices.CLUSTER)
    finally:
        spark.conf.unset("parquet.block.size")
    day = spark.table(name).filter("month = '2024-01' and posted_date = date '2024-01-09' and source_channel = 'meta'")
    whole = spark.table(name).select("feedback_id")
    assert scanned(whole) == n
    assert day.count() == sum(1 for i in range(n) if i * 7919 % 60 == 8 and i % 3 == 1) > 0
    assert scanned(day.select("feedback_id")) < n / 40
    week = spark.table(name).filter("posted_date between date '2024-01-29' and date '2024-02-04'")
    assert week.count() == n * 7 // 60 and scanned(week.select("feedback_id")) < n / 4
    spark.sql(f"DROP TABLE {name}")


def test_a_log_is_replaced_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    table = f"swapped_{abs(hash(str(tmp_path))) % 10**8}"
    tables.append_table(spark.range(100).withColumn("v", F.lit(1)), table, (2, "id"))
    kept = lambda: spark.table(table).filter("id < 10")

    def fail(*args, **kw):
        raise OSError("disk")

    with pytest.raises(OSError), monkeypatch.context() as m:
        m.setattr(tables, "save", fail)
        tables.swap_table(kept(), table, (2, "id"))
    assert spark.table(table).count() == 100
    with pytest.raises(Exception, match="id"):  # fails in a task, halfway
        broken = kept().withColumn("v", F.when(F.col("id") < 5, 1).otherwise(F.raise_error(F.concat(F.lit("id "), "id")).cast("int")))
        tables.swap_table(broken, table, (2, "id"))
    assert spark.table(table).count() == 100
    # Stopped when the new table was whole: the next call ends it first.
    tables.save(kept(), table + tables.SWAPPED, "overwrite", bucket=(2, "id"))
    spark.sql(f"DROP TABLE {table}")
    tables.finish_swap(spark, table)
    assert spark.table(table).count() == 10
    tables.swap_table(spark.table(table).filter("id < 3"), table, (2, "id"))
    assert sorted(r.id for r in spark.table(table).collect()) == [0, 1, 2]
    assert "2" == spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").head().data_type
    assert table_path(spark, table).exists()
    spark.sql(f"DROP TABLE {table}")
