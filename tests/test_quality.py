import pytest
from pyspark.sql import functions as F

from spendecho.operators import quality
from spendecho.operators.quality import Check
from spendecho.plans import marts


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", "positive", 0.5, "en"), ("a", "angry", 1.5, "e"), ("b", None, None, None),
         (None, "neutral", -0.1, "x" * 13), (None, "mixed", 1.0, "es")],
        "id string, sentiment string, conf double, language string",
    )


CASES = [
    (Check("t", "id", "not_null"), 2),
    (Check("t", "id", "unique"), 1),
    (Check("t", "sentiment", "accepted_values", values=("positive", "neutral", "mixed", "it's")), 1),
    (Check("t", "conf", "between", low=0, high=1), 2),
    (Check("t", "conf", "between", low=0, high=1, where="language <> 'e'"), 1),
    (Check("t", "language", "length_between", low=2, high=12), 2),
    (Check("t", "id", "relationship", parent="p", parent_column="pid"), 2),
]


@pytest.mark.parametrize("check,expected", CASES)
def test_each_check(spark, table, check, expected):
    parent = spark.createDataFrame([("b",)], "pid string")
    report = quality.quality_report({"t": table, "p": parent}, [check]).collect()
    assert [(r.table_name, r.column_name, r.check_name, r.n_failed) for r in report] == [
        ("t", check.column, check.kind, expected)
    ]
    if check.kind not in ("unique", "relationship"):
        assert quality.failing_rows(table, check).count() == expected


def test_suite_raises_with_the_failures(spark, table):
    report = quality.quality_report({"t": table}, [c for c, _ in CASES[:2]])
    with pytest.raises(quality.QualityError, match="t.id not_null: 2"):
        quality.require_clean(report)
    quality.require_clean(report.filter("n_failed = 0"))


def test_precision_gate(spark):
    facts = spark.createDataFrame(
        [("1", "A"), ("2", "A"), ("3", "B"), ("4", None), ("5", "Z")], "feedback_id string, resolved_campaign_id string"
    )
    labels = spark.createDataFrame(
        [("1", "A"), ("2", "A"), ("3", None), ("4", "A"), ("5", "Z")], "feedback_id string, true_campaign_id string"
    )
    campaigns = spark.createDataFrame([("A",), ("B",)], "campaign_id string")
    assert quality.resolution_precision(facts, labels).head().precision == 0.75
    assert quality.precision_failures(facts, labels).count() == 1
    assert quality.precision_failures(facts, labels, gate=0.75).count() == 0
    nothing = facts.filter("resolved_campaign_id is null")
    assert quality.precision_failures(nothing, labels).count() == 0
    got = quality.resolution_quality(facts, labels, campaigns).head()
    assert (got.n_rows, got.exact_match, got.precision, got.specificity, got.hallucinated_ids) == (5, 0.6, 0.75, 0.0, 1)


def test_themes_explode(spark):
    staged = spark.createDataFrame(
        [("a", '["price","returns"]'), ("b", "[]"), ("c", None)], "feedback_id string, themes_json string"
    )
    got = sorted((r.feedback_id, r.theme) for r in marts.fct_feedback_themes(staged).collect())
    assert got == [("a", "price"), ("a", "returns")]


def test_performance_keeps_campaigns_without_feedback(spark):
    summary = spark.createDataFrame(
        [("A", "meta", "a", "traffic", 1.0, 1, 2.0, 2.0), ("B", "meta", "b", "traffic", 1.0, 1, 2.0, 2.0)],
        "campaign_id string, channel string, campaign_name string, objective string, total_spend double, "
        "total_conversions long, total_conversion_value double, avg_roas double",
    )
    facts = spark.createDataFrame(
        [("A", "positive", 1, 0.5), ("A", "mixed", 0, 0.6), (None, "negative", -1, 0.0)],
        "resolved_campaign_id string, sentiment string, sentiment_score int, resolution_confidence double",
    )
    got = {r.campaign_id: r for r in marts.fct_campaign_performance(summary, facts).collect()}
    assert (got["A"].feedback_count, got["A"].net_sentiment_score, got["A"].avg_resolution_confidence) == (2, 0.5, 0.55)
    assert (got["B"].feedback_count, got["B"].net_sentiment_score) == (0, None)


def test_checks_counted_in_the_write(spark, table, tmp_path):
    """Counted while the rows are written, for all rows and for a part of them: the
    same report, and no scan for what is counted."""
    row = [c for c, _ in CASES if c.kind not in quality.WHOLE_TABLE]
    watch = quality.Watch()
    part = Check("u", "conf", "between", low=0, high=1)
    watched = watch.on(watch.on(table, [c for c, _ in CASES]), [part], "sentiment = 'angry'")
    watched.repartition(3).write.parquet(str(tmp_path / "t"))
    counted = watch.counts()
    assert counted == {**{c: n for c, n in CASES if c in row}, part: 1}
    parent = spark.createDataFrame([("b",)], "pid string")
    written = spark.read.parquet(str(tmp_path / "t"))
    plain = quality.quality_report({"t": written, "p": parent}, [c for c, _ in CASES])
    quick = quality.quality_report({"t": written, "p": parent}, [c for c, _ in CASES], counted)
    assert sorted(map(str, plain.collect())) == sorted(map(str, quick.collect()))
    only = quality.quality_report({"t": written}, row, counted)
    assert "FileScan" not in spark._jvm.PythonSQLUtils.explainString(only._jdf.queryExecution(), "simple")
    assert sorted(r.n_failed for r in only.collect()) == sorted(counted[c] for c in row)


def test_counters_of_an_empty_write(spark, table, tmp_path):
    watch = quality.Watch()
    watch.on(table.filter("id = 'none'"), [CASES[0][0]]).repartition(2, "id").write.parquet(str(tmp_path / "t"))
    assert watch.counts() == {CASES[0][0]: 0}
