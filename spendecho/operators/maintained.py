"""Aggregates that follow their rows by what changes, without reading the rest again.

Sums are kept as a log of partial sums. A run appends what its new rows add and, with
the sign turned, what the rows they replace had added; counts are whole numbers and
amounts exact decimals, so the log's total is the sum over the live rows, to the last
digit, in whatever order the parts came. Days a campaign was active are kept as one bit
a day and month and joined by OR, so days of several loads count once.

Each log carries in `as_of` up to which row it has counted. A run that is repeated
after a failure appends nothing that is there already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import from_json_list, money_sum, ratio, sentiment_score, surrogate_key
from ..schemas import SENTIMENTS
from .staging import stage_enriched

CAMPAIGN_KEYS = ["channel", "campaign_id", "campaign_name", "objective"]
VOICE_KEYS = ["resolved_campaign_id", "sentiment", "language"]
THEME_KEYS = ["theme", "resolved_campaign_id", "sentiment"]
CONFIDENCE_KEYS = ["resolution_confidence"]
#: What of an enriched row sums and history are made of; a row keeps these of the one it replaces.
COUNTED = ["sentiment", "language", "resolved_campaign_id", "resolution_confidence", "themes", "model_version"]


# --- spend ------------------------------------------------------------------------


def spend_states(ad_spend: DataFrame, month: str = "month") -> DataFrame:
    """One row per campaign and month: its days as bits, and its exact totals."""
    rows = ad_spend if month in ad_spend.columns else ad_spend.withColumn(month, F.date_format("date", "yyyy-MM"))
    day = F.expr("shiftleft(1, dayofmonth(date) - 1)")
    return rows.groupBy(*CAMPAIGN_KEYS, month).agg(
        F.bit_or(day).alias("days"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        money_sum(F.col("spend")).alias("spend"),
        F.sum("conversions").alias("conversions"),
        money_sum(F.col("conversion_value")).alias("conversion_value"),
    )


def campaign_summary(states: DataFrame, month: str = "month") -> DataFrame:
    """Lifetime figures from states of any number of loads."""
    money = "decimal(22,2)"
    by_month = states.groupBy(*CAMPAIGN_KEYS, month).agg(
        F.bit_or("days").alias("days"),
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "spend", "conversions", "conversion_value")],
    )
    grouped = by_month.groupBy(*CAMPAIGN_KEYS).agg(
        F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("bigint").alias("total_days_active"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("spend").cast(money).alias("total_spend"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("conversion_value").cast(money).alias("total_conversion_value"),
    )

    def of(a: str, b: str, places: int) -> Column:
        return ratio(F.col(f"total_{a}"), F.col(f"total_{b}"), places)

    return grouped.select(
        surrogate_key("channel", "campaign_id").alias("surrogate_key"),
        *grouped.columns,
        of("clicks", "impressions", 6).alias("avg_ctr"),
        of("spend", "conversions", 4).alias("avg_cpa"),
        of("conversion_value", "spend", 4).alias("avg_roas"),
    )


# --- feedback ---------------------------------------------------------------------


def changes(rows: DataFrame) -> DataFrame:
    """Enriched rows as signed rows: each with 1 and, where it has `_replaced` (the values
    of the row it replaces), those with -1. Rows without that column are all additions."""
    staged = ["sentiment", "language", "resolved_campaign_id", "resolution_confidence", "themes_json"]

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return stage_enriched(df).select(*staged, "_enriched_at", F.lit(sign).cast("long").alias("sign"))

    if "_replaced" not in rows.columns:
        return signed(rows, 1)
    replaced = rows.filter(F.col("_replaced").isNotNull())
    replaced = replaced.withColumns({c: F.col(f"_replaced.{c}") for c in COUNTED})
    return signed(rows, 1).unionByName(signed(replaced, -1))


def _as_of() -> Column:
    return F.max("_enriched_at").alias("as_of")


def voice_sums(signed: DataFrame) -> DataFrame:
    """Rows and confidences by campaign, sentiment and language. Values beyond 1e11 have
    no exact sum and are not expected: confidences are held to [0, 1] when they come."""
    c, s = F.col("resolution_confidence"), F.col("sign")
    wide = c.cast("decimal(28,17)")
    wide = F.when(s > 0, wide).otherwise(-wide)
    return signed.groupBy(*VOICE_KEYS).agg(
        F.sum("sign").alias("n"),
        F.coalesce(F.sum(F.when(c.isNotNull(), s)), F.lit(0)).alias("n_confidence"),
        F.coalesce(F.sum(wide), F.lit(0)).cast("decimal(38,17)").alias("confidence"),
        _as_of(),
    )


def theme_sums(signed: DataFrame) -> DataFrame:
    themes = signed.withColumn("theme", F.explode(from_json_list(F.col("themes_json"))))
    return themes.groupBy(*THEME_KEYS).agg(F.sum("sign").alias("n"), _as_of())


def confidence_sums(signed: DataFrame) -> DataFrame:
    """How many resolved rows have each confidence, for the least and the greatest."""
    resolved = signed.filter(F.col("resolved_campaign_id").isNotNull() & F.col("resolution_confidence").isNotNull())
    return resolved.groupBy(*CONFIDENCE_KEYS).agg(F.sum("sign").alias("n"), _as_of())


def total(log: DataFrame, keys: list[str]) -> DataFrame:
    """The log's parts added up; what has gone to nothing is left out."""
    measures = [c for c in log.columns if c not in (*keys, "as_of")]
    added = log.groupBy(*keys).agg(*[F.sum(c).cast(log.schema[c].dataType).alias(c) for c in measures])
    return added.filter(F.col("n") != 0)


def _average(confidence: Column, n: Column) -> Column:
    return ratio(confidence, n, 4)


def campaign_performance(summary: DataFrame, voice: DataFrame) -> DataFrame:
    """Spend next to sentiment, from the summary and the totals of `voice_sums`."""
    score = F.sum(F.col("n") * sentiment_score(F.col("sentiment")))
    counts = ["feedback_count", *[f"{s}_count" for s in SENTIMENTS]]
    by_campaign = (
        voice.filter(F.col("resolved_campaign_id").isNotNull())
        .groupBy(F.col("resolved_campaign_id").alias("campaign_id"))
        .agg(
            F.sum("n").alias("feedback_count"),
            *[F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("n"))), F.lit(0)).alias(f"{s}_count") for s in SENTIMENTS],
            ratio(score, F.sum("n"), 4).alias("net_sentiment_score"),
            _average(F.sum("confidence"), F.sum("n_confidence")).alias("avg_resolution_confidence"),
        )
    )
    return summary.join(by_campaign, "campaign_id", "left").select(
        "campaign_id", "channel", "campaign_name", "objective",
        "total_spend", "total_conversions", "total_conversion_value", "avg_roas",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        "net_sentiment_score", "avg_resolution_confidence",
    )


def language_split(voice: DataFrame) -> DataFrame:
    counts = voice.groupBy("language").agg(F.sum("n").alias("n_feedback"))
    whole = counts.agg(F.sum("n_feedback").alias("n")).scalar()
    return counts.select("language", "n_feedback", ratio(F.col("n_feedback"), whole, 6).alias("share"))


def resolved_share(voice: DataFrame) -> DataFrame:
    resolved = F.col("resolved_campaign_id").isNotNull()

    def of(c: str) -> Column:
        return F.coalesce(F.sum(F.when(resolved, F.col(c))), F.lit(0))

    n = F.coalesce(F.sum("n"), F.lit(0))
    return voice.agg(
        n.alias("n_feedback"), of("n").alias("n_resolved"), ratio(of("n"), n, 6).alias("resolved_share"),
        _average(of("confidence"), of("n_confidence")).alias("avg_confidence"),
    )


def resolution_confidence(voice: DataFrame, confidences: DataFrame) -> DataFrame:
    lowest = confidences.agg(F.min("resolution_confidence").alias("x")).scalar()
    highest = confidences.agg(F.max("resolution_confidence").alias("x")).scalar()
    return resolved_share(voice).select("n_resolved", "avg_confidence", lowest.alias("min_confidence"), highest.alias("max_confidence"))


def theme_counts(themes: DataFrame, campaigns: list[str] | None = None, sentiments: list[str] | None = None) -> DataFrame:
    if campaigns:
        themes = themes.filter(F.col("resolved_campaign_id").isin(campaigns))
    if sentiments:
        themes = themes.filter(F.col("sentiment").isin(sentiments))
    return themes.select(*THEME_KEYS, F.col("n").alias("n_feedback"))


def top_themes(themes: DataFrame, k: int, **slicers) -> DataFrame:
    counts = theme_counts(themes, **slicers).groupBy("theme").agg(F.sum("n_feedback").alias("n_feedback"))
    return counts.orderBy(F.desc("n_feedback"), "theme").limit(k)
