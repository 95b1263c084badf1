"""Gold marts. Money stays an exact decimal here; `served` turns it into doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import exact_avg, from_json_list, money_sum, ratio, sentiment_score, surrogate_key
from ..operators.joins import first_per_key
from ..operators.staging import union_all
from ..schemas import SENTIMENTS

# The columns of the mart.
SPEND_COLUMNS = [
    "surrogate_key", "date", "channel", "campaign_id", "campaign_name", "objective",
    "ad_set_id", "ad_set_name", "impressions", "clicks", "spend", "conversions",
    "conversion_value", "click_through_rate", "cost_per_conversion", "roas",
]
# End of fixed values.


def served(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for reports."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema
    ])


def fct_ad_spend(*staged: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return union_all(*staged).select(*SPEND_COLUMNS, *(extra or []))


def _totals() -> list[Column]:
    return [
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        money_sum(F.col("spend")).alias("total_spend"),
        F.sum("conversions").alias("total_conversions"),
        money_sum(F.col("conversion_value")).alias("total_conversion_value"),
    ]


def _weighted_rates() -> list[Column]:
    """Ratios of the totals, so large days weigh more than small ones."""
    def of(a: str, b: str, places: int) -> Column:
        return ratio(F.col(f"total_{a}"), F.col(f"total_{b}"), places)

    return [
        of("clicks", "impressions", 6).alias("avg_ctr"),
        of("spend", "conversions", 4).alias("avg_cpa"),
        of("conversion_value", "spend", 4).alias("avg_roas"),
    ]


def fct_channel_daily(ad_spend: DataFrame) -> DataFrame:
    grouped = ad_spend.groupBy("date", "channel").agg(*_totals())
    return grouped.select(
        surrogate_key("date", "channel").alias("surrogate_key"),
        *grouped.columns,
        *_weighted_rates(),
    )


def fct_campaign_summary(ad_spend: DataFrame) -> DataFrame:
    """Lifetime totals. Days are counted by adding up per-day rows first, so a
    campaign with most of the rows is already small when it is shuffled."""
    keys = ["channel", "campaign_id", "campaign_name", "objective"]
    grouped = ad_spend.groupBy(*keys).agg(
        F.count_distinct("date").alias("total_days_active"), *_totals()
    )
    return grouped.select(
        surrogate_key("channel", "campaign_id").alias("surrogate_key"),
        *grouped.columns,
        *_weighted_rates(),
    )


def dim_campaigns(ad_spend: DataFrame) -> DataFrame:
    rows = ad_spend.select("channel", "campaign_id", "campaign_name", "objective").distinct()
    return rows.select(surrogate_key("channel", "campaign_id").alias("surrogate_key"), *rows.columns)


def fct_feedback(staged_enriched: DataFrame, staged_feedback: DataFrame) -> DataFrame:
    """One row per enriched id; of several staged rows with an id, the one loaded last."""
    own = ["posted_date", "source_channel", "rating_value"]
    newest = [F.col("_loaded_at").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in own]]
    narrow = staged_feedback.select("feedback_id", *own, "_loaded_at")
    cleaned = first_per_key(narrow, ["feedback_id"], newest).drop("_loaded_at")
    return staged_enriched.join(cleaned, "feedback_id", "left").select(
        "feedback_id",
        "posted_date",
        "source_channel",
        "rating_value",
        "sentiment",
        "sentiment_confidence",
        sentiment_score(F.col("sentiment")).alias("sentiment_score"),
        "language",
        "resolved_campaign_id",
        "resolution_confidence",
        "campaign_reference",
        F.array_size(from_json_list(F.col("themes_json"))).alias("theme_count"),
        "model_version",
        "_enriched_at",
    )


def fct_feedback_themes(staged_enriched: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per feedback and theme; empty and NULL lists give no row."""
    exploded = staged_enriched.select(
        "feedback_id", F.explode(from_json_list(F.col("themes_json"))).alias("theme"), *(extra or [])
    )
    return exploded.select(
        surrogate_key("feedback_id", "theme").alias("surrogate_key"), "feedback_id", "theme", *(extra or [])
    )


def feedback_by_campaign(facts: DataFrame) -> DataFrame:
    counts = [
        F.count_if(F.col("sentiment") == s).alias(f"{s}_count") for s in SENTIMENTS
    ]
    return (
        facts.filter(F.col("resolved_campaign_id").isNotNull())
        .groupBy(F.col("resolved_campaign_id").alias("campaign_id"))
        .agg(
            F.count("*").alias("feedback_count"),
            *counts,
            ratio(
                F.sum("sentiment_score"), F.count("sentiment_score"), 4
            ).alias("net_sentiment_score"),
            exact_avg(F.col("resolution_confidence"), 4).alias("avg_resolution_confidence"),
        )
    )


def fct_campaign_performance(summary: DataFrame, facts: DataFrame) -> DataFrame:
    """Spend next to sentiment. Both sides are one row per campaign when they
    meet, so no side needs a broadcast hint."""
    voice = feedback_by_campaign(facts)
    counts = ["feedback_count", *[f"{s}_count" for s in SENTIMENTS]]
    return summary.join(voice, "campaign_id", "left").select(
        "campaign_id",
        "channel",
        "campaign_name",
        "objective",
        "total_spend",
        "total_conversions",
        "total_conversion_value",
        "avg_roas",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        "net_sentiment_score",
        "avg_resolution_confidence",
    )
