"""Silver: typed, cleaned views of the Bronze tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    blank_to_null, channel_of, parse_date_any, parse_rating, ratio, surrogate_key,
)
from ..schemas import AD_SCHEMA


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stage_ads(ads: DataFrame) -> DataFrame:
    """Typed ad rows with impressions, plus row-level rates.

    Rates divide the declared (untruncated) values as doubles; a zero
    denominator gives NULL.
    """
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in AD_SCHEMA]
    return (
        ads.filter(F.col("impressions") > 0)
        .select(*typed, "_loaded_at")
        .select(
            surrogate_key("date", "ad_set_id").alias("surrogate_key"),
            *AD_SCHEMA.names,
            ratio(F.col("clicks"), F.col("impressions"), 6).alias("click_through_rate"),
            ratio(F.col("spend"), F.col("conversions"), 4).alias("cost_per_conversion"),
            ratio(F.col("conversion_value"), F.col("spend"), 4).alias("roas"),
            "_loaded_at",
        )
    )


def stage_feedback(feedback: DataFrame) -> DataFrame:
    """Channel, date and rating out of the raw strings; raw values are kept."""
    return feedback.select(
        "feedback_id",
        "review_text",
        blank_to_null(F.col("author")).alias("author"),
        F.col("source").alias("source_raw"),
        channel_of(F.col("source")).alias("source_channel"),
        F.col("posted_at").alias("posted_at_raw"),
        parse_date_any(F.col("posted_at")).alias("posted_date"),
        F.col("rating").alias("rating_raw"),
        parse_rating(F.col("rating")).alias("rating_value"),
        F.nullif(F.col("true_campaign_id"), F.lit("")).alias("true_campaign_id"),
        "_loaded_at",
    )


def stage_enriched(enriched: DataFrame) -> DataFrame:
    """Tidy labels; lists stay JSON text until they are exploded."""
    return enriched.select(
        "feedback_id",
        F.lower(F.trim("sentiment")).alias("sentiment"),
        "sentiment_confidence",
        F.col("themes").alias("themes_json"),
        F.col("product_mentions").alias("product_mentions_json"),
        F.col("competitor_mentions").alias("competitor_mentions_json"),
        F.lower(F.trim("language")).alias("language"),
        blank_to_null(F.col("campaign_reference")).alias("campaign_reference"),
        blank_to_null(F.col("resolved_campaign_id")).alias("resolved_campaign_id"),
        "resolution_confidence",
        "model_version",
        "content_hash",
        "_enriched_at",
    )


def campaign_catalog(*ad_tables: DataFrame) -> DataFrame:
    """Every campaign seen in Bronze, zero-impression rows included."""
    parts = [t.select("campaign_id", "campaign_name", "channel", "objective") for t in ad_tables]
    return union_all(*parts).distinct()
