"""Declared schemas and controlled vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# Vocabularies, label sets and date formats the results depend on.
SENTIMENTS = ["positive", "negative", "neutral", "mixed"]
THEMES = [
    "shipping", "price", "product_quality", "customer_service",
    "sizing_fit", "website_app", "returns", "other",
]
CHANNELS = ["meta", "google_ads", "tiktok", "other"]
OBJECTIVES = ["awareness", "traffic", "conversion"]
CHANNEL_LABELS = {
    "meta": ["fb", "facebook", "meta", "fb comment", "ig", "instagram", "insta"],
    "google_ads": ["google", "google reviews", "google play", "play store", "gmb"],
    "tiktok": ["tiktok", "tt", "tt comment"],
}
NEUTRAL_LANGUAGE = "und"
MAX_MENTIONS = 10
MAX_LANGUAGE_CHARS = 10
MAX_REFERENCE_CHARS = 200
HASH_SEPARATOR = "||"
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
WATERMARK_FLOOR = "1900-01-01 00:00:00"
PRECISION_GATE = 0.80
AD_TABLES = ["meta_ads", "google_ads", "tiktok_ads"]
# End of fixed values.

# Every character that a full Unicode strip removes at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Counts are 64-bit and money has 18 digits: both are as cheap in Spark as the
# narrower types, and a wider ad set or a larger table cannot overflow them.
COUNT = T.LongType()
MONEY = T.DecimalType(18, 2)
UNIT_PRICE = T.DecimalType(18, 4)


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


_S = T.StringType()
_ARR = T.ArrayType(T.StringType())

# The columns of the tables, which their readers depend on.
AD_SCHEMA = _fields(
    ("date", T.DateType()),
    ("channel", _S),
    ("campaign_id", _S),
    ("campaign_name", _S),
    ("objective", _S),
    ("ad_set_id", _S),
    ("ad_set_name", _S),
    ("impressions", COUNT),
    ("clicks", COUNT),
    ("spend", MONEY),
    ("conversions", COUNT),
    ("conversion_value", MONEY),
    ("cpc", UNIT_PRICE),
    ("currency", _S),
)

FEEDBACK_SCHEMA = _fields(
    *[(c, _S) for c in (
        "feedback_id", "posted_at", "source", "rating",
        "review_text", "author", "true_campaign_id",
    )]
)

# What an enricher may see: never the held-out label.
ENRICHER_INPUT = ["feedback_id", "source", "rating", "review_text"]

RECORD_FIELDS = [
    ("sentiment", _S),
    ("sentiment_confidence", T.DoubleType()),
    ("themes", _ARR),
    ("product_mentions", _ARR),
    ("competitor_mentions", _ARR),
    ("language", _S),
    ("campaign_reference", _S),
    ("resolved_campaign_id", _S),
    ("resolution_confidence", T.DoubleType()),
]
RECORD_COLUMNS = [name for name, _ in RECORD_FIELDS]
LIST_COLUMNS = ["themes", "product_mentions", "competitor_mentions"]

CACHE_SCHEMA = _fields(("content_hash", _S), ("model_version", _S), *RECORD_FIELDS)

# Raw answers are untrusted: numbers arrive as text and are checked on the way in.
RAW_RECORD_SCHEMA = _fields(
    ("feedback_id", _S),
    *[(n, _S if isinstance(t, T.DoubleType) else t) for n, t in RECORD_FIELDS],
)

ENRICHED_COLUMNS = ["feedback_id", *RECORD_COLUMNS, "model_version", "content_hash", "_enriched_at"]
SNAPSHOT_CHECKS = ["sentiment", "resolved_campaign_id", "themes", "model_version"]

GOLD_TABLES = [
    "fct_ad_spend", "fct_channel_daily", "fct_campaign_summary", "dim_campaigns",
    "fct_feedback", "fct_feedback_themes", "fct_campaign_performance",
]
# End of fixed values.
