"""The declared checks, table by table."""

from __future__ import annotations

from ..operators.quality import Check
from ..schemas import AD_TABLES, CHANNELS, SENTIMENTS, THEMES

# Which column carries which check, and the bounds.
SPEND_RANGE = (0, 10_000)
ROAS_RANGE = (0, 200)
RATING_RANGE = (1, 5)
UNIT_RANGE = (0, 1)
SCORE_RANGE = (-1, 1)
LANGUAGE_LENGTH = (2, 12)

REQUIRED = {
    **{f"raw.{t}": ["date", "ad_set_id"] for t in AD_TABLES},
    "raw.customer_feedback": ["feedback_id", "review_text"],
    "raw.feedback_enriched": ["feedback_id"],
    **{f"staging.stg_{t}": ["surrogate_key", "date", "campaign_id", "ad_set_id"] for t in AD_TABLES},
    "staging.stg_customer_feedback": ["feedback_id"],
    "staging.stg_feedback_enriched": ["feedback_id", "sentiment"],
    "marts.fct_ad_spend": ["surrogate_key", "date", "channel", "campaign_id", "ad_set_id"],
    "marts.fct_channel_daily": ["surrogate_key", "date", "channel"],
    "marts.fct_campaign_summary": ["surrogate_key", "channel", "campaign_id"],
    "marts.dim_campaigns": ["surrogate_key", "channel", "campaign_id", "campaign_name", "objective"],
    "marts.fct_feedback": ["feedback_id"],
    "marts.fct_feedback_themes": ["surrogate_key", "theme"],
    "marts.fct_campaign_performance": ["campaign_id"],
}

UNIQUE = {
    "raw.customer_feedback": "feedback_id",
    "raw.feedback_enriched": "feedback_id",
    **{f"staging.stg_{t}": "surrogate_key" for t in AD_TABLES},
    "staging.stg_customer_feedback": "feedback_id",
    "staging.stg_feedback_enriched": "feedback_id",
    "marts.fct_ad_spend": "surrogate_key",
    "marts.fct_channel_daily": "surrogate_key",
    "marts.fct_campaign_summary": "surrogate_key",
    "marts.dim_campaigns": "surrogate_key",
    "marts.fct_feedback": "feedback_id",
    "marts.fct_feedback_themes": "surrogate_key",
    "marts.fct_campaign_performance": "campaign_id",
}

ACCEPTED = [
    ("staging.stg_customer_feedback", "source_channel", CHANNELS),
    ("staging.stg_feedback_enriched", "sentiment", SENTIMENTS),
    ("marts.fct_feedback", "sentiment", SENTIMENTS),
    ("marts.fct_feedback", "source_channel", CHANNELS),
    ("marts.fct_feedback", "sentiment_score", [-1, 0, 1]),
    ("marts.fct_feedback_themes", "theme", THEMES),
]

BETWEEN = [
    ("staging.stg_customer_feedback", "rating_value", RATING_RANGE, "rating_value is not null"),
    ("staging.stg_feedback_enriched", "sentiment_confidence", UNIT_RANGE, None),
    ("staging.stg_feedback_enriched", "resolution_confidence", UNIT_RANGE, None),
    ("marts.fct_ad_spend", "spend", SPEND_RANGE, None),
    ("marts.fct_ad_spend", "roas", ROAS_RANGE, None),
    ("marts.fct_feedback", "resolution_confidence", UNIT_RANGE, None),
    ("marts.fct_campaign_performance", "net_sentiment_score", SCORE_RANGE,
     "net_sentiment_score is not null"),
]

LENGTHS = [("staging.stg_feedback_enriched", "language", LANGUAGE_LENGTH)]

RELATIONSHIPS = [
    ("raw.feedback_enriched", "feedback_id", "raw.customer_feedback", "feedback_id"),
    ("marts.fct_feedback", "resolved_campaign_id", "marts.dim_campaigns", "campaign_id"),
    ("marts.fct_feedback_themes", "feedback_id", "marts.fct_feedback", "feedback_id"),
    ("marts.fct_campaign_performance", "campaign_id", "marts.dim_campaigns", "campaign_id"),
]
# End of fixed values.

DECLARED = [
    *[Check(t, c, "not_null") for t, columns in REQUIRED.items() for c in columns],
    *[Check(t, c, "unique") for t, c in UNIQUE.items()],
    *[Check(t, c, "accepted_values", values=tuple(v)) for t, c, v in ACCEPTED],
    *[Check(t, c, "between", low=r[0], high=r[1], where=w) for t, c, r, w in BETWEEN],
    *[Check(t, c, "length_between", low=r[0], high=r[1]) for t, c, r in LENGTHS],
    *[Check(t, c, "relationship", parent=p, parent_column=pc) for t, c, p, pc in RELATIONSHIPS],
]
