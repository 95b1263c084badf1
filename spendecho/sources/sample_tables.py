"""Bronze-shaped inputs derived from the general test tables.

Ad rows come from `lineitem`, feedback from `documents`, cached enrichments
from `documents` with `labels`. All of it is Spark expressions over whole
tables, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import ratio, round_n
from ..operators.enrichment import feedback_keys
from ..operators.joins import first_per_key
from ..schemas import AD_TABLES, CACHE_SCHEMA, CHANNEL_LABELS, MONEY, OBJECTIVES, RAW_RECORD_SCHEMA, THEMES, UNIT_PRICE
from ..session import materialize

LOADED_AT = "2025-01-01 00:00:00"
ENRICHED_AT = "2025-01-02 00:00:00"
MODEL = "model-2"
OLD_MODEL = "model-1"
FLAG_OF = {"meta_ads": "R", "google_ads": "A", "tiktok_ads": "N"}
CHANNEL_OF_FLAG = {"R": "meta", "A": "google_ads", "N": "tiktok"}
PREFIXES = ["mt", "gg", "tk"]
CAMPAIGNS = [f"{p}-c{i}" for p in PREFIXES for i in (1, 2, 3)]
#: Every known label in a changing case and padding, then labels that no channel has.
SPELLINGS = [str.upper, str, lambda label: f" {label} ", str.title, str.capitalize]
LABELS = [label for labels in CHANNEL_LABELS.values() for label in labels]
SOURCES = [
    *[SPELLINGS[i % len(SPELLINGS)](label) for i, label in enumerate(LABELS)],
    "newsletter", "call centre", "kiosk 4", "n/a", "",
]
AUTHORS = ["jane_r", "  padded name ", "", "—", "m.lopez", " "]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / F.lit(100)).cast(MONEY)


# --- ads ----------------------------------------------------------------------


def ads(spark: SparkSession, sf_dir: str, platform: str | None = None) -> DataFrame:
    """Ad rows at (date, ad set); one platform's table, or all in one pass.

    Cents are added as integers; partial sums run before the shuffle, which
    then carries one row per task, day and ad set.
    """
    rows = table(spark, sf_dir, "lineitem")
    if platform:
        rows = rows.filter(F.col("l_returnflag") == FLAG_OF[platform])
    flag = F.col("l_returnflag")
    channel = F.when(flag == "R", "meta").when(flag == "A", "google_ads").otherwise("tiktok")
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    grouped = (
        rows.select(
            F.col("l_shipdate").cast("date").alias("date"),
            channel.alias("channel"),
            (F.col("l_suppkey") % 12).cast("int").alias("ad_no"),
            (F.col("l_quantity").cast("bigint") - 1).alias("q"),
            "l_linenumber",
            cents.alias("cents"),
            F.rint(F.col("l_tax") * 100).cast("bigint").alias("tax"),
        )
        .groupBy("date", "channel", "ad_no")
        .agg(
            (F.sum("q") * 100).alias("impressions"),
            F.sum("l_linenumber").alias("clicks"),
            _money(F.sum("cents")).alias("spend"),
            F.sum("tax").alias("conversions"),
            _money(F.sum(F.col("cents") * F.col("l_linenumber"))).alias("conversion_value"),
        )
    )
    c = F.col("channel")
    prefix = F.when(c == "meta", "mt").when(c == "google_ads", "gg").otherwise("tk")
    campaign_no = F.col("ad_no") % 3
    return grouped.select(
        "date",
        "channel",
        F.format_string("%s-c%d", prefix, campaign_no + 1).alias("campaign_id"),
        F.concat(c, F.lit(" — campaign "), campaign_no + 1).alias("campaign_name"),
        pick(OBJECTIVES, campaign_no).alias("objective"),
        F.format_string("%s-set-%02d", prefix, F.col("ad_no") + 1).alias("ad_set_id"),
        F.concat(F.lit("Audience & "), F.col("ad_no") + 1).alias("ad_set_name"),
        "impressions",
        "clicks",
        "spend",
        "conversions",
        "conversion_value",
        ratio(F.col("spend"), F.col("clicks"), 4).cast(UNIT_PRICE).alias("cpc"),
        F.lit("USD").alias("currency"),
        ntz(LOADED_AT).alias("_loaded_at"),
    )


def ad_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: ads(spark, sf_dir, name) for name in AD_TABLES}


# --- feedback -------------------------------------------------------------------


def _label(doc: Column) -> Column:
    return F.when(doc % 15 < 9, pick(CAMPAIGNS, F.least(doc % 15, F.lit(8)))).otherwise("")


def _feedback_id(doc: Column) -> Column:
    return F.concat(F.lit("FB_"), F.lpad(doc.cast("string"), 12, "0"))


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 366).cast("int"))
    iso = F.date_format(day, "yyyy-MM-dd")
    clock = F.format_string(" %02d:%02d:%02d", doc % 24, doc % 60, doc % 59)
    shapes = [
        iso,
        F.concat(iso, clock),
        F.date_format(day, "MM/dd/yyyy"),
        F.date_format(day, "M/d/yy"),
        F.date_format(day, "MMMM d, yyyy"),
        F.date_format(day, "yyyy.MM.dd"),
        F.concat(F.lit("  "), iso, F.lit(" ")),
        F.date_format(day, "d MMM yyyy"),
        F.lit("soon"),
        F.lit(""),
    ]
    posted = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        posted = F.when(doc % 11 == i, shape).otherwise(posted)
    score = (doc % 5 + 1).cast("int")
    text_score = score.cast("string")
    ratings = [
        text_score,
        F.concat(text_score, F.lit("/5")),
        F.concat(text_score, F.lit(".0")),
        F.concat(F.repeat(F.lit("★"), score), F.repeat(F.lit("☆"), 5 - score)),
        F.concat(text_score, F.lit(" stars")),
        F.lit("good"),
        F.lit(""),
    ]
    rating = F.lit(None).cast("string")
    for i, shape in enumerate(ratings):
        rating = F.when(doc % 8 == i, shape).otherwise(rating)
    return table(spark, sf_dir, "documents").select(
        _feedback_id(doc).alias("feedback_id"),
        posted.alias("posted_at"),
        F.when(doc % 21 < 20, pick(SOURCES, F.least(doc % 21, F.lit(len(SOURCES) - 1)))).alias("source"),
        rating.alias("rating"),
        F.col("text").alias("review_text"),
        pick(AUTHORS, doc % 6).alias("author"),
        _label(doc).alias("true_campaign_id"),
        ntz(LOADED_AT).alias("_loaded_at"),
    )


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feedback_id, content_hash), written once: the texts are read and hashed
    one time, however often the keys are joined afterwards."""
    return materialize(feedback_keys(feedback(spark, sf_dir)), "feedback-keys")


# --- enrichment -----------------------------------------------------------------


def cache(spark: SparkSession, sf_dir: str, feedback_key_rows: DataFrame) -> DataFrame:
    """Cached records for the labelled documents, unique per (hash, model).

    Only ids and hashes are joined; equal texts keep the smallest document.
    """
    doc = F.col("doc_id")
    hashed = feedback_key_rows.select(
        F.substring("feedback_id", 4, 12).cast("bigint").alias("doc_id"), "content_hash"
    )
    languages = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = (
        table(spark, sf_dir, "labels").join(hashed, "doc_id").join(languages, "doc_id")
    )
    models = (
        F.when(doc % 4 == 0, F.array(F.lit(OLD_MODEL), F.lit(MODEL)))
        .when(doc % 4 == 1, F.array(F.lit(OLD_MODEL)))
        .otherwise(F.array(F.lit(MODEL)))
    )
    versions = first_per_key(
        labelled.withColumn("model_version", F.explode(models)),
        ["content_hash", "model_version"],
        [doc.asc()],
    )
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    sentiment = (
        F.when(good & toxic, "mixed").when(good, "positive").when(toxic, "negative")
        .otherwise("neutral")
    )
    old = F.col("model_version") == OLD_MODEL
    wrong = pick(CAMPAIGNS, (doc % 15 + 1) % 9)
    resolved = (
        F.when((doc % 15 >= 9) | (doc % 13 == 0), F.lit(""))
        .when(doc % 97 == 0, F.lit("mt-c99"))
        .when(doc % 10 == 0, wrong)
        .otherwise(_label(doc))
    )
    theme_list = F.array_sort(F.array_distinct(F.array(
        pick(THEMES, doc % 8), pick(THEMES, F.floor(doc / 8) % 8)
    )))
    empty = F.array().cast("array<string>")
    record = {
        "sentiment": F.when(old & (doc % 3 == 0), "neutral").otherwise(sentiment),
        "sentiment_confidence": (F.when(old, 40).otherwise(50) + doc % 50).cast("double") / 100.0,
        "themes": F.when(doc % 11 == 0, empty).otherwise(theme_list),
        "product_mentions": F.array(F.concat(F.lit("item "), doc % 20)),
        "competitor_mentions": F.when(doc % 5 == 0, F.array(F.concat(F.lit("brand "), doc % 7)))
        .otherwise(empty),
        "language": F.col("lang"),
        "campaign_reference": F.when(resolved != "", F.lit(" your ad ")).otherwise(""),
        "resolved_campaign_id": resolved,
        "resolution_confidence": F.when(
            resolved != "", (60 + doc % 40).cast("double") / 100.0
        ).otherwise(F.lit(0.0)),
    }
    return versions.select(
        "content_hash", "model_version", *[e.alias(n) for n, e in record.items()]
    ).select(*CACHE_SCHEMA.names)


# Rules of a stand-in enricher, once as Spark expressions and once as a plain
# function for the batch hook. Answers depend on the length of the whole text
# and include every kind of bad value.
ANSWER_SENTIMENTS = ["positive", "negative", "neutral", "mixed", "angry"]
ANSWER_CONFIDENCES = ["0.75", "-1", "2", None, "abc", "0.4"]
ANSWER_CAMPAIGNS = [" mt-c1 ", "gg-c2", "tk-c3", "gg-c99", "", None]


def raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    long_text = F.concat(F.lit("  "), F.repeat(F.lit("ref "), 60))
    confidence = pick(ANSWER_CONFIDENCES, n % 6)
    many = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.concat(F.lit("p"), i))
    answer = {
        "sentiment": pick(ANSWER_SENTIMENTS, n % 5),
        "sentiment_confidence": confidence,
        "themes": F.when(n % 7 == 0, F.array().cast("array<string>")).otherwise(
            F.array(pick(THEMES, n % 8), F.lit("bogus"), pick(THEMES, n % 3), pick(THEMES, n % 8))
        ),
        "product_mentions": F.when(n % 2 == 0, many).otherwise(F.array(F.lit("one"))),
        "competitor_mentions": F.array().cast("array<string>"),
        "language": F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, "").otherwise(" EN-Latn-GBX "),
        "campaign_reference": F.when(n % 2 == 0, long_text).otherwise(F.lit(None)),
        "resolved_campaign_id": pick(ANSWER_CAMPAIGNS, n % 6),
        "resolution_confidence": confidence,
    }
    return table(spark, sf_dir, "documents").select(
        _feedback_id(F.col("doc_id")).alias("feedback_id"),
        *[e.cast(f.dataType).alias(f.name) for f in RAW_RECORD_SCHEMA if (e := answer.get(f.name)) is not None],
    )


def rule_enricher() -> Callable[[list[dict]], list[dict]]:
    """The same rules as a batch function; texts whose length divides by 17 get
    no answer, and each batch has one answer that a later one replaces."""
    sentiments, confidences, campaigns = ANSWER_SENTIMENTS, ANSWER_CONFIDENCES, ANSWER_CAMPAIGNS
    themes = THEMES

    def answer(row):
        n = len(row["review_text"])
        return {
            "feedback_id": row["feedback_id"],
            "sentiment": sentiments[n % 5],
            "sentiment_confidence": confidences[n % 6],
            "themes": [] if n % 7 == 0 else [themes[n % 8], "bogus", themes[n % 3], themes[n % 8]],
            "product_mentions": [f"p{i}" for i in range(1, 13)] if n % 2 == 0 else ["one"],
            "competitor_mentions": [],
            "language": [None, "", " EN-Latn-GBX ", " EN-Latn-GBX "][n % 4],
            "campaign_reference": "  " + "ref " * 60 if n % 2 == 0 else None,
            "resolved_campaign_id": campaigns[n % 6],
            "resolution_confidence": confidences[n % 6],
        }

    def enrich(batch):
        answered = [r for r in batch if len(r["review_text"]) % 17]
        stale = [{**answer(r), "sentiment": "angry"} for r in answered[:1]]
        return stale + [answer(r) for r in answered]

    return enrich
