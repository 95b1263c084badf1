"""Serving views over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import exact_avg, ratio
from ..schemas import SENTIMENTS
from ..session import materialize

PAGE_LINES = 10_000
#: Lines of a catalog that is given as one value (some 100 MB of text).
MOST_LINES = 1_000_000


def slice_rows(
    df: DataFrame,
    date_from: date | None = None,
    date_to: date | None = None,
    channels: list[str] | None = None,
    campaigns: list[str] | None = None,
) -> DataFrame:
    """Report slicers. Plain comparisons, so they reach the scan and prune
    month partitions."""
    if date_from is not None:
        df = df.filter(F.col("date") >= F.lit(date_from))
        if "month" in df.columns:
            df = df.filter(F.col("month") >= F.lit(date_from.strftime("%Y-%m")))
    if date_to is not None:
        df = df.filter(F.col("date") <= F.lit(date_to))
        if "month" in df.columns:
            df = df.filter(F.col("month") <= F.lit(date_to.strftime("%Y-%m")))
    if channels:
        df = df.filter(F.col("channel").isin(channels))
    if campaigns:
        df = df.filter(F.col("campaign_id").isin(campaigns))
    return df


def slice_feedback(
    facts: DataFrame,
    date_from: date | None = None,
    date_to: date | None = None,
    channels: list[str] | None = None,
    campaigns: list[str] | None = None,
) -> DataFrame:
    """The same slicers on feedback facts, by their date, channel and campaign."""
    names = {"date": "posted_date", "channel": "source_channel", "campaign_id": "resolved_campaign_id"}
    sliced = facts.withColumns({new: F.col(old) for new, old in names.items()})
    return slice_rows(sliced, date_from, date_to, channels, campaigns).select(*facts.columns)


def spend_vs_sentiment(performance: DataFrame, high_spend: float) -> DataFrame:
    """Per campaign: spend, net sentiment, volume; flags costly and disliked."""
    flagged = (F.col("total_spend") >= F.lit(high_spend)) & (F.col("net_sentiment_score") < 0)
    return performance.select(
        "campaign_id",
        "campaign_name",
        "channel",
        "total_spend",
        "net_sentiment_score",
        "feedback_count",
        F.coalesce(flagged, F.lit(False)).alias("costly_and_negative"),
    ).orderBy(F.desc("total_spend"), "campaign_id")


def sentiment_mix(performance: DataFrame) -> DataFrame:
    """Sentiment shares per campaign; NULL where there is no feedback."""
    shares = [
        ratio(F.col(f"{s}_count"), F.col("feedback_count"), 6).alias(f"{s}_share")
        for s in SENTIMENTS
    ]
    return performance.select("campaign_id", "feedback_count", *shares)


def theme_counts(
    themes: DataFrame,
    facts: DataFrame,
    campaigns: list[str] | None = None,
    sentiments: list[str] | None = None,
) -> DataFrame:
    """Theme frequency by campaign and sentiment, so that a report can slice it."""
    side = facts.select("feedback_id", "resolved_campaign_id", "sentiment")
    if campaigns:
        side = side.filter(F.col("resolved_campaign_id").isin(campaigns))
    if sentiments:
        side = side.filter(F.col("sentiment").isin(sentiments))
    return (
        themes.select("feedback_id", "theme")
        .join(side, "feedback_id")
        .groupBy("theme", "resolved_campaign_id", "sentiment")
        .agg(F.count("*").alias("n_feedback"))
    )


def top_themes(themes: DataFrame, facts: DataFrame, k: int, **slicers) -> DataFrame:
    counts = theme_counts(themes, facts, **slicers)
    return (
        counts.groupBy("theme")
        .agg(F.sum("n_feedback").alias("n_feedback"))
        .orderBy(F.desc("n_feedback"), "theme")
        .limit(k)
    )


def language_split(facts: DataFrame) -> DataFrame:
    """Rows and share per language. The total is a scalar over the same
    aggregate, whose shuffle Spark reuses."""
    counts = facts.groupBy("language").agg(F.count("*").alias("n_feedback"))
    total = counts.agg(F.sum("n_feedback").alias("n")).scalar()
    return counts.select("language", "n_feedback", ratio(F.col("n_feedback"), total, 6).alias("share"))


def resolution_confidence(facts: DataFrame) -> DataFrame:
    rows = facts.filter(F.col("resolved_campaign_id").isNotNull())
    c = F.col("resolution_confidence")
    return rows.agg(
        F.count("*").alias("n_resolved"),
        exact_avg(c, 4).alias("avg_confidence"),
        F.min(c).alias("min_confidence"),
        F.max(c).alias("max_confidence"),
    )


def resolved_share(facts: DataFrame) -> DataFrame:
    resolved = F.col("resolved_campaign_id").isNotNull()
    c = F.when(resolved, F.col("resolution_confidence"))
    return facts.agg(
        F.count("*").alias("n_feedback"),
        F.count_if(resolved).alias("n_resolved"),
        ratio(F.count_if(resolved), F.count("*"), 6).alias("resolved_share"),
        exact_avg(c, 4).alias("avg_confidence"),
    )


def catalog_lines(catalog: DataFrame) -> DataFrame:
    """One line of prompt text per campaign; order by campaign_id to print."""
    line = F.concat_ws(" | ", "campaign_id", "campaign_name", "channel", "objective")
    return catalog.select("campaign_id", F.concat(F.lit("  - "), line).alias("line"))


def catalog_pages(catalog: DataFrame, lines_per_page: int = PAGE_LINES) -> DataFrame:
    """(page, n_lines, page_text): the lines in id order, `lines_per_page` to a page,
    every line on one page. Pages joined by line breaks are the whole catalog.

    Lines are numbered by a range sort: each partition numbers its own rows, and
    one row per partition carries the offsets."""
    lines = materialize(
        catalog_lines(catalog).orderBy("campaign_id", "line").withColumn("_part", F.spark_partition_id()),
        "catalog-lines",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lines.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("campaign_id", "line"))
    numbered = lines.withColumn("_line", inside).join(offsets, "_part").withColumn("_line", F.col("_before") + F.col("_line") - 1)
    items = F.array_sort(F.collect_list(F.struct("_line", "line")))
    return numbered.groupBy(F.floor(F.col("_line") / lines_per_page).cast("int").alias("page")).agg(
        F.count("*").alias("n_lines"), F.array_join(F.transform(items, lambda i: i["line"]), "\n").alias("page_text")
    )


def catalog_text(catalog: DataFrame, page: int | None = None, lines_per_page: int = PAGE_LINES) -> DataFrame:
    """The text of the whole catalog (one row; NULL if it has no line), or of one page.
    The whole text is one value: a catalog of more than `MOST_LINES` campaigns fails
    here and is to be read by `catalog_pages`."""
    pages = catalog_pages(catalog, lines_per_page)
    if page is not None:
        return pages.filter(F.col("page") == page).select(F.col("page_text").alias("catalog_text"))
    too_many = F.raise_error(F.lit(f"more than {MOST_LINES} campaigns: read catalog_pages"))
    whole = F.when(F.col("page") * lines_per_page < MOST_LINES, F.col("page_text")).otherwise(too_many)
    items = F.array_sort(F.collect_list(F.struct("page", whole.alias("page_text"))))
    text = F.array_join(F.transform(items, lambda i: i["page_text"]), "\n")
    return pages.agg(F.when(F.count("*") > 0, text).alias("catalog_text"))
