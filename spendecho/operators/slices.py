"""Feedback laid out for report slices by date and channel.

Facts are bucketed by id, so a slice of them reads every file. Here the few columns that
reports are made of lie by month, and in each load's files in ranges of date and channel:
a slice opens the folders of its months, and the statistics of files and row groups keep
the rest of them unread.

Rows are signed. A new version of a feedback appends its row with 1 and, with -1, the row
it takes the place of, at that row's own date and channel. The sums of a slice are thus
those of its live rows, without ranking versions or joining themes to facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import maintained
from .incremental import current_rows
from .staging import stage_enriched

UNDATED = "undated"
CLUSTER = ["posted_date", "source_channel", "feedback_id"]  # the id cuts a day with very many rows
COLUMNS = [
    "feedback_id", "posted_date", "source_channel", "sentiment", "language",
    "resolved_campaign_id", "resolution_confidence",
]


def month_of(date: Column) -> Column:
    """Never NULL: a partition column without NULLs needs no sort of its own in the write."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def signed_rows(facts: DataFrame, enriched: DataFrame, since: Column | None = None, replaced: bool = True) -> DataFrame:
    """What the versions in `facts` that are newer than `since` change: the newest of an id
    with 1, the one that was live at `since` with -1. Without `since`, all live rows.
    `replaced` False says that no newer version has one before it; older ones are not read
    then. `enriched` has the themes of each version."""
    key, at = "feedback_id", "_enriched_at"
    parts = [(current_rows(facts if since is None else facts.filter(F.col(at) > since), key, at), 1)]
    if since is not None and replaced:
        ids = facts.filter(F.col(at) > since).select(key)
        older = facts.filter(F.col(at) <= since).join(ids, key, "left_semi")
        parts.append((current_rows(older, key, at), -1))
    themes = stage_enriched(enriched).select(key, at, "themes_json")
    out = None
    for rows, sign in parts:
        rows = rows.join(themes, [key, at], "left").select(
            *COLUMNS, "themes_json", at, F.lit(sign).cast("long").alias("sign"), month_of(F.col("posted_date")).alias("month")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def netted(signed: DataFrame) -> DataFrame:
    """The same rows without those that have gone."""
    same = [c for c in signed.columns if c != "sign"]
    return signed.groupBy(*same).agg(F.sum("sign").alias("sign")).filter("sign <> 0").select(*signed.columns)


def sums(signed: DataFrame, kind: str) -> DataFrame:
    """Totals (voice, theme or confidence, as `maintained` has them) of a slice."""
    parts = getattr(maintained, f"{kind}_sums")(signed)
    return maintained.total(parts, getattr(maintained, f"{kind.upper()}_KEYS"))
