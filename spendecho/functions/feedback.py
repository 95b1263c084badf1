from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..schemas import CHANNEL_LABELS
from .text import strip

# Accepted date shapes (anchored pattern, parse format).
DATE_SHAPES = [
    (r"^\d{1,4}-\d{1,2}-\d{1,2}$", "y-M-d"),
    (r"^\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "y-M-d H:m:s"),
    (r"^\d{1,2}/\d{1,2}/\d{3,4}$", "M/d/y"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\p{Alpha}+ \d{1,2}, \d{1,4}$", "MMMM d, y"),
    (r"^\d{1,4}\.\d{1,2}\.\d{1,2}$", "y.M.d"),
    (r"^\d{1,2} \p{Alpha}{3} \d{1,4}$", "d MMM y"),
]
LAST_TWO_DIGIT_YEAR = 2068  # 69-99 mean 1969-1999


def channel_of(source: Column) -> Column:
    label = F.lower(F.trim(source))
    arms = reduce(
        lambda acc, kv: acc.when(label.isin(kv[1]), F.lit(kv[0])),
        CHANNEL_LABELS.items(),
        F,
    )
    return arms.otherwise(F.lit("other"))


def parse_date_any(c: Column) -> Column:
    """Date in any accepted shape, else NULL.

    The shapes exclude each other, so a cheap pattern picks the one format to
    parse: no row pays for a chain of failed parses.
    """
    text = F.regexp_replace(strip(c), r"\s+", " ")

    def parse(fmt: str) -> Column:
        day = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
        if fmt.endswith("/yy"):
            late = F.year(day) > LAST_TWO_DIGIT_YEAR
            day = F.when(late, F.add_months(day, -1200)).otherwise(day)
        return day

    return reduce(
        lambda acc, shape: acc.when(text.rlike(shape[0]), parse(shape[1])), DATE_SHAPES, F
    )


def parse_rating(c: Column) -> Column:
    """Filled stars, or the first run of digits; NULL when there is neither."""
    filled = F.length(c) - F.length(F.replace(c, F.lit("★"), F.lit("")))
    digits = F.regexp_extract(c, r"\d+", 0).try_cast("int")
    return F.when(c.contains("★"), filled).otherwise(digits)


def sentiment_score(sentiment: Column) -> Column:
    return (
        F.when(sentiment == "positive", F.lit(1))
        .when(sentiment == "negative", F.lit(-1))
        .otherwise(F.lit(0))
    )
