"""Column expressions; all of them stay inside code generation or built-ins."""

from .feedback import channel_of, parse_date_any, parse_rating, sentiment_score
from .numeric import clamp01, exact_avg, money_sum, ratio, round_n
from .text import (
    as_json_list, blank_to_null, content_hash, from_json_list, strip, surrogate_key,
)

__all__ = [
    "as_json_list", "blank_to_null", "channel_of", "clamp01", "content_hash",
    "exact_avg", "from_json_list", "money_sum", "parse_date_any", "parse_rating",
    "ratio", "round_n", "sentiment_score", "strip", "surrogate_key",
]
