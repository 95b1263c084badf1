from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import HASH_SEPARATOR, KEY_NULL_TOKEN, KEY_SEPARATOR, WHITESPACE


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def strip(c: Column) -> Column:
    """Remove all Unicode whitespace at both ends; NULL becomes ''.

    Two one-character looks decide whether a text needs trimming at all, which
    long texts rarely do.
    """
    text = F.coalesce(c, F.lit(""))
    blank = F.lit(WHITESPACE)
    padded = F.contains(blank, F.substring(text, 1, 1)) | F.contains(blank, F.substring(text, -1, 1))
    return F.when(padded, F.btrim(text, blank)).otherwise(text)


def content_hash(text: Column, source: Column) -> Column:
    return F.sha2(F.concat(strip(text), F.lit(HASH_SEPARATOR), strip(source)), 256)


def surrogate_key(*columns: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def as_json_list(c: Column) -> Column:
    return F.to_json(c)


def from_json_list(c: Column) -> Column:
    return F.from_json(c, "array<string>")
