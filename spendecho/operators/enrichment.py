"""Feedback enrichment: cache replay, validation, pluggable batch enricher."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import as_json_list, clamp01, content_hash, strip
from ..schemas import (
    CACHE_SCHEMA, ENRICHED_COLUMNS, ENRICHER_INPUT, LIST_COLUMNS, MAX_LANGUAGE_CHARS,
    MAX_MENTIONS, MAX_REFERENCE_CHARS, NEUTRAL_LANGUAGE, RAW_RECORD_SCHEMA, RECORD_COLUMNS,
    SENTIMENTS, THEMES,
)
from ..session import workers_import_package
from ..sources.ledger import Ledger, batch_key
from .joins import BROADCAST_ROWS, first_per_key, fits_broadcast

Enricher = Callable[[list[dict]], list[dict] | None]

#: When a cached record was written; the greater one of a key counts.
SEQUENCE = "written_at"


@dataclass
class Layers:
    """A cache in parts, oldest first, each with one record per key. The first one may
    be bucketed by content_hash; look-ups then come to it, bucket by bucket."""

    parts: list[DataFrame]
    buckets: int | None = None

    def plus(self, other: Layers) -> Layers:
        return Layers([*self.parts, *other.parts], self.buckets)


Cache = DataFrame | Layers


def layers_of(cache: Cache) -> Layers:
    return cache if isinstance(cache, Layers) else Layers([cache])


# --- keys and cache ---------------------------------------------------------


def hashed_keys(feedback: DataFrame) -> DataFrame:
    """(feedback_id, content_hash, _loaded_at) of every Bronze row."""
    loaded = F.col("_loaded_at") if "_loaded_at" in feedback.columns else F.lit(None)
    return feedback.select(
        "feedback_id", content_hash(F.col("review_text"), F.col("source")).alias("content_hash"),
        loaded.cast("timestamp_ntz").alias("_loaded_at"),
    )


def newest_keys(hashed: DataFrame) -> DataFrame:
    """(feedback_id, content_hash), unique by id: of several Bronze rows with one
    id, the one loaded last stands (then the greatest hash). The duplicates are
    reported by the declared checks."""
    order = [F.col("_loaded_at").desc_nulls_last(), F.col("content_hash").desc()]
    return first_per_key(hashed, ["feedback_id"], order).select("feedback_id", "content_hash")


def feedback_keys(feedback: DataFrame) -> DataFrame:
    """The only thing the joins below move."""
    return newest_keys(hashed_keys(feedback))


def model_preference(model: str) -> list[Column]:
    """The requested model's record first, else the last model's."""
    return [(F.col("model_version") == model).desc(), F.col("model_version").desc()]


def best_records(cache: DataFrame, model: str) -> DataFrame:
    return first_per_key(cache, ["content_hash"], model_preference(model))


def upsert_cache(cache: DataFrame, new: DataFrame) -> DataFrame:
    """New records replace cached ones of the same (content_hash, model_version)."""
    key = ["content_hash", "model_version"]
    kept = cache.join(new.select(*key), key, "left_anti")
    return kept.unionByName(new.select(*cache.columns))


def looked_up(texts: DataFrame, cache: Cache, model: str) -> DataFrame:
    """`texts` (unique by content_hash) with the best record of each: of the model, else
    of the last model; of one key the later written one. `_hit` is NULL without a record.

    Each part is ranked and joined by itself. A bucketed part is not shuffled: the texts
    are dealt into its buckets."""
    layers, found = layers_of(cache), []
    rows = texts.repartition(layers.buckets, "content_hash") if layers.buckets else texts
    for i, part in enumerate(layers.parts):
        written_at = F.col(SEQUENCE) if SEQUENCE in part.columns else F.lit(None).cast("long")
        rank = [(F.col("model_version") == model).alias("exact"), F.col("model_version"), F.coalesce(written_at, F.lit(-1)).alias("at"), F.lit(i).alias("layer")]
        best = best_records(part, model).select("content_hash", F.struct(*rank, *RECORD_COLUMNS).alias(f"_part{i}"))
        rows, found = rows.join(best, "content_hash", "left"), [*found, F.col(f"_part{i}")]
    best = F.greatest(*found) if len(found) > 1 else found[0]
    return rows.withColumn("_best", best).select(
        *texts.columns, F.when(F.col("_best").isNotNull(), True).alias("_hit"), *[F.col(f"_best.{c}").alias(c) for c in ("model_version", *RECORD_COLUMNS)]
    )


# --- misses -----------------------------------------------------------------


def _unseen(rows: DataFrame, cache: Cache, model: str) -> DataFrame:
    for part in layers_of(cache).parts:
        known = part.filter(F.col("model_version") == model).select("content_hash")
        rows = rows.join(known, "content_hash", "left_anti")
    return rows


def cache_misses(keys: DataFrame, cache: Cache, model: str) -> DataFrame:
    """Feedback rows whose text the model has not seen."""
    return _unseen(keys, cache, model).select(*keys.columns)


def texts_to_enrich(keys: DataFrame, cache: Cache, model: str) -> DataFrame:
    """One feedback id per unseen text: the greatest id stands for all copies.

    The aggregation runs before the join, so a text with very many copies is a
    single row by the time it is joined, and both steps share one shuffle (texts are
    dealt into the buckets of a bucketed cache, which is not shuffled then).
    """
    distinct = keys.groupBy("content_hash").agg(
        F.max("feedback_id").alias("feedback_id"), F.count("*").alias("copies")
    )
    buckets = layers_of(cache).buckets
    return _unseen(distinct.repartition(buckets, "content_hash") if buckets else distinct, cache, model)


def enricher_input(
    feedback: DataFrame, chosen: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Texts of the chosen ids, without the held-out label.

    With few misses the id list is broadcast and no text is shuffled at all.
    """
    ids = F.broadcast(chosen) if fits_broadcast(chosen, broadcast_rows) else chosen
    return feedback.select(*ENRICHER_INPUT).join(ids, "feedback_id")


# --- batches ----------------------------------------------------------------


BATCHES_PER_BUCKET = 100


def bucket_digits(n_rows: int, batch_size: int) -> int:
    """Hex digits so that a bucket holds about BATCHES_PER_BUCKET batches."""
    digits = 1
    while 16 ** digits * BATCHES_PER_BUCKET * batch_size < n_rows:
        digits += 1
    return digits


def batch_ids(rows: DataFrame, batch_size: int, hex_digits: int) -> DataFrame:
    """Fixed-size batches in id order inside hash buckets.

    A bucket is the first hex digits of md5(feedback_id): ids are unique, so
    buckets are even and their number grows with the rows; only the last batch
    of a bucket can be short. No global row number is needed.
    """
    bucketed = rows.withColumn("bucket", F.substring(F.md5(F.col("feedback_id")), 1, hex_digits))
    position = F.row_number().over(Window.partitionBy("bucket").orderBy("feedback_id"))
    return bucketed.withColumn("batch_no", F.floor((position - 1) / batch_size).cast("int"))


def batch_payloads(feedback: DataFrame, chosen: DataFrame, batch_size: int) -> DataFrame:
    """One JSON array of at most batch_size items per batch. `chosen` should be
    a written table: it is counted to size the buckets."""
    digits = bucket_digits(chosen.count(), batch_size)
    batches = batch_ids(chosen.select("feedback_id"), batch_size, digits)
    item = F.struct(*ENRICHER_INPUT)
    return (
        enricher_input(feedback, batches)
        .groupBy("bucket", "batch_no")
        .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list(item)).alias("items"))
        .select(
            "bucket",
            "batch_no",
            "n_items",
            F.to_json("items", {"ignoreNullFields": "false"}).alias("payload"),
        )
    )


def full_batches(n_rows: int, batch_size: int) -> int:
    """Partitions of about eight batches, so that few batches are short."""
    return max(1, math.ceil(n_rows / (8 * batch_size)))


def run_enricher(
    texts: DataFrame, enricher: Enricher, batch_size: int = 100, partitions: int | None = None,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Call a user-supplied function on batches of rows, inside the tasks.

    Answers are matched to their batch by id, the last answer for an id wins;
    rows without an answer are simply missing and stay misses. An enricher that
    returns None (out of quota) is not called again for its partition.

    With a `ledger` the batches are cut in id order, and each is looked up there
    before it is sent and put there as soon as it is answered, so a task that Spark
    retries, or a second reading of this frame, sends only what is left. Without one
    every reading asks again: write the answers before they are read.
    """
    spread = texts.repartition(partitions, "feedback_id") if partitions else texts
    if ledger:
        workers_import_package(texts.sparkSession)
        spread = spread.sortWithinPartitions("feedback_id", "content_hash")
    inputs, lists, answer_columns = ENRICHER_INPUT, LIST_COLUMNS, RAW_RECORD_SCHEMA.names
    columns = ["content_hash", *answer_columns]

    def cell(name, value):
        if value is None:
            return None
        return [str(v) for v in value] if name in lists else str(value)

    def ask(batch: pd.DataFrame) -> pd.DataFrame | None:
        asked = batch[inputs].astype(object).where(batch[inputs].notna(), None)
        answers = enricher(asked.to_dict("records"))
        if answers is None:
            return None
        table = pd.DataFrame(
            [[cell(c, a.get(c)) for c in answer_columns]
             for a in answers if isinstance(a, dict)],
            columns=answer_columns,
            dtype=object,
        ).drop_duplicates("feedback_id", keep="last")
        return batch[["feedback_id", "content_hash"]].merge(table, on="feedback_id")[columns]

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                batch = frame.iloc[start:start + batch_size]
                key = batch_key(batch[["feedback_id", "content_hash"]].values.tolist()) if ledger else None
                known = ledger.get(key) if ledger else None
                if known is not None:
                    yield pd.DataFrame(known, columns=columns, dtype=object)
                    continue
                found = ask(batch)
                if found is None:
                    return
                if ledger:
                    ledger.put(key, found.where(found.notna(), None).to_dict("records"))
                yield found

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in RAW_RECORD_SCHEMA]
    return spread.mapInPandas(call, ", ".join(["content_hash string", *fields]))


def parse_responses(responses: DataFrame, column: str) -> DataFrame:
    """JSON arrays of answers, one per row, to one row per answer."""
    shape = f"array<{RAW_RECORD_SCHEMA.simpleString()}>"
    return responses.select(F.inline(F.from_json(F.col(column), shape)))


# --- validation -------------------------------------------------------------


def _first(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def normalize(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Untrusted answers to in-vocabulary records; other columns pass through.

    Campaign ids that are not in the catalog are rejected.
    """
    no_list = F.array().cast("array<string>")

    def mentions(name: str) -> Column:
        return F.slice(F.coalesce(F.col(name), no_list), 1, MAX_MENTIONS)

    themes = F.array_sort(
        F.array_distinct(F.filter(F.coalesce(F.col("themes"), no_list), lambda t: t.isin(THEMES)))
    )
    valid = (
        catalog.select(F.col("campaign_id").alias("_rid")).distinct()
        .withColumn("_valid", F.lit(True))
    )
    asked = raw.withColumn("_rid", F.nullif(strip(F.col("resolved_campaign_id")), F.lit("")))
    checked = asked.join(valid, "_rid", "left")
    rid = F.when(F.col("_valid"), F.col("_rid")).otherwise(F.lit(""))
    clean = {
        "sentiment": F.when(F.col("sentiment").isin(SENTIMENTS), F.col("sentiment")).otherwise(
            F.lit("neutral")
        ),
        "sentiment_confidence": clamp01(F.col("sentiment_confidence")),
        "themes": F.when(F.size(themes) == 0, F.array(F.lit("other"))).otherwise(themes),
        "product_mentions": mentions("product_mentions"),
        "competitor_mentions": mentions("competitor_mentions"),
        "language": _first(
            F.lower(strip(F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit(NEUTRAL_LANGUAGE)))),
            MAX_LANGUAGE_CHARS,
        ),
        "campaign_reference": _first(strip(F.col("campaign_reference")), MAX_REFERENCE_CHARS),
        "resolved_campaign_id": rid,
        "resolution_confidence": F.when(
            F.col("_valid"), clamp01(F.col("resolution_confidence"))
        ).otherwise(F.lit(0.0)),
    }
    others = [c for c in raw.columns if c not in clean]
    return checked.select(*others, *[expr.alias(name) for name, expr in clean.items()])


def new_cache_records(normalized: DataFrame, model: str) -> DataFrame:
    return normalized.withColumn("model_version", F.lit(model)).select(*CACHE_SCHEMA.names)


# --- assembly ---------------------------------------------------------------


def fallback_values() -> dict[str, Column]:
    empty = F.array().cast("array<string>")
    return {
        "sentiment": F.lit("neutral"),
        "sentiment_confidence": F.lit(0.0),
        "themes": F.array(F.lit("other")),
        "product_mentions": empty,
        "competitor_mentions": empty,
        "language": F.lit(NEUTRAL_LANGUAGE),
        "campaign_reference": F.lit(""),
        "resolved_campaign_id": F.lit(""),
        "resolution_confidence": F.lit(0.0),
    }


def assemble(
    keys: DataFrame,
    cache: Cache,
    model: str,
    run_ts: Column,
    previous: DataFrame | None = None,
    replaced: list[str] | None = None,
) -> DataFrame:
    """One enriched row per feedback row: cached record, else neutral fallback.

    With `previous`, a row whose record, text and producing model are the same
    as before keeps its old timestamp, so only real changes pass the watermark.
    Of several previous rows with one id the newest counts. `replaced` names columns
    of that row to hand on in `_replaced`, NULL where there is none.
    """
    more = []
    if isinstance(cache, Layers):  # per text, so that copies of one do not meet in a bucket
        best = looked_up(keys.select("content_hash").distinct(), cache, model).filter("_hit")
    else:
        best = best_records(cache, model).withColumn("_hit", F.lit(True))
    joined = keys.join(best, "content_hash", "left")
    fallback = fallback_values()
    record = {
        c: F.when(F.col("_hit"), F.col(c)).otherwise(fallback[c]) for c in RECORD_COLUMNS
    }
    rows = joined.select(
        "feedback_id",
        *[(as_json_list(e) if c in LIST_COLUMNS else e).alias(c) for c, e in record.items()],
        F.coalesce("model_version", F.lit(model)).alias("model_version"),
        "content_hash",
        run_ts.cast("timestamp_ntz").alias("_enriched_at"),
    )
    if previous is None:
        if replaced:
            kinds = ", ".join(f"{c}: {rows.schema[c].dataType.simpleString()}" for c in replaced)
            rows = rows.withColumn("_replaced", F.lit(None).cast(f"struct<{kinds}>"))
        return rows
    content = [*RECORD_COLUMNS, "model_version", "content_hash"]
    newest = [F.col("_enriched_at").desc(), F.struct(*content).desc()]
    old = first_per_key(previous, ["feedback_id"], newest).select(
        "feedback_id",
        F.struct(*content).alias("_old"),
        F.col("_enriched_at").alias("_old_at"),
    )
    unchanged = F.struct(*content).eqNullSafe(F.col("_old"))
    if replaced:
        more = [F.when(F.col("_old").isNotNull(), F.struct(*[F.col(f"_old.{c}").alias(c) for c in replaced])).alias("_replaced")]
    return (
        rows.join(old, "feedback_id", "left")
        .withColumn(
            "_enriched_at", F.when(unchanged, F.col("_old_at")).otherwise(F.col("_enriched_at"))
        )
        .select(*ENRICHED_COLUMNS, *more)
    )


def run_summary(keys: DataFrame, cache: Cache, model: str) -> DataFrame:
    """Rows, exact hits, misses, resolved and fallback rows, in one row.

    Counted per distinct text before the join, so copies cost nothing there.
    """
    per_text = keys.groupBy("content_hash").agg(F.count("*").alias("n"))
    joined = looked_up(per_text, cache, model)

    def rows_where(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    exact = F.coalesce(F.col("model_version") == model, F.lit(False))
    resolved = F.coalesce(F.col("resolved_campaign_id") != "", F.lit(False))
    return joined.agg(
        rows_where(F.lit(True)).alias("feedback_rows"),
        rows_where(exact).alias("cache_hits"),
        rows_where(~exact).alias("to_enrich"),
        rows_where(resolved).alias("resolved_rows"),
        rows_where(F.col("model_version").isNull()).alias("fallback_rows"),
    )
