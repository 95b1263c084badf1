import json

import pytest
from pyspark.sql import functions as F

from spendecho.operators import enrichment as enr
from spendecho.schemas import CACHE_SCHEMA, ENRICHER_INPUT, RAW_RECORD_SCHEMA
from spendecho.sources.sample_tables import ntz

TS = "2025-01-02 00:00:00"


def record(h, model, sentiment="positive", rid="mt-c1", themes=("price",)):
    return (h, model, sentiment, 0.9, list(themes), ["p"], [], "en", "ref", rid, 0.8)


def cache_of(spark, *records):
    return spark.createDataFrame(list(records), CACHE_SCHEMA)


def keys_of(spark, *rows):
    return spark.createDataFrame(list(rows), "feedback_id string, content_hash string")


def catalog_of(spark, *ids):
    return spark.createDataFrame([(i, i, "meta", "traffic") for i in ids],
                                 "campaign_id string, campaign_name string, channel string, objective string")


def raw(spark, **fields):
    base = dict(
        feedback_id="FB_1", sentiment="positive", sentiment_confidence="0.5", themes=["price"],
        product_mentions=["a"], competitor_mentions=[], language="en", campaign_reference="ad",
        resolved_campaign_id="mt-c1", resolution_confidence="0.7",
    )
    base.update(fields)
    return spark.createDataFrame([tuple(base[c] for c in RAW_RECORD_SCHEMA.names)], RAW_RECORD_SCHEMA)


BAD = [
    ({"sentiment": "angry"}, "sentiment", "neutral"),
    ({"sentiment": None}, "sentiment", "neutral"),
    ({"themes": ["returns", "price", "bogus", "price"]}, "themes", ["price", "returns"]),
    ({"themes": []}, "themes", ["other"]),
    ({"themes": None}, "themes", ["other"]),
    ({"themes": ["bogus"]}, "themes", ["other"]),
    ({"resolved_campaign_id": "mt-c99"}, "resolved_campaign_id", ""),
    ({"resolved_campaign_id": "mt-c99"}, "resolution_confidence", 0.0),
    ({"resolved_campaign_id": " mt-c1 "}, "resolved_campaign_id", "mt-c1"),
    ({"resolved_campaign_id": None}, "resolved_campaign_id", ""),
    ({"sentiment_confidence": "-1"}, "sentiment_confidence", 0.0),
    ({"sentiment_confidence": "2"}, "sentiment_confidence", 1.0),
    ({"sentiment_confidence": None}, "sentiment_confidence", 0.0),
    ({"sentiment_confidence": "abc"}, "sentiment_confidence", 0.0),
    ({"product_mentions": [f"p{i}" for i in range(11)]}, "product_mentions", [f"p{i}" for i in range(10)]),
    ({"product_mentions": None}, "product_mentions", []),
    ({"language": None}, "language", "und"),
    ({"language": ""}, "language", "und"),
    ({"language": " EN-Latn-GBX "}, "language", "en-latn-gb"),
    ({"campaign_reference": "x" * 201}, "campaign_reference", "x" * 200),
    ({"campaign_reference": None}, "campaign_reference", ""),
]


@pytest.mark.parametrize("fields,column,expected", BAD)
def test_normalize(spark, fields, column, expected):
    got = enr.normalize(raw(spark, **fields), catalog_of(spark, "mt-c1", "mt-c2")).head()
    assert got[column] == expected


def test_duplicate_ids_stay_one_row(spark):
    """Bronze appended three times: one key per id, and one row however often it runs."""
    once = feedback_of(spark, 3)
    bronze = once.withColumn("_loaded_at", ntz("2025-01-01 00:00:00")).unionByName(
        once.withColumn("_loaded_at", ntz("2025-01-03 00:00:00")).withColumn("review_text", F.lit("new text"))
    ).unionByName(once.withColumn("_loaded_at", ntz("2025-01-02 00:00:00")))
    keys = enr.feedback_keys(bronze)
    newest = enr.feedback_keys(once.withColumn("review_text", F.lit("new text")))
    assert sorted(keys.collect()) == sorted(newest.collect()) and keys.count() == 3
    rows = None
    for day in (2, 3, 4):
        again = enr.assemble(keys, cache_of(spark), "m", ntz(f"2025-01-0{day} 00:00:00"), rows)
        rows = again if rows is None else rows.unionByName(again)
        assert again.count() == 3


def test_best_record_prefers_model_then_last(spark):
    cache = cache_of(
        spark, record("h1", "m1", "negative"), record("h1", "m2"), record("h2", "m1"),
        record("h2", "m3", "mixed"),
    )
    got = {r.content_hash: (r.model_version, r.sentiment) for r in enr.best_records(cache, "m2").collect()}
    assert got == {"h1": ("m2", "positive"), "h2": ("m3", "mixed")}


def test_assemble_hit_any_model_and_fallback(spark):
    cache = cache_of(spark, record("h1", "m2"), record("h2", "m1", "negative"))
    keys = keys_of(spark, ("a", "h1"), ("b", "h2"), ("c", "h3"), ("d", "h1"))
    got = {r.feedback_id: r for r in enr.assemble(keys, cache, "m2", ntz(TS)).collect()}
    assert (got["a"].sentiment, got["a"].model_version) == ("positive", "m2")
    assert got["d"].themes == '["price"]'
    assert (got["b"].sentiment, got["b"].model_version) == ("negative", "m1")
    c = got["c"]
    assert (c.sentiment, c.themes, c.product_mentions, c.language, c.resolved_campaign_id,
            c.resolution_confidence, c.model_version) == ("neutral", '["other"]', "[]", "und", "", 0.0, "m2")


def test_timestamp_is_carried_for_unchanged_rows(spark):
    keys = keys_of(spark, ("a", "h1"), ("b", "h2"), ("c", "h3"))
    before = enr.assemble(keys, cache_of(spark, record("h1", "m2")), "m2", ntz(TS))
    # b was a fallback of the same model and gets a record now; c stays a fallback.
    later = cache_of(spark, record("h1", "m2"), record("h2", "m2", "mixed"))
    after = enr.assemble(keys, later, "m2", ntz("2025-02-01 00:00:00"), previous=before)
    stamps = {r.feedback_id: str(r._enriched_at)[:10] for r in after.collect()}
    assert stamps == {"a": "2025-01-02", "b": "2025-02-01", "c": "2025-01-02"}


def test_misses_and_one_text_per_hash(spark):
    cache = cache_of(spark, record("h1", "m2"), record("h2", "m1"))
    keys = keys_of(spark, ("a", "h1"), ("b", "h2"), ("c", "h3"), ("d", "h3"), ("e", "h3"))
    assert {r.feedback_id for r in enr.cache_misses(keys, cache, "m2").collect()} == {"b", "c", "d", "e"}
    todo = {r.content_hash: (r.feedback_id, r.copies) for r in enr.texts_to_enrich(keys, cache, "m2").collect()}
    assert todo == {"h2": ("b", 1), "h3": ("e", 3)}


def test_upsert_cache(spark):
    old = cache_of(spark, record("h1", "m1"), record("h1", "m2"), record("h2", "m1"))
    new = cache_of(spark, record("h1", "m2", "mixed"), record("h3", "m2"))
    got = {(r.content_hash, r.model_version): r.sentiment for r in enr.upsert_cache(old, new).collect()}
    assert got == {("h1", "m1"): "positive", ("h1", "m2"): "mixed", ("h2", "m1"): "positive", ("h3", "m2"): "positive"}


def feedback_of(spark, n):
    return spark.range(n).select(
        F.format_string("FB_%05d", "id").alias("feedback_id"),
        F.lit("2024-01-01").alias("posted_at"),
        F.lit("FB").alias("source"),
        F.when(F.col("id") % 2 == 0, "5").alias("rating"),
        F.concat(F.lit("text \"é\" "), "id").alias("review_text"),
        F.lit("x").alias("author"),
        F.lit("mt-c1").alias("true_campaign_id"),
    )


def test_enricher_never_sees_the_label(spark):
    feedback = feedback_of(spark, 5)
    todo = enr.texts_to_enrich(enr.feedback_keys(feedback), cache_of(spark), "m")
    for limit in (100, 1):  # broadcast and shuffle join
        texts = enr.enricher_input(feedback, todo, broadcast_rows=limit)
        assert set(texts.columns) == {*ENRICHER_INPUT, "content_hash", "copies"}
        assert texts.count() == 5


def test_batch_hook(spark):
    feedback = feedback_of(spark, 250)
    todo = enr.texts_to_enrich(enr.feedback_keys(feedback), cache_of(spark), "m")

    def enricher(batch):
        assert len(batch) <= 40
        assert all(set(r) == {"feedback_id", "source", "rating", "review_text"} for r in batch)
        answers = [
            {"feedback_id": r["feedback_id"], "sentiment": "positive" if r["rating"] else "neutral",
             "sentiment_confidence": 0.5, "themes": ["price"]}
            for r in batch if not r["feedback_id"].endswith("7")
        ]
        return [{"feedback_id": "stranger"}, "noise", {**answers[0], "sentiment": "mixed"}, *answers]

    texts = enr.enricher_input(feedback, todo)
    got = enr.run_enricher(texts, enricher, batch_size=40, partitions=3).collect()
    assert len(got) == 225 and len({r.feedback_id for r in got}) == 225
    assert all(r.sentiment == ("positive" if int(r.feedback_id[3:]) % 2 == 0 else "neutral") for r in got)
    assert got[0].sentiment_confidence == "0.5" and got[0].language is None


def test_enricher_out_of_quota(spark):
    feedback = feedback_of(spark, 100)
    todo = enr.texts_to_enrich(enr.feedback_keys(feedback), cache_of(spark), "m")
    calls = []

    def enricher(batch):
        calls.append(1)
        return None if len(calls) > 2 else [{"feedback_id": r["feedback_id"]} for r in batch]

    got = enr.run_enricher(enr.enricher_input(feedback, todo), enricher, batch_size=10, partitions=1)
    assert got.count() == 20


def test_batch_payloads(spark):
    feedback = feedback_of(spark, 250)
    todo = enr.texts_to_enrich(enr.feedback_keys(feedback), cache_of(spark), "m")
    got = enr.batch_payloads(feedback, todo, batch_size=10).collect()
    items = [json.loads(r.payload) for r in got]
    assert all(len(i) == r.n_items <= 10 for i, r in zip(items, got))
    flat = [x for i in items for x in i]
    assert sorted(x["feedback_id"] for x in flat) == [f"FB_{i:05d}" for i in range(250)]
    assert all(set(x) == set(ENRICHER_INPUT) for x in flat)
    for i in items:
        assert [x["feedback_id"] for x in i] == sorted(x["feedback_id"] for x in i)


def test_batch_sizes():
    assert [enr.bucket_digits(n, 100) for n in (0, 160_000, 160_001, 10**9)] == [1, 1, 2, 5]
    assert [enr.full_batches(n, 100) for n in (0, 1500, 10**6)] == [1, 2, 1250]


def test_few_rows_fill_their_batches(spark):
    feedback = feedback_of(spark, 1500)
    todo = enr.texts_to_enrich(enr.feedback_keys(feedback), cache_of(spark), "m")

    def enricher(batch):
        return [{"feedback_id": r["feedback_id"], "language": str(len(batch)), "sentiment": batch[0]["feedback_id"]}
                for r in batch]

    texts = enr.enricher_input(feedback, todo)
    got = enr.run_enricher(texts, enricher, 100, enr.full_batches(1500, 100)).collect()
    assert len(got) == 1500
    assert len({r.sentiment for r in got}) <= 17  # calls


def test_response_text(spark):
    text = json.dumps([
        {"feedback_id": "a", "sentiment": "positive", "sentiment_confidence": 0.5, "themes": ["price"],
         "extra": 1},
        {"feedback_id": "b", "resolution_confidence": "abc"},
    ])
    df = spark.createDataFrame([(text,)], "response string")
    got = {r.feedback_id: r for r in enr.parse_responses(df, "response").collect()}
    assert got["a"].sentiment_confidence == "0.5" and got["a"].themes == ["price"]
    assert got["b"].resolution_confidence == "abc" and got["b"].sentiment is None


def test_summary(spark):
    cache = cache_of(spark, record("h1", "m2"), record("h2", "m1", rid=""))
    keys = keys_of(spark, ("a", "h1"), ("d", "h1"), ("b", "h2"), ("c", "h3"))
    got = enr.run_summary(keys, cache, "m2").head().asDict()
    assert got == {"feedback_rows": 4, "cache_hits": 2, "to_enrich": 2, "resolved_rows": 2, "fallback_rows": 1}
