"""Every operator as a runnable query over the given tables.

A query takes (spark, sf_dir) and returns a DataFrame; nothing here filters the
inputs down. Keys are the names used for the result check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import channel_of, content_hash, parse_date_any, parse_rating
from ..operators import enrichment as enr
from ..operators import history, incremental, maintained, quality, slices, staging, uniqueness
from ..schemas import AD_TABLES, CHANNELS, LIST_COLUMNS, SNAPSHOT_CHECKS
from ..session import materialize, scratch_path
from ..sources import cache as cache_files
from ..sources import landing
from ..sources import sample_tables as sample
from ..sources.sample_tables import ENRICHED_AT, MODEL, OLD_MODEL, ntz
from ..sources.tables import create_layers, export_marts, exported, replace_table
from . import checks, marts, views
from .pipeline import enrich_in_rounds

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SLICE_FROM, SLICE_TO = date(1998, 1, 1), date(1999, 12, 31)
TOP_THEMES = 5
HIGH_SPEND = 1_000_000.0
BATCH_SIZE = 100
FIRST_ROWS = 6
BATCH_DAY = "2024-01-16 00:00:00"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- shared inputs --------------------------------------------------------------


def _ad_spend(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_ad_spend(staging.stage_ads(sample.ads(spark, sf)))


def _staged_feedback(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_feedback(sample.feedback(spark, sf))


def _enriched(spark: SparkSession, sf: str, model: str = MODEL) -> DataFrame:
    keys = sample.keys(spark, sf)
    return enr.assemble(keys, sample.cache(spark, sf, keys), model, ntz(ENRICHED_AT))


def _staged_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_enriched(_enriched(spark, sf))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_feedback(_staged_enriched(spark, sf), _staged_feedback(spark, sf))


def _enriched_table(spark: SparkSession, sf: str) -> DataFrame:
    """Written out: for queries that read it more than once."""
    return materialize(_enriched(spark, sf), "feedback-enriched")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(staging.campaign_catalog(sample.ads(spark, sf)), "campaign-catalog")


def _performance(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_campaign_performance(
        marts.fct_campaign_summary(_ad_spend(spark, sf)), _facts(spark, sf)
    )


def _json_lists(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.to_json(c) for c in LIST_COLUMNS})


# --- Bronze ---------------------------------------------------------------------


def _csv_round_trip(df: DataFrame, dataset: landing.Dataset) -> DataFrame:
    path = scratch_path(df.sparkSession, dataset.table)
    df.select(*dataset.schema.names).write.csv(
        path, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return landing.read_csv(df.sparkSession, path, dataset)


@query
def bronze_ads(spark, sf):
    """CSV files of the three platforms, written and read back through the loader."""
    parts = [
        _csv_round_trip(sample.ads(spark, sf, t), landing.DATASETS[t]) for t in AD_TABLES
    ]
    return marts.served(staging.union_all(*parts))


@query
def bronze_feedback(spark, sf):
    return _csv_round_trip(sample.feedback(spark, sf), landing.DATASETS["customer_feedback"])


@query
def cache_files_round_trip(spark, sf):
    """The cache written as sorted JSON lines, a second file with newer records
    for the old model, and the last record per key read back."""
    records = sample.cache(spark, sf, sample.keys(spark, sf))
    path = scratch_path(spark, "cache")
    cache_files.write_cache(records, path)
    newer = records.filter(F.col("model_version") == OLD_MODEL).withColumn(
        "sentiment", F.lit("mixed")
    )
    cache_files.append_cache(newer, path)
    return _json_lists(cache_files.read_cache(spark, path))


@query
def bronze_mixed_headers(spark, sf):
    """Ad files of one folder with their columns in two orders, read by name."""
    dataset = landing.DATASETS["google_ads"]
    rows, names = sample.ads(spark, sf, "google_ads"), dataset.schema.names
    path = scratch_path(spark, "mixed-headers")
    even = F.pmod(F.xxhash64("ad_set_id", "date"), F.lit(2)) == 0
    for mode, columns, half in (("error", names, rows.filter(even)), ("append", names[::-1], rows.filter(~even))):
        half.select(*columns).write.mode(mode).csv(
            path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    return marts.served(landing.read_csv(spark, path, dataset))


@contextmanager
def _layers(spark: SparkSession) -> Iterator[dict[str, str]]:
    """The four databases under a name of their own; dropped at the end, so what a
    query returns is written elsewhere first."""
    names = create_layers(spark, f"q{uuid.uuid4().hex}_")
    try:
        yield names
    finally:
        for name in names.values():
            spark.sql(f"DROP DATABASE {name} CASCADE")


@query
def bronze_loads(spark, sf):
    """Rows landed and rows there after a load, an append of the same, and a replacement."""
    rows = sample.feedback(spark, sf).drop("_loaded_at")
    with _layers(spark) as db:
        table, seen = f"{db['raw']}.customer_feedback", []
        for step, truncate in enumerate((False, False, True)):
            landed = landing.land(rows, table, truncate)
            seen.append((step, landed, spark.table(table).filter(F.col("_loaded_at").isNotNull()).count()))
    return spark.createDataFrame(seen, "step int, landed long, there long")


@query
def mart_export(spark, sf):
    """A mart as a catalog table partitioned by month, exported to Parquet and read back."""
    daily = marts.fct_channel_daily(_ad_spend(spark, sf))
    path = scratch_path(spark, "export")
    with _layers(spark) as db:
        by_month = daily.withColumn("month", F.date_format("date", "yyyy-MM"))
        replace_table(by_month, f"{db['marts']}.fct_channel_daily", partition_by="month")
        export_marts(spark, db["marts"], path, ["fct_channel_daily"])
    return spark.read.parquet(exported(spark, path)["fct_channel_daily"])


# --- Silver ---------------------------------------------------------------------


def _stage_platform(table: str) -> Query:
    def run(spark, sf):
        return marts.served(staging.stage_ads(sample.ads(spark, sf, table)))

    return run


for _name in AD_TABLES:
    REGISTRY[f"stg_{_name}"] = _stage_platform(_name)


@query
def stg_customer_feedback(spark, sf):
    return _staged_feedback(spark, sf)


@query
def channel_map(spark, sf):
    rows = sample.feedback(spark, sf)
    return rows.select("feedback_id", channel_of(F.col("source")).alias("source_channel"))


@query
def date_parse(spark, sf):
    rows = sample.feedback(spark, sf)
    return rows.select("feedback_id", parse_date_any(F.col("posted_at")).alias("posted_date"))


@query
def rating_parse(spark, sf):
    rows = sample.feedback(spark, sf)
    return rows.select("feedback_id", parse_rating(F.col("rating")).alias("rating_value"))


@query
def staged_view(spark, sf):
    """Silver as a session view, read by SQL."""
    _staged_feedback(spark, sf).createOrReplaceTempView("stg_customer_feedback")
    return spark.sql("SELECT source_channel, rating_value, count(*) AS n FROM stg_customer_feedback GROUP BY ALL")


@query
def stg_feedback_enriched(spark, sf):
    return _staged_enriched(spark, sf)


# --- enrichment -----------------------------------------------------------------


@query
def hash_keys(spark, sf):
    rows = sample.feedback(spark, sf)
    return rows.select(
        "feedback_id",
        content_hash(F.col("review_text"), F.col("source")).alias("content_hash"),
    )


def _enricher_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sample.feedback(spark, sf).select(
        "feedback_id", "posted_at", "source", "rating", "review_text"
    )


@query
def enricher_rows(spark, sf):
    """Enricher input, without the held-out label."""
    return _enricher_rows(spark, sf)


@query
def enricher_first_rows(spark, sf):
    """The first rows by id, for a smoke run; a top-k, not a sort."""
    return _enricher_rows(spark, sf).orderBy("feedback_id").limit(FIRST_ROWS)


@query
def output_sample(spark, sf):
    """The first assembled rows by id, to look at."""
    rows = _enriched(spark, sf).select(
        "feedback_id", "sentiment", "sentiment_confidence", "themes", "language",
        "resolved_campaign_id", "resolution_confidence",
    )
    return rows.orderBy("feedback_id").limit(FIRST_ROWS)


@query
def campaign_catalog(spark, sf):
    return staging.campaign_catalog(sample.ads(spark, sf)).orderBy("campaign_id")


@query
def catalog_lines(spark, sf):
    return views.catalog_lines(staging.campaign_catalog(sample.ads(spark, sf)))


@query
def catalog_pages(spark, sf):
    """All lines in numbered pages of four lines."""
    return views.catalog_pages(_catalog(spark, sf), 4)


@query
def catalog_text(spark, sf):
    return views.catalog_text(_catalog(spark, sf))


@query
def cache_lookup(spark, sf):
    return _json_lists(enr.best_records(sample.cache(spark, sf, sample.keys(spark, sf)), MODEL))


@query
def cache_misses(spark, sf):
    keys = sample.keys(spark, sf)
    return enr.cache_misses(keys, sample.cache(spark, sf, keys), MODEL)


@query
def texts_to_enrich(spark, sf):
    keys = sample.keys(spark, sf)
    return enr.texts_to_enrich(keys, sample.cache(spark, sf, keys), MODEL)


@query
def batch_payload(spark, sf):
    keys = sample.keys(spark, sf)
    chosen = materialize(
        enr.texts_to_enrich(keys, sample.cache(spark, sf, keys), MODEL), "texts-to-enrich"
    )
    return enr.batch_payloads(sample.feedback(spark, sf), chosen, BATCH_SIZE)


@query
def response_parse(spark, sf):
    """Answers as JSON text, one array per hash bucket, parsed back to rows."""
    answers = sample.raw_answers(spark, sf)
    batches = enr.batch_ids(answers, BATCH_SIZE, enr.bucket_digits(answers.count(), BATCH_SIZE))
    responses = batches.groupBy("bucket", "batch_no").agg(
        F.to_json(F.collect_list(F.struct(*answers.columns))).alias("response")
    )
    return _json_lists(enr.parse_responses(responses, "response"))


@query
def enrich_normalize(spark, sf):
    return _json_lists(enr.normalize(sample.raw_answers(spark, sf), _catalog(spark, sf)))


def _new_records(spark: SparkSession, sf: str, keys: DataFrame, cached: DataFrame) -> DataFrame:
    chosen = materialize(enr.texts_to_enrich(keys, cached, MODEL), "texts-to-enrich")
    texts = enr.enricher_input(sample.feedback(spark, sf), chosen)
    partitions = enr.full_batches(chosen.count(), BATCH_SIZE)
    answers = materialize(
        enr.run_enricher(texts, sample.rule_enricher(), BATCH_SIZE, partitions), "answers"
    )
    clean = enr.normalize(answers, _catalog(spark, sf))
    return enr.new_cache_records(clean, MODEL)


@query
def enrich_new_texts(spark, sf):
    """Misses through the batch hook, validated: new cache records."""
    keys = sample.keys(spark, sf)
    return _json_lists(_new_records(spark, sf, keys, sample.cache(spark, sf, keys)))


@query
def enrich_live(spark, sf):
    """Misses enriched, cache updated, every feedback row assembled. The new
    records are written first: the enricher is called once per text."""
    keys = sample.keys(spark, sf)
    cached = sample.cache(spark, sf, keys)
    new = materialize(_new_records(spark, sf, keys, cached), "new-records")
    updated = enr.upsert_cache(cached, new)
    return enr.assemble(keys, updated, MODEL, ntz(ENRICHED_AT))


@query
def enrich_assemble(spark, sf):
    """Cache replay only; unseen texts get the neutral fallback."""
    return _enriched(spark, sf)


@query
def enrich_carry_forward(spark, sf):
    """A rerun with another model: only rows that changed get the new time."""
    keys = sample.keys(spark, sf)
    cached = sample.cache(spark, sf, keys)
    before = enr.assemble(keys, cached, OLD_MODEL, ntz(ENRICHED_AT))
    after = enr.assemble(keys, cached, MODEL, ntz("2025-01-03 00:00:00"), previous=before)
    return after.select("feedback_id", "model_version", "content_hash", "_enriched_at")


@query
def enrich_rerun_duplicates(spark, sf):
    """Bronze appended three times, and a run after each: one row per id, unchanged."""
    once = sample.feedback(spark, sf)
    days = ["2025-01-02 00:00:00", "2025-01-03 00:00:00", "2025-01-04 00:00:00"]
    bronze = staging.union_all(*[once.withColumn("_loaded_at", ntz(day)) for day in days])
    keys = materialize(enr.feedback_keys(bronze), "feedback-keys")
    cached = sample.cache(spark, sf, sample.keys(spark, sf))
    log = materialize(enr.assemble(keys, cached, MODEL, ntz(days[0])), "enriched-log")
    for day in days[1:]:
        again = enr.assemble(keys, cached, MODEL, ntz(day), previous=log.unionByName(log))
        log = materialize(again, "enriched-log")
    return log


@query
def enrich_resumed(spark, sf):
    """A run that stops after one of three rounds, and the next, which takes the rest."""
    keys, catalog = sample.keys(spark, sf), _catalog(spark, sf)
    cached = sample.cache(spark, sf, keys)
    path, feedback = scratch_path(spark, "cache"), sample.feedback(spark, sf)

    def known():
        return enr.upsert_cache(cached, cache_files.read_cache(spark, path))

    class Stopped(Exception):
        pass

    calls = []

    def stopping():
        calls.append(1)
        if len(calls) > 1:
            raise Stopped
        return known()

    with suppress(Stopped):
        enrich_in_rounds(feedback, keys, stopping, catalog, MODEL, sample.rule_enricher(), path, BATCH_SIZE, 3)
    enrich_in_rounds(feedback, keys, known, catalog, MODEL, sample.rule_enricher(), path, BATCH_SIZE, 3)
    return _json_lists(cache_files.read_cache(spark, path))


@query
def enrich_summary(spark, sf):
    keys = sample.keys(spark, sf)
    return enr.run_summary(keys, sample.cache(spark, sf, keys), MODEL)


# --- Gold -----------------------------------------------------------------------


@query
def fct_ad_spend(spark, sf):
    return marts.served(_ad_spend(spark, sf))


@query
def ad_spend_union(spark, sf):
    """The same mart from three separate platform tables."""
    staged = [staging.stage_ads(t) for t in sample.ad_tables(spark, sf).values()]
    return marts.served(marts.fct_ad_spend(*staged))


@query
def fct_channel_daily(spark, sf):
    return marts.served(marts.fct_channel_daily(_ad_spend(spark, sf)))


@query
def fct_campaign_summary(spark, sf):
    return marts.served(marts.fct_campaign_summary(_ad_spend(spark, sf)))


@query
def dim_campaigns(spark, sf):
    return marts.dim_campaigns(_ad_spend(spark, sf))


@query
def fct_feedback(spark, sf):
    return _facts(spark, sf)


@query
def fct_feedback_themes(spark, sf):
    return marts.fct_feedback_themes(_staged_enriched(spark, sf))


@query
def fct_campaign_performance(spark, sf):
    return marts.served(_performance(spark, sf))


# --- increments and history -----------------------------------------------------


def _enriched_day() -> Column:
    """A row's enrichment day in the increment scenario, from its id."""
    number = F.substring("feedback_id", 4, 12).cast("bigint")
    return F.make_timestamp_ntz(
        F.lit(2024), F.lit(1), (number % 28 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0)
    )


def _increment_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """First load: rows enriched before the 16th, Spanish ones arriving late.
    Second source: all rows, those of mixed sentiment enriched again."""
    rows = _facts(spark, sf).withColumn("_enriched_at", _enriched_day())
    rows = materialize(rows, "feedback-facts")
    loaded = rows.filter((F.col("_enriched_at") < ntz(BATCH_DAY)) & (F.col("language") != "es"))
    again = F.col("sentiment") == "mixed"
    source = rows.withColumns({
        "_enriched_at": F.when(again, F.col("_enriched_at") + F.expr("interval 40 days"))
        .otherwise(F.col("_enriched_at")),
        "sentiment": F.when(again, "positive").otherwise(F.col("sentiment")),
    })
    return loaded, source


@query
def feedback_incremental(spark, sf):
    loaded, source = _increment_inputs(spark, sf)
    return incremental.merge_increment(loaded, source, "feedback_id", "_enriched_at")


@query
def feedback_incremental_log(spark, sf):
    """The same increment appended to a version log and read as current rows."""
    loaded, source = _increment_inputs(spark, sf)
    newer = incremental.newer_rows(source, loaded, "_enriched_at")
    return incremental.current_rows(loaded.unionByName(newer), "feedback_id", "_enriched_at")


@query
def events_incremental(spark, sf):
    """Keyed increment over events: errors arrive late and are skipped, views
    are sent again 40 days later and replace their first version."""
    events = sample.table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    loaded = events.filter(
        (F.col("ts") < ntz(BATCH_DAY)) & (F.col("event_type") != "error")
    )
    again = F.col("event_type") == "view"
    source = events.withColumns({
        "ts": F.when(again, F.col("ts") + F.expr("interval 40 days")).otherwise(F.col("ts")),
        "value": F.when(again, F.col("value") + 1000.0).otherwise(F.col("value")),
    })
    return incremental.merge_increment(loaded, source, "event_id", "ts")


RUNS = ["2025-01-02 00:00:00", "2025-01-03 00:00:00"]


def _version_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshot runs: the second has another model, new (French) keys and
    vanished (German) keys."""
    keys = sample.keys(spark, sf)
    cached = sample.cache(spark, sf, keys)
    first = enr.assemble(keys, cached, OLD_MODEL, ntz(RUNS[0])).filter("language <> 'fr'")
    second = enr.assemble(keys, cached, MODEL, ntz(RUNS[1])).filter("language <> 'de'")
    log = materialize(
        history.first_versions(first, "feedback_id", SNAPSHOT_CHECKS, ntz(RUNS[0])), "version-log"
    )
    return history.apply_run(log, second, ntz(RUNS[1]))


@query
def scd2_snapshot(spark, sf):
    return history.with_validity(_version_log(spark, sf))


@query
def scd2_changes(spark, sf):
    return history.reclassified(_version_log(spark, sf))


@query
def scd2_asof(spark, sf):
    return history.as_of(
        history.with_validity(_version_log(spark, sf)), ntz("2025-01-02 12:00:00")
    ).select("feedback_id", *SNAPSHOT_CHECKS, "valid_from")


# --- aggregates that follow their rows ---------------------------------------------


@query
def summary_after_increment(spark, sf):
    """Two loads that share months and days: states are appended, and the summary comes
    from them alone."""
    spend = _ad_spend(spark, sf)
    late = F.pmod(F.xxhash64("surrogate_key"), F.lit(5)) == 0
    path = scratch_path(spark, "spend-states")
    for load in (spend.filter(~late), spend.filter(late)):
        maintained.spend_states(load).write.mode("append").parquet(path)
    return marts.served(maintained.campaign_summary(spark.read.parquet(path)))


def _kept_sums(spark: SparkSession, sf: str, *kinds: str) -> list[DataFrame]:
    """Sums after two runs: the first has another model and no French rows; what the
    second appends comes from its new versions only."""
    keys = sample.keys(spark, sf)
    cached = sample.cache(spark, sf, keys)
    first = materialize(enr.assemble(keys, cached, OLD_MODEL, ntz(RUNS[0])).filter("language <> 'fr'"), "enriched-log")
    second = enr.assemble(keys, cached, MODEL, ntz(RUNS[1]), first, maintained.COUNTED)
    newer = materialize(second.filter(F.col("_enriched_at") > ntz(RUNS[0])), "enriched-log")
    out = []
    for kind in kinds:
        sums, path = getattr(maintained, f"{kind}_sums"), scratch_path(spark, f"{kind}-sums")
        for rows in (first, newer):
            sums(maintained.changes(rows)).write.mode("append").parquet(path)
        out.append(maintained.total(spark.read.parquet(path), getattr(maintained, f"{kind.upper()}_KEYS")))
    return out


@query
def performance_after_increment(spark, sf):
    (voice,) = _kept_sums(spark, sf, "voice")
    return marts.served(maintained.campaign_performance(marts.fct_campaign_summary(_ad_spend(spark, sf)), voice))


@query
def language_after_increment(spark, sf):
    return maintained.language_split(*_kept_sums(spark, sf, "voice"))


@query
def resolved_share_after_increment(spark, sf):
    return maintained.resolved_share(*_kept_sums(spark, sf, "voice"))


@query
def confidence_after_increment(spark, sf):
    return maintained.resolution_confidence(*_kept_sums(spark, sf, "voice", "confidence"))


@query
def themes_after_increment(spark, sf):
    return maintained.theme_counts(*_kept_sums(spark, sf, "theme"))


FEEDBACK_SLICE = dict(date_from=date(2024, 2, 1), date_to=date(2024, 9, 30), channels=["meta", "tiktok"])


def _sliced_sums(spark: SparkSession, sf: str, *kinds: str) -> list[DataFrame]:
    """Sums of a date and channel slice over signed rows of the same two runs, laid out by
    month in ranges of date and channel."""
    keys = sample.keys(spark, sf)
    cached = sample.cache(spark, sf, keys)
    first = materialize(enr.assemble(keys, cached, OLD_MODEL, ntz(RUNS[0])).filter("language <> 'fr'"), "enriched-log")
    second = enr.assemble(keys, cached, MODEL, ntz(RUNS[1]), first, maintained.COUNTED)
    newer = materialize(second.filter(F.col("_enriched_at") > ntz(RUNS[0])), "enriched-log")
    feedback, facts, path = _staged_feedback(spark, sf), scratch_path(spark, "facts-log"), scratch_path(spark, "slices")
    for rows, since in ((first, None), (newer, ntz(RUNS[0]))):
        marts.fct_feedback(staging.stage_enriched(rows), feedback).write.mode("append").parquet(facts)
        enriched = first.unionByName(newer, allowMissingColumns=True)
        signed = slices.signed_rows(spark.read.parquet(facts), enriched, since)
        signed.repartitionByRange("month", *slices.CLUSTER).sortWithinPartitions("month", *slices.CLUSTER).write.mode(
            "append"
        ).partitionBy("month").parquet(path)
    sliced = views.slice_feedback(spark.read.parquet(path), **FEEDBACK_SLICE)
    return [slices.sums(sliced, kind) for kind in kinds]


@query
def language_split_sliced(spark, sf):
    return maintained.language_split(*_sliced_sums(spark, sf, "voice"))


@query
def theme_counts_sliced(spark, sf):
    return maintained.theme_counts(*_sliced_sums(spark, sf, "theme"))


@query
def confidence_sliced(spark, sf):
    return maintained.resolution_confidence(*_sliced_sums(spark, sf, "voice", "confidence"))


@query
def scd2_by_log(spark, sf):
    """The history of the same two runs, the second taken from the enriched log alone."""
    keys = sample.keys(spark, sf)
    cached = sample.cache(spark, sf, keys)
    first = materialize(enr.assemble(keys, cached, OLD_MODEL, ntz(RUNS[0])).filter("language <> 'fr'"), "enriched-log")
    second = enr.assemble(keys, cached, MODEL, ntz(RUNS[1]), first, maintained.COUNTED)
    newer = second.filter((F.col("_enriched_at") > ntz(RUNS[0])) & (F.col("language") != "de"))
    log = history.first_versions(first, "feedback_id", SNAPSHOT_CHECKS, ntz(RUNS[0]))
    return history.with_validity(log.unionByName(history.changed_by_log(newer, ntz(RUNS[1]))))


# --- quality --------------------------------------------------------------------


def declared_tables(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[quality.Check, int]]:
    """All checked tables, those with several readers written once; and the row checks
    that were counted in those writes."""
    watch, of = quality.Watch(), lambda t: [c for c in checks.DECLARED if c.table == t]
    ads, channel = sample.ads(spark, sf), F.col("channel")
    for t, c in zip(AD_TABLES, CHANNELS):
        ads = watch.on(ads, of(f"raw.{t}"), f"channel = '{c}'")
    all_ads = materialize(ads, "ads")
    raw_ads = {t: all_ads.filter(channel == c) for t, c in zip(AD_TABLES, CHANNELS)}
    staged_ads = {t: watch.on(staging.stage_ads(df), of(f"staging.stg_{t}")) for t, df in raw_ads.items()}
    enriched = materialize(watch.on(_enriched(spark, sf), of("raw.feedback_enriched")), "feedback-enriched")
    feedback = sample.feedback(spark, sf)
    staged_feedback = staging.stage_feedback(watch.on(feedback, of("raw.customer_feedback")))
    staged_feedback = watch.on(staged_feedback, of("staging.stg_customer_feedback"))
    staged_enriched = watch.on(staging.stage_enriched(enriched), of("staging.stg_feedback_enriched"))
    spend = materialize(watch.on(marts.fct_ad_spend(*staged_ads.values()), of("marts.fct_ad_spend")), "ad-spend")
    summary = materialize(watch.on(marts.fct_campaign_summary(spend), of("marts.fct_campaign_summary")), "campaign-summary")
    facts = watch.on(marts.fct_feedback(staged_enriched, staged_feedback), of("marts.fct_feedback"))
    facts = materialize(facts, "feedback-facts")
    staged_enriched = staging.stage_enriched(enriched)
    tables = {
        **{f"raw.{t}": df for t, df in raw_ads.items()},
        "raw.customer_feedback": feedback,
        "raw.feedback_enriched": enriched,
        **{f"staging.stg_{t}": staging.stage_ads(df) for t, df in raw_ads.items()},
        "staging.stg_customer_feedback": staging.stage_feedback(feedback),
        "staging.stg_feedback_enriched": staged_enriched,
        "marts.fct_ad_spend": spend,
        "marts.fct_channel_daily": marts.fct_channel_daily(spend),
        "marts.fct_campaign_summary": summary,
        "marts.dim_campaigns": marts.dim_campaigns(spend),
        "marts.fct_feedback": facts,
        "marts.fct_feedback_themes": marts.fct_feedback_themes(staged_enriched),
        "marts.fct_campaign_performance": marts.fct_campaign_performance(summary, facts),
    }
    return tables, watch.counts()


@query
def dq_report(spark, sf):
    tables, counted = declared_tables(spark, sf)
    return quality.quality_report(tables, checks.DECLARED, counted)


@query
def resolution_precision(spark, sf):
    return quality.resolution_precision(_facts(spark, sf), _staged_feedback(spark, sf))


@query
def precision_gate(spark, sf):
    return quality.precision_failures(_facts(spark, sf), _staged_feedback(spark, sf))


@query
def precision_gate_strict(spark, sf):
    """The same gate above any precision: the row by which it blocks."""
    return quality.precision_failures(_facts(spark, sf), _staged_feedback(spark, sf), gate=1.01)


@query
def dq_failures(spark, sf):
    """What stops a build: rows for checks that fail, here on facts with bad values."""
    facts = _facts(spark, sf).withColumns({
        "sentiment": F.when(F.col("language") == "fr", "angry").otherwise(F.col("sentiment")),
        "resolution_confidence": F.col("resolution_confidence") + F.when(F.col("language") == "de", 150.0).otherwise(0.0),
    })
    facts = materialize(facts.unionByName(facts.filter("language = 'es'")), "feedback-facts")
    mine = [c for c in checks.DECLARED if c.table == "marts.fct_feedback" and c.kind != "relationship"]
    return quality.quality_report({"marts.fct_feedback": facts}, mine).filter("n_failed > 0")


@query
def resolution_quality(spark, sf):
    return quality.resolution_quality(
        materialize(_facts(spark, sf), "feedback-facts"), _staged_feedback(spark, sf),
        marts.dim_campaigns(_ad_spend(spark, sf)),
    )


@query
def unknown_campaigns(spark, sf):
    """Resolved ids that the campaign dimension does not have."""
    return quality.orphans(
        _facts(spark, sf), "resolved_campaign_id",
        marts.dim_campaigns(_ad_spend(spark, sf)), "campaign_id",
    )


@query
def duplicate_texts(spark, sf):
    """Content hashes shared by several feedback rows."""
    return quality.duplicate_keys(hash_keys(spark, sf), "content_hash")


@query
def duplicates_across_loads(spark, sf):
    """Texts in two loads, the second checked against the key state of the first: keys
    that it repeats, or that were there before."""
    hashes = hash_keys(spark, sf)
    early = F.substring("feedback_id", 4, 12).cast("bigint") % 3 > 0
    hashes = materialize(hashes.withColumn("early", early), "hashes")
    state = uniqueness.KeyState(spark, scratch_path(spark, "key-state"), hashes.count())
    state.add(hashes.filter("early"), "content_hash")
    return state.check(hashes.filter("NOT early"), "content_hash").withColumnRenamed("key", "content_hash")


# --- serving views --------------------------------------------------------------


@query
def spend_vs_sentiment(spark, sf):
    return views.spend_vs_sentiment(marts.served(_performance(spark, sf)), HIGH_SPEND)


@query
def sentiment_mix(spark, sf):
    return views.sentiment_mix(_performance(spark, sf))


@query
def sentiment_mix_sliced(spark, sf):
    """Feedback by campaign and sentiment over a date and channel slice."""
    facts = views.slice_feedback(
        _facts(spark, sf), date(2024, 2, 1), date(2024, 9, 30), channels=["meta", "tiktok"]
    )
    return facts.groupBy("resolved_campaign_id", "sentiment").agg(F.count("*").alias("n_feedback"))


def _theme_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    staged = staging.stage_enriched(_enriched_table(spark, sf))
    return marts.fct_feedback_themes(staged), marts.fct_feedback(staged, _staged_feedback(spark, sf))


@query
def theme_counts(spark, sf):
    return views.theme_counts(*_theme_inputs(spark, sf))


@query
def top_themes(spark, sf):
    return views.top_themes(*_theme_inputs(spark, sf), k=TOP_THEMES, sentiments=["negative"])


@query
def language_split(spark, sf):
    return views.language_split(_facts(spark, sf))


@query
def resolution_confidence(spark, sf):
    return views.resolution_confidence(_facts(spark, sf))


@query
def resolved_share(spark, sf):
    return views.resolved_share(_facts(spark, sf))


@query
def channel_trend_sliced(spark, sf):
    daily = marts.fct_channel_daily(_ad_spend(spark, sf))
    sliced = views.slice_rows(daily, SLICE_FROM, SLICE_TO, channels=["meta", "tiktok"])
    return marts.served(sliced)


@query
def campaign_kpis_sliced(spark, sf):
    """Lifetime figures over a date slice: the slice reaches the scan."""
    spend = views.slice_rows(
        _ad_spend(spark, sf), SLICE_FROM, SLICE_TO, campaigns=["mt-c1", "tk-c3"]
    )
    return marts.served(marts.fct_campaign_summary(spend))


@query
def ad_detail_sliced(spark, sf):
    """Ad rows of some channels over a date slice."""
    return marts.served(
        views.slice_rows(_ad_spend(spark, sf), SLICE_FROM, SLICE_TO, channels=["google_ads"])
    )
