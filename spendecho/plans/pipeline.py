"""Landing to marts in one call, as catalog tables.

Tables that are rebuilt are written in full. Those that grow (hashed feedback
keys, enriched rows, feedback facts, enrichment history) are append-only logs with
a view of their current rows. A daily run reads the narrow keys and the cache, but
hashes only texts loaded since the last run and writes only rows that changed.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import enrichment as enr
from ..operators import history, incremental, maintained, quality, slices, staging
from ..schemas import AD_TABLES, ENRICHED_COLUMNS, KEY_NULL_TOKEN, KEY_SEPARATOR, SNAPSHOT_CHECKS, WATERMARK_FLOOR
from ..session import clear_scratch, materialize, scratch_mark, scratch_path
from ..sources import cache as cache_files
from ..sources import files, landing
from ..sources import ledger as ledger_files
from ..sources.tables import (
    append_clustered, append_table, create_layers, export_marts, finish_swap, replace_partitions, replace_table, save,
    swap_table,
)
from . import checks, marts, views


KEY_LOG, ENRICHED_LOG = "feedback_key_log", "feedback_enriched_log"
#: Partial sums that marts and report views are made of.
SPEND_LOG, THEME_LOG = "spend_state_log", "feedback_theme_log"
FACT_LOG, SLICE_LOG = "fct_feedback_log", "feedback_slice_log"
#: Logs of which `compact_log` keeps the live versions.
COMPACTED = (("raw", KEY_LOG), ("raw", ENRICHED_LOG), ("marts", FACT_LOG))
SUM_LOGS = {"voice": "voice_sum_log", "theme": "theme_sum_log", "confidence": "confidence_sum_log"}
BUCKET_BYTES = 256 << 20
ROUND_BATCHES, MAX_ROUNDS = 20, 64
LEDGER = "_answers"
HIGH_SPEND, TOP_THEMES = 10_000.0, 10


def landed_bytes(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def buckets_for(n_bytes: int) -> int:
    """One bucket per BUCKET_BYTES."""
    return max(1, -(-n_bytes // BUCKET_BYTES))


@dataclass
class Settings:
    landing_dir: str
    cache_path: str
    model: str
    run_ts: datetime
    prefix: str = ""
    truncate: bool | None = None  # replace Bronze; None: a run does, a load alone appends
    enricher: enr.Enricher | None = None  # None replays the cache only
    batch_size: int = 100
    rounds: int | None = None  # None: so many that a round is about twenty batches
    limit: int | None = None  # only the first rows by id, for a smoke run
    keep_cache: bool = True  # False: new records serve this run only
    buckets: int | None = None  # by feedback_id, 0 for none; None: from the bytes landed
    compact_above: int = 1000  # delta files of the cache at which they are folded into its base
    export_dir: str | None = None
    declared: list[quality.Check] = field(default_factory=lambda: checks.DECLARED)


class Run:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.s = spark, settings
        self.db = create_layers(spark, settings.prefix)
        for layer, log in COMPACTED:
            finish_swap(spark, self.name(layer, log))  # of a run that was stopped
        self.run_ts = F.lit(settings.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
        self.new_records = (
            settings.cache_path if settings.keep_cache else scratch_path(spark, "new-records")
        )
        self.by_feedback = self._buckets()
        self.counted: dict[quality.Check, int] = {}  # row checks of tables written in full

    def _buckets(self) -> tuple[int, str] | None:
        """An existing table keeps its number of buckets; a new one gets one per
        BUCKET_BYTES of landed feedback."""
        n = self.s.buckets
        if n is None and self.exists("raw", "customer_feedback"):
            described = self.spark.sql(f"DESCRIBE EXTENDED {self.name('raw', 'customer_feedback')}")
            found = described.filter("col_name = 'Num Buckets'").head()
            n = int(found.data_type) if found else 0
        if n is None:
            n = buckets_for(landed_bytes(self.spark, f"{self.s.landing_dir}/customer_feedback.csv"))
        return (n, "feedback_id") if n else None

    def name(self, layer: str, table: str) -> str:
        return f"{self.db[layer]}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def replace(self, df: DataFrame, table: str, **kw) -> DataFrame:
        """Write a mart in full, counting its row checks on the way."""
        watch = quality.Watch()
        written = replace_table(
            watch.on(df, [c for c in self.s.declared if c.table == f"marts.{table}"]), self.name("marts", table), **kw
        )
        self.counted |= watch.counts()
        return written

    # -- Bronze

    def load(self, truncate: bool = False) -> dict[str, int]:
        inputs = landing.read_all(self.spark, self.s.landing_dir)
        truncate = truncate if self.s.truncate is None else self.s.truncate
        if truncate:  # what followed the rows that are replaced starts again
            for layer, log in (("raw", KEY_LOG), ("marts", SPEND_LOG)):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, log)}")
        return {
            t: landing.land(
                df, self.name("raw", t), truncate,
                self.by_feedback if t == "customer_feedback" else None,
            )
            for t, df in inputs.items()
        }

    # -- enrichment

    def cache(self) -> enr.Layers:
        """The cache as it is now, base and deltas."""
        cached = cache_files.open_cache(self.spark, self.s.cache_path)
        if self.s.keep_cache:
            return cached
        return cached.plus(cache_files.open_cache(self.spark, self.new_records))

    def catalog(self) -> DataFrame:
        catalog = staging.campaign_catalog(*[self.table("raw", t) for t in AD_TABLES])
        return materialize(catalog, "campaign-catalog")

    def keys(self) -> DataFrame:
        """(feedback_id, content_hash). Texts are hashed once: only Bronze rows newer
        than the key log are read, and appended to it."""
        feedback = self.table("raw", "customer_feedback")
        if self.s.limit:
            feedback = feedback.orderBy("feedback_id").limit(self.s.limit)
            return materialize(enr.feedback_keys(feedback), "feedback-keys")
        if self.exists("raw", KEY_LOG):
            feedback = incremental.newer_rows(feedback, self.table("raw", KEY_LOG), "_loaded_at")
        append_table(enr.hashed_keys(feedback), self.name("raw", KEY_LOG), self.by_feedback)
        return materialize(enr.newest_keys(self.table("raw", KEY_LOG)), "feedback-keys")

    def enrich(self) -> dict[str, int]:
        """Enrich unseen texts and log the rows that changed. The counts of hits and
        misses are those before enriching, the outcomes those after it."""
        keys = self.keys()
        before = enr.run_summary(keys, self.cache(), self.s.model).head().asDict()
        if self.s.enricher and before["to_enrich"]:
            enrich_in_rounds(
                self.table("raw", "customer_feedback"), keys, self.cache, self.catalog(), self.s.model,
                self.s.enricher, self.new_records, self.s.batch_size, self.s.rounds,
            )
        cached = self.cache()
        known = self.exists("raw", ENRICHED_LOG)
        if known and "_replaced" not in self.table("raw", ENRICHED_LOG).columns:
            kinds = ", ".join(f"{c}: {'double' if c == 'resolution_confidence' else 'string'}" for c in maintained.COUNTED)
            self.spark.sql(f"ALTER TABLE {self.name('raw', ENRICHED_LOG)} ADD COLUMNS (_replaced struct<{kinds}>)")
        log = self.table("raw", ENRICHED_LOG) if known else None
        last = log.agg(F.max("_enriched_at")).head()[0] if known else None
        if last is not None and last >= self.s.run_ts:
            raise ValueError(f"run_ts has to be later than the last run's, {last}")
        rows = enr.assemble(keys, cached, self.s.model, self.run_ts, log, maintained.COUNTED)
        if last is not None:
            # The log is read and appended to in one run: write the new rows out first.
            rows = materialize(rows.filter(F.col("_enriched_at") > F.lit(last)), "feedback-enriched")
        append_table(rows.select(*ENRICHED_COLUMNS, "_replaced"), self.name("raw", ENRICHED_LOG), self.by_feedback)
        in_bronze = None if self.s.limit else self.name("raw", KEY_LOG)
        self._current_view("raw", "feedback_enriched", ENRICHED_LOG, "_enriched_at", in_bronze)
        after = enr.run_summary(keys, cached, self.s.model).head().asDict()
        return {**after, "cache_hits": before["cache_hits"], "to_enrich": before["to_enrich"]}

    def compact(self) -> None:
        """Fold the cache's deltas into its base when they are many."""
        if cache_files.fold_due(self.spark, self.s.cache_path, self.s.compact_above):
            cache_files.fold(self.spark, self.s.cache_path)

    def compact_log(self, layer: str, log: str, column: str) -> None:
        """Keep the live version of each key in a log of `COMPACTED`. A failure leaves the
        log before or the new one, whole; the next run ends the swap."""
        live = incremental.current_rows(self.table(layer, log), "feedback_id", column)
        swap_table(live, self.name(layer, log), self.by_feedback)

    def compact_slices(self, most_files: int = 100) -> list[str]:
        """Rewrite the months of the slice log that lie in more files than that, each by its
        own rows: what was replaced goes. The log is made of others: dropped, it is laid out
        anew by the next build, which is the way back should a rewrite be stopped midway."""
        table = self.name("marts", SLICE_LOG)
        in_month = Counter(PurePosixPath(f).parent.name.removeprefix("month=") for f in self.spark.table(table).inputFiles())
        months = sorted(unquote(m) for m, n in in_month.items() if n > most_files)
        if months:
            rows = materialize(slices.netted(self.spark.table(table).filter(F.col("month").isin(months))), "slices-netted")
            replace_partitions(rows, table, "month", slices.CLUSTER)
        return months

    # -- Silver: lazy views over Bronze

    def staged(self) -> dict[str, DataFrame]:
        frames = {f"stg_{t}": staging.stage_ads(self.table("raw", t)) for t in AD_TABLES}
        frames["stg_customer_feedback"] = staging.stage_feedback(self.table("raw", "customer_feedback"))
        frames["stg_feedback_enriched"] = staging.stage_enriched(self.table("raw", "feedback_enriched"))
        for name, df in frames.items():
            df.createOrReplaceTempView(f"{self.s.prefix}{name}")
        return frames

    # -- Gold

    def build_spend(self, staged: dict[str, DataFrame]) -> None:
        """Spend marts. After an append only the new Bronze rows are read: they are added
        to the facts, the months they fall in are summed anew by day, and lifetime figures
        come from the states of all loads. Replaced Bronze is read in full."""
        spend = marts.fct_ad_spend(*[staged[f"stg_{t}"] for t in AD_TABLES], extra=["_loaded_at"])
        spend = spend.withColumn("month", F.date_format("date", "yyyy-MM"))
        known, table = self.exists("marts", SPEND_LOG), self.name("marts", "fct_ad_spend")
        if known:
            # A run may have stopped between facts and states: rows newer than the states,
            # in few files by their statistics, are there already.
            counted = F.lit(self._mark("marts", SPEND_LOG, "_loaded_at"))
            there = self.table("marts", "fct_ad_spend").filter(F.col("_loaded_at") > counted)
            mark = there.agg(F.coalesce(F.max("_loaded_at"), counted)).head()[0]
            save(spend.filter(F.col("_loaded_at") > F.lit(mark)), table, "append", partition_by="month")
            late = materialize(self.table("marts", "fct_ad_spend").filter(F.col("_loaded_at") > counted), "spend-increment")
        else:
            late = self.replace(spend, "fct_ad_spend", partition_by="month")
        months = [r.month for r in late.select("month").distinct().collect()]  # of the new rows
        days = self.table("marts", "fct_ad_spend").filter(F.coalesce(F.col("month"), F.lit("")).isin([m or "" for m in months]))
        daily = marts.fct_channel_daily(days).withColumn("month", F.date_format("date", "yyyy-MM"))
        if known:
            replace_partitions(daily, self.name("marts", "fct_channel_daily"), "month")
        else:
            self.replace(daily, "fct_channel_daily", partition_by="month")
        as_of = late.agg(F.max("_loaded_at")).head()[0]
        if as_of is not None or not known:
            states = maintained.spend_states(late).withColumn("_loaded_at", F.lit(as_of).cast("timestamp_ntz"))
            append_table(states, self.name("marts", SPEND_LOG))
        states = self.table("marts", SPEND_LOG)
        self.replace(maintained.campaign_summary(states), "fct_campaign_summary")
        self.replace(marts.dim_campaigns(states), "dim_campaigns")

    def build_feedback(self, staged: dict[str, DataFrame]) -> None:
        """Facts, themes and sums take only enriched rows newer than themselves."""
        log = FACT_LOG
        enriched = staged["stg_feedback_enriched"]
        if self.exists("marts", log):
            enriched = incremental.newer_rows(enriched, self.table("marts", log), "_enriched_at")
        facts = marts.fct_feedback(enriched, staged["stg_customer_feedback"])
        append_table(facts, self.name("marts", log), self.by_feedback)
        self._current_view("marts", "fct_feedback", log, "_enriched_at")
        self._append_themes()
        self._append_sums()
        self._append_slices()
        performance = maintained.campaign_performance(self.table("marts", "fct_campaign_summary"), self.sums("voice"))
        self.replace(performance, "fct_campaign_performance")

    def _mark(self, layer: str, log: str, column: str) -> datetime:
        """Up to where a log has counted, as a value that reaches the scans."""
        newest = self.table(layer, log).agg(F.max(column)).head()[0]
        return newest or datetime.fromisoformat(WATERMARK_FLOOR)

    def _versions(self, layer: str, log: str, column: str) -> DataFrame:
        """Enriched rows that `log` has not taken: the live ones at first, then all
        newer versions."""
        versions = self.table("raw", ENRICHED_LOG)
        if self.exists(layer, log):
            return versions.filter(F.col("_enriched_at") > F.lit(self._mark(layer, log, column)))
        return incremental.current_rows(versions, "feedback_id", "_enriched_at").drop("_replaced")

    def _append_themes(self) -> None:
        """Themes of each version in a log; the mart shows those of live versions."""
        new = staging.stage_enriched(self._versions("marts", THEME_LOG, "_enriched_at"))
        append_table(marts.fct_feedback_themes(new, ["_enriched_at"]), self.name("marts", THEME_LOG), self.by_feedback)
        table = self.name("marts", "fct_feedback_themes")
        if self.exists("marts", "fct_feedback_themes") and self.spark.catalog.getTable(table).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {table}")  # of a build before there was a log
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {table} AS
            SELECT surrogate_key, feedback_id, theme FROM {self.name("marts", THEME_LOG)}
            LEFT SEMI JOIN (SELECT feedback_id AS _id, _enriched_at AS _at FROM {self.name("raw", "feedback_enriched")})
              ON feedback_id = _id AND _enriched_at = _at""")

    def _append_sums(self) -> None:
        for kind, log in SUM_LOGS.items():
            new = materialize(self._versions("marts", log, "as_of"), "sum-increment")
            append_table(getattr(maintained, f"{kind}_sums")(maintained.changes(new)), self.name("marts", log))

    def _append_slices(self) -> None:
        """Facts newer than the slice log, clustered by date and channel."""
        facts, enriched = self.table("marts", FACT_LOG), self.table("raw", ENRICHED_LOG)
        since, replaced = None, True
        if self.exists("marts", SLICE_LOG):
            since = F.lit(self._mark("marts", SLICE_LOG, "_enriched_at"))
            enriched_since = enriched.filter(F.col("_enriched_at") > since)
            replaced = not enriched_since.filter(F.col("_replaced").isNotNull()).isEmpty()
            enriched = enriched if replaced else enriched_since
        rows = materialize(slices.signed_rows(facts, enriched, since, replaced), "slice-increment")
        append_clustered(rows, self.name("marts", SLICE_LOG), "month", slices.CLUSTER)

    def sums(self, kind: str) -> DataFrame:
        """The totals of one kind (voice, theme, confidence) over live enriched rows."""
        return maintained.total(self.table("marts", SUM_LOGS[kind]), getattr(maintained, f"{kind.upper()}_KEYS"))

    def _current_view(self, layer: str, view: str, log: str, column: str, of: str | None = None) -> None:
        """The newest row per id; with `of`, of the ids that this table still has."""
        columns = ", ".join(c for c in self.table(layer, log).columns if c != "_replaced")
        present = f"AND feedback_id IN (SELECT feedback_id FROM {of})" if of else ""
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {self.name(layer, view)} AS
            SELECT {columns} FROM (
              SELECT *, row_number() OVER (PARTITION BY feedback_id ORDER BY {column} DESC) AS n
              FROM {self.name(layer, log)})
            WHERE n = 1 {present}""")

    # -- history

    def snapshot(self) -> None:
        """Append what has changed since the last snapshot, by the enriched log alone:
        its new versions carry what they replace."""
        log = "feedback_enrichment_log"
        if self.exists("snapshots", log):
            since = F.lit(self._mark("snapshots", log, "valid_from"))
            versions = self.table("raw", ENRICHED_LOG).filter(F.col("_enriched_at") > since)
            rows = materialize(history.changed_by_log(versions, self.run_ts), "snapshot-changes")
        else:
            source = self.table("raw", "feedback_enriched")
            rows = history.first_versions(source, "feedback_id", SNAPSHOT_CHECKS, self.run_ts)
        append_table(rows, self.name("snapshots", log), self.by_feedback)
        token = KEY_NULL_TOKEN
        parts = ", ".join(f"coalesce(cast({c} as string), '{token}')" for c in ("feedback_id", "valid_from"))
        columns = ", ".join(["feedback_id", *SNAPSHOT_CHECKS, "valid_from"])
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {self.name("snapshots", "feedback_enrichment_snapshot")} AS
            SELECT *, md5(concat_ws('{KEY_SEPARATOR}', {parts})) AS version_key, valid_to IS NULL AS is_current
            FROM (SELECT {columns}, lead(valid_from) OVER (PARTITION BY feedback_id ORDER BY valid_from) AS valid_to
                  FROM {self.name("snapshots", log)})""")

    def history(self) -> DataFrame:
        return history.with_validity(self.table("snapshots", "feedback_enrichment_log"))

    # -- checks and exports

    def check(self, staged: dict[str, DataFrame]) -> None:
        """Raise unless every declared check and the precision gate pass."""
        if self.s.declared:
            tables = {f"staging.{n}": df for n, df in staged.items()}
            for c in self.s.declared:
                for full in filter(None, (c.table, c.parent)):
                    layer, table = full.split(".")
                    if layer != "staging":
                        tables[full] = self.table(layer, table)
            report = quality.quality_report(tables, self.s.declared, self.counted)
            quality.require_clean(materialize(report, "quality"))
        failed = quality.precision_failures(
            self.table("marts", "fct_feedback"), staged["stg_customer_feedback"]
        ).head()
        if failed is not None:
            raise quality.QualityError(f"resolution precision {failed.precision:.4f}")


def run_pipeline(spark: SparkSession, settings: Settings) -> dict:
    """Load, enrich, build, snapshot, check, export. Raises QualityError when a
    declared check fails; nothing is exported then."""
    mark = scratch_mark()
    try:
        return _run_pipeline(spark, settings)
    finally:
        clear_scratch(spark, mark)


def _run_pipeline(spark: SparkSession, settings: Settings) -> dict:
    run = Run(spark, settings)
    loaded = run.load(truncate=True)
    summary = run.enrich()
    staged = run.staged()
    run.build_spend(staged)
    run.build_feedback(staged)
    run.snapshot()
    run.check(staged)
    exported = {}
    if settings.export_dir:
        exported = export_marts(spark, run.db["marts"], settings.export_dir)
    if settings.keep_cache:
        run.compact()
    return {"loaded": loaded, "summary": summary, "exported": exported}


def enrich_in_rounds(
    feedback: DataFrame,
    keys: DataFrame,
    read_cache: Callable[[], enr.Cache],
    catalog: DataFrame,
    model: str,
    enricher: enr.Enricher,
    cache_path: str,
    batch_size: int = 100,
    rounds: int | None = None,
) -> None:
    """Enrich the misses in `rounds` slices of the hash space. Every slice is
    one distributed job whose records are in the cache before the next starts,
    so a run that stops is resumed by running again: only misses are left.

    Tasks put the answers of each batch into a ledger beside the cache before they go
    on. A retried task finds its batches there; what a stopped run has left there is
    taken into the cache first. A batch is sent twice only if its task ends between
    the answer and the note of it, or if two attempts of one task run at once (so keep
    speculation off). Where tasks cannot open the cache's file system without Spark,
    there is no ledger, and a retried task sends its batches again."""
    spark, folder = feedback.sparkSession, f"{cache_path}/{LEDGER}/{hashlib.md5(model.encode()).hexdigest()}"
    found = ledger_files.Ledger(ledger_files.uri(spark, folder))
    ledger = found if ledger_files.usable(found) else None

    def keep(answers: DataFrame) -> None:
        records = enr.new_cache_records(enr.normalize(answers, catalog), model)
        cache_files.append_cache(records, cache_path)
        files.remove(spark, folder)

    before = ledger_files.left_over(spark, folder)
    if before is not None:
        keep(before)
    if rounds is None:
        n_misses = enr.texts_to_enrich(keys, read_cache(), model).count()
        rounds = min(MAX_ROUNDS, max(1, -(-n_misses // (ROUND_BATCHES * batch_size))))
    for i in range(rounds):
        todo = enr.texts_to_enrich(keys, read_cache(), model)
        if rounds > 1:
            todo = todo.filter(F.pmod(F.xxhash64("content_hash"), F.lit(rounds)) == i)
        chosen = materialize(todo, "texts-to-enrich")
        n_texts = chosen.count()
        if n_texts == 0:
            continue
        texts = enr.enricher_input(feedback, chosen)
        partitions = enr.full_batches(n_texts, batch_size)
        keep(materialize(enr.run_enricher(texts, enricher, batch_size, partitions, ledger), "answers"))


def sentiment_page(run: Run, high_spend: float = HIGH_SPEND, k: int = TOP_THEMES, **slicers) -> dict[str, DataFrame]:
    """The customer-voice report views over the built marts. `slicers` (date_from,
    date_to, channels, campaigns) narrow every view of feedback rows, which then read that
    part of the slice log; without any, the views come from the kept sums and read no row."""
    performance = marts.served(run.table("marts", "fct_campaign_performance"))
    page = {
        "spend_vs_sentiment": views.spend_vs_sentiment(performance, high_spend),
        "sentiment_mix": views.sentiment_mix(performance),
    }
    if not any(slicers.values()):
        return page | _voice_views(run.sums("voice"), run.sums("theme"), run.sums("confidence"), k)
    rows = views.slice_feedback(run.table("marts", SLICE_LOG), **slicers)
    voice, themes = slices.sums(rows, "voice"), slices.sums(rows, "theme")
    return page | _voice_views(voice, themes, slices.sums(rows, "confidence"), k)


def _voice_views(voice: DataFrame, themes: DataFrame, confidences: DataFrame, k: int) -> dict[str, DataFrame]:
    return {
        "top_themes": maintained.top_themes(themes, k),
        "theme_counts": maintained.theme_counts(themes),
        "language_split": maintained.language_split(voice),
        "resolution_confidence": maintained.resolution_confidence(voice, confidences),
        "resolved_share": maintained.resolved_share(voice),
    }
