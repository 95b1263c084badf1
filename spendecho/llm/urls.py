"""URL filters: a sorted sweep over rule intervals, per reversed host.

A rule (host, path) covers a host with its subdomains and all paths that begin
with its path. A URL is looked up once per suffix of its host that has rules; in
that host, a rule is the interval of paths [path, path + 0xFF), so intervals are
nested or apart. Rules open and close in path order; the sweep carries the
innermost open rule, and a close event restores the one around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import written

BLOCK_ROWS = 1000
#: The rules of the registered query: fixed values.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "action string, host string, path string")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def reversed_host(host: Column) -> Column:
    """`a.example.org` as `org,example,a`: all of a domain sorts together."""
    return F.array_join(F.reverse(F.split(host, "\\.")), ",")


def _events(rules: DataFrame) -> DataFrame:
    """Per rule an open and a close event: (host_key, at, kind, rule, action, size),
    where a close event carries the rule around it, or NULLs."""
    key = F.encode("path", "utf-8")
    unique = rules.groupBy("host", "path").agg(F.min_by("action", F.when(F.col("action") == "block", 0).otherwise(1)).alias("action"))
    unique = unique.select(
        reversed_host(F.col("host")).alias("host_key"), "action", F.concat("host", "path").alias("rule"),
        F.length(F.concat("host", "path")).alias("size"), key.alias("opens"), F.concat(key, F.unhex(F.lit("FF"))).alias("closes"),
    )
    both = unique.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("closing"))
    both = both.withColumn("at", F.when(F.col("closing") == 0, F.col("opens")).otherwise(F.col("closes")))
    swept = Window.partitionBy("host_key").orderBy("at", F.col("closing").desc(), F.length("opens"))
    depth = F.sum(1 - 2 * F.col("closing")).over(swept.rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("depth", depth + F.col("closing"))
    # A rule at depth d lies in the last rule that opened at depth d - 1: each open
    # event is offered one level further down, and found by that level's rows.
    top = F.struct("rule", "action", "size")
    offered = both.filter("closing = 0").select("host_key", "at", (F.col("depth") + 1).alias("level"), F.lit(0).alias("asks"), top.alias("top"), "opens", F.lit(0).alias("closing"))
    asking = both.select("host_key", "at", F.col("depth").alias("level"), F.lit(1).alias("asks"), top.alias("own"), "opens", "closing")
    level = Window.partitionBy("host_key", "level").orderBy("opens", F.col("asks").desc()).rowsBetween(Window.unboundedPreceding, 0)
    nested = offered.unionByName(asking, allowMissingColumns=True).withColumn("around", F.last("top", ignorenulls=True).over(level))
    return nested.filter("asks = 1").select(
        "host_key", "at", F.lit(0).alias("kind"),
        F.when(F.col("closing") == 0, F.col("own")).otherwise(F.col("around")).alias("top"), "closing",
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`pages` with host, path, rule and verdict; the longest fitting rule (host and
    path together, then the longer host) wins, else `default`. Of two equal rules
    `block` holds. NULL and malformed urls fit no rule. Repeated pages and NULL ids
    are rows like any other; columns named like the new ones are replaced.
    """
    host, path = parts(F.col("url"))
    pages = pages.drop("host", "path", "rule", "verdict")
    numbered = written(pages.withColumns({"host": host, "path": path, "_row": F.monotonically_increasing_id()}), "url-pages")
    rules = written(rules.withColumn("host", F.translate("host", UPPER, LOWER)), "url-rules")
    labels = rules.agg(F.max(F.size(F.split("host", "\\.")))).first()[0] or 0

    # The suffixes of the host that are as short as some rule's host.
    split = F.split("host", "\\.")
    take = F.least(F.size(split), F.lit(labels))
    probes = numbered.filter((F.col("host") != "") & F.lit(labels > 0)).select(
        "_row", F.encode("path", "utf-8").alias("at"), F.explode(F.transform(F.sequence(F.lit(1), take), lambda i: F.slice(F.reverse(split), 1, i))).alias("_labels"),
    ).select("_row", "at", F.array_join("_labels", ",").alias("host_key"))
    per_host = rules.groupBy(reversed_host(F.col("host")).alias("host_key")).agg((2 * F.count("*")).alias("events"))
    probes = probes.join(per_host, "host_key")

    # A hot host is swept in salted blocks, each with all events of the host; a block
    # has at least eight times as many lookups as events.
    counts = probes.groupBy("host_key", "events").agg(F.count("*").alias("n"))
    salts = written(counts.select("host_key", F.ceil(F.col("n") / F.greatest(F.lit(block_rows), 8 * F.col("events"))).cast("int").alias("salts")), "url-salts")
    events = _events(rules).join(salts, "host_key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    lookups = probes.join(salts, "host_key").select("host_key", "at", F.lit(1).alias("kind"), "_row", F.pmod(F.xxhash64("_row"), F.col("salts")).cast("int").alias("salt"))
    sweep = Window.partitionBy("host_key", "salt").orderBy("at", "kind", F.col("closing").desc(), F.col("top.size")).rowsBetween(Window.unboundedPreceding, 0)
    # Wrapped, so that a close event without a rule around it is not skipped as a NULL.
    rows = events.unionByName(lookups, allowMissingColumns=True)
    now = F.last(F.when(F.col("kind") == 0, F.struct("top")), ignorenulls=True).over(sweep)
    found = rows.withColumn("now", now).filter((F.col("kind") == 1) & F.col("now.top").isNotNull())
    best = found.groupBy("_row").agg(F.max(F.struct(F.col("now.top.size"), F.length("host_key").alias("host_size"), F.col("now.top.rule"), F.col("now.top.action"))).alias("best"))
    judged = numbered.join(best, "_row", "left")
    return judged.select(
        *[c for c in numbered.columns if c != "_row"], F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
