"""Quality rules: per document, and per host with rates shrunk by an empirical beta prior.

All features are expressions over one text; only narrow rows are grouped by host.
NULL, empty and blank texts have no words and fail; texts of any length are one row.
Ties at a limit keep the host; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import words, written

MIN_WORDS = 50
#: A host is rejected if its shrunk failure rate of a rule is above HOST_LIMIT, or if the
#: rate is, to some 99 %, above both HOST_FLOOR and HOST_FACTOR times that of all documents.
HOST_LIMIT = 0.5
HOST_FLOOR, HOST_FACTOR, HOST_SURE = 0.15, 2.0, 2.33
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "3 * n_dup_lines > n_lines",
}
#: Rules by which a document is rejected on its own.
BASE_RULES = ("short", "repeats")


def measure(docs: DataFrame) -> DataFrame:
    """`docs` with the features of each whole text and `base_failed`.

    A window of three words is known by its 64-bit hash; windows are only compared
    within one text. NULL and blank texts have no words and fail.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\f\r")) != "")
    d = docs.withColumns({"_w": words(F.col("text")), "_l": lines}).withColumn("n_words", F.size("_w").cast("long"))
    windows = """CASE WHEN n_words >= 3 THEN sort_array(transform(sequence(0, size(_w) - 3),
        i -> struct(xxhash64(_w[i], _w[i + 1], _w[i + 2]) AS h, i AS i))) END"""
    d = d.withColumns({
        "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_t": F.expr(windows),
    }).drop("_w", "_l")
    found = """sort_array(transform(filter(_t, (x, j) ->
        coalesce(get(_t, j - 1).h = x.h, false) OR coalesce(get(_t, j + 1).h = x.h, false)), x -> x.i))"""
    d = d.withColumn("_p", F.expr(found)).drop("_t")
    covered = "aggregate(transform(_p, (p, j) -> least(3, coalesce(get(_p, j + 1) - p, 3))), 0L, (a, x) -> a + x)"
    d = d.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0)).cast("long")).drop("_p")
    return d.withColumn("base_failed", F.expr(" OR ".join(RULES[r] for r in BASE_RULES)))


def rejected_hosts(measured: DataFrame, host: Column, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, rules): hosts of which a rule's shrunk failure rate is above `limit`, or
    surely far above that of other hosts (a normal bound on the beta posterior).
    Hosts that all fail alike are alike by every rule, and none of them is rejected.

    The beta prior of a rule has the mean and the spread of the hosts' rates beyond
    what sampling explains (method of moments), so a host with few documents is
    pulled to the usual rate. Documents without a host are not judged by host.
    """
    counts = measured.filter(host.isNotNull()).groupBy(host.alias("host")).agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(sql)).alias(rule) for rule, sql in RULES.items()]
    )
    names = ", ".join(f"'{r}', {r}" for r in RULES)
    rates = written(counts.select("host", "n", F.expr(f"stack({len(RULES)}, {names}) AS (rule, failed)")), "host-rates")
    prior = rates.groupBy("rule").agg(
        F.sum("n").alias("docs"), F.count("*").alias("hosts"),
        (F.sum("failed") / F.sum("n")).alias("mean"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares"),
    )
    noise = F.col("mean") * (1 - F.col("mean"))
    spread = (F.col("squares") - F.col("mean") * F.col("mean") * F.col("docs") - noise * (F.col("hosts") - 1)) / F.col("docs")
    strength = F.when(spread <= 0, F.lit(1e6)).otherwise(F.least(F.greatest(noise / spread - 1, F.lit(1.0)), F.lit(1e6)))
    prior = prior.select("rule", "mean", strength.alias("strength"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    least = shrunk - HOST_SURE * F.sqrt(shrunk * (1 - shrunk) / (F.col("n") + F.col("strength") + 1))
    usual = F.greatest(F.lit(HOST_FLOOR), HOST_FACTOR * F.col("mean"))
    over = rates.join(prior, "rule").filter((shrunk > limit) | (least > usual))
    return over.groupBy("host").agg(F.sort_array(F.collect_set("rule")).alias("rules"))


def judge(measured: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """`measured`, a written table of `measure`, with `kept`: the document keeps
    the base rules and its host is not rejected. Repeated rows are judged alike."""
    bad = rejected_hosts(measured, F.col(host), limit).select(F.col("host").alias("_host"))
    joined = measured.join(bad, F.col(host) == F.col("_host"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("_host").isNull()).drop("_host")
