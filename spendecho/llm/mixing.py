"""Mixing sources to target weights, in blocks of equal numbers of words.

Water-filling turns weights into a word target per source (`targets`). The
targets are votes in a Sainte-Lague apportionment of equal blocks (`apportion`):
blocks go to the highest quotients target / (2k - 1). A source's blocks are
apportioned again over its shards, by words. A shard lays its documents end to
end in a seeded order, cuts that stream into blocks, and takes as many blocks as
its quota from the front, starting again at its end (`mix`).

Shares are rounded to whole blocks. A source whose target is under about half a
block gets no seat and none of its words are taken; its seats go to others. So the
words of very many sources of a few words each are left out.

No step needs all rows together: sources are ranked by a range sort, and only quotients
that can decide a seat are ever listed (about four per source), so the number of blocks
costs nothing. Rows of one id are in one shard, and a source has at most `MAX_SHARDS`;
a shard that is large for either reason is laid end to end by a range sort over several
tasks, which gives the same ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import running_totals, words, written

BLOCK_WORDS = 8
SHARD_WORDS = 1 << 18
MAX_SHARDS = 4096
LARGE_ROWS, LARGE_WORDS = 1 << 16, 1 << 21  # of a shard that one task does not lay alone
MAX_REPEATS = 3
SEED = "mix-1"
HEX = "0123456789abcdef"


def cycled_weights(totals: DataFrame, cycle: int = 3) -> DataFrame:
    """`totals` with weight 1, 2, .., cycle, 1, ..: by source, code point order, NULL last."""
    ranked = running_totals(totals, [F.col("source").asc_nulls_last()], {"_rank": F.lit(1)}, "mix-ranked")
    return ranked.withColumn("weight", (F.col("_rank") % cycle + 1).cast("long")).drop("_rank")


def targets(totals: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight) with `target`: shares of all words by weight,
    stopped at `max_repeats` times a source's size, the excess shared again by
    weight among the others until none is above. Empty sources get 0."""
    cap = F.col("source_size") * max_repeats
    ordered = written(
        running_totals(
            totals, [cap / F.col("weight"), F.col("source").asc_nulls_last()],
            {"_caps": cap, "_weights": F.col("weight")}, "mix-levels",
        ),
        "mix-levels",
    )
    words_, weights = ordered.agg(F.sum("source_size"), F.sum("weight")).first()
    words_, weights = words_ or 0, weights or 0
    left, over = F.lit(words_) - F.col("_caps"), F.lit(weights) - F.col("_weights")
    level = F.col("weight") * left.cast("double") / over.cast("double")
    open_ = (
        ordered.filter(cap.cast("double") > level)
        .orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
        .select(left.alias("left"), over.alias("over")).first()
    )
    if open_ is None:
        share = cap.cast("double")
    else:
        share = F.least(
            cap.cast("double"),
            F.col("weight") * F.lit(open_.left).cast("double") / F.lit(open_.over).cast("double"),
        )
    return ordered.withColumn("target", share).drop("_caps", "_weights")


def _seat_range(share: Column, seats: Column, parties: Column) -> tuple[Column, Column]:
    """Seats that a party surely gets, and the most that it can get. Rounding of
    votes / divisor misses `seats` by at most half a seat per party, so the right
    divisor lies between those for half a seat per party less and more."""
    low = F.floor(share * (seats - parties / 2 - 1) - 0.5)
    high = F.ceil(share * (seats + parties / 2 + 1) + 0.5)
    return F.greatest(low, F.lit(0)).cast("long"), F.greatest(high, F.lit(1)).cast("long")


def apportion(votes: DataFrame, seats: int) -> DataFrame:
    """(source, target) with `quota`: seats by highest quotients target / (2k - 1),
    ties to the source that comes first (code points, NULL last)."""
    total, parties = votes.filter("target > 0").agg(F.sum("target"), F.count("*")).first()
    if not total or seats <= 0:
        return votes.withColumn("quota", F.lit(0).cast("long"))
    sure, most = _seat_range(F.col("target") / F.lit(total), F.lit(float(seats)), F.lit(float(parties)))
    ranged = written(votes.filter("target > 0").select("source", "target", sure.alias("sure"), most.alias("most")), "mix-seats")
    open_ = seats - ranged.agg(F.sum("sure")).first()[0]
    listed = ranged.select("source", "target", F.explode(F.sequence(F.col("sure") + 1, F.col("most"))).alias("k"))
    listed = listed.withColumn("quotient", F.col("target") / (2 * F.col("k") - 1))
    order = [F.col("quotient").desc(), F.col("source").asc_nulls_last(), F.col("k")]
    won = running_totals(listed, order, {"_before": F.lit(1)}, "mix-quotients").filter(F.col("_before") < open_)
    won = won.groupBy("source").agg(F.count("*").alias("won"))
    a, b, c = votes.alias("a"), ranged.alias("b"), won.alias("c")
    return (
        a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left")
        .join(c, F.col("a.source").eqNullSafe(F.col("c.source")), "left")
        .select("a.*", (F.coalesce("b.sure", F.lit(0)) + F.coalesce("c.won", F.lit(0))).alias("quota"))
    )


def _shard_quotas(shards: DataFrame) -> DataFrame:
    """(source, shard, shard_words, quota) with `blocks`: the source's quota over
    its shards by the same rule. A source has at most MAX_SHARDS shards."""
    mine = Window.partitionBy("source")
    share = F.col("shard_words") / F.sum("shard_words").over(mine)
    sized = shards.filter("shard_words > 0").withColumns({"_share": share, "_n": F.count("*").over(mine)})
    sure, most = _seat_range(F.col("_share"), F.col("quota").cast("double"), F.col("_n").cast("double"))
    sized = sized.withColumns({"_sure": sure, "_most": most})
    sized = sized.withColumn("_open", F.col("quota") - F.sum("_sure").over(mine))
    listed = sized.withColumn("_k", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
    listed = listed.withColumn("_q", F.col("shard_words") / (2 * F.col("_k") - 1))
    place = F.row_number().over(mine.orderBy(F.col("_q").desc(), "shard", "_k"))
    return (
        listed.withColumn("_won", (place <= F.col("_open")).cast("long"))
        .groupBy("source", "shard", "shard_words", "_sure").agg(F.sum("_won").alias("_won"))
        .select("source", "shard", "shard_words", (F.col("_sure") + F.col("_won")).alias("blocks"))
    )


def _laid_apart(dealt: DataFrame, order: list) -> DataFrame:
    """`dealt` with `_end`, the words of its shard up to it: from totals over a range sort
    of all shards, less what lies before the shard's first row."""
    totals = running_totals(dealt, [F.col("source").asc_nulls_last(), "_shard", *order], {"_before": F.col("size")}, "mix-large")
    starts = totals.groupBy("source", "_shard").agg(F.min("_before").alias("_start"))
    a, b = totals.alias("a"), starts.alias("b")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a._shard") == F.col("b._shard"))
    end = F.col("_before") - F.col("_start") + F.col("size")
    return a.join(b, same).select("a.*", end.alias("_end")).drop("_before")


def sized(docs: DataFrame) -> DataFrame:
    """`docs` with `size`: words of the text; 0 for NULL or blank text."""
    return docs.withColumn("size", F.size(words(F.col("text"))).cast("long"))


def mix(
    docs: DataFrame, *, cycle: int = 3, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
    max_repeats: int = MAX_REPEATS, seed: str = SEED,
) -> DataFrame:
    """Rows of `docs` (doc_id, source, size and any other columns) with
    `source_size`, `target`, `repeats` (times the whole document is taken),
    `extra_words` (of its first words, taken once more) and `taken`.

    No document is taken more than `max_repeats` times. A NULL source is a source.
    Documents of size 0, NULL ids and repeated rows are rows like any other; rows
    equal in id and size may swap their shares. An empty table gives an empty one. It
    is read several times and has to come from files or other rows of a fixed order.
    Columns whose names begin with an underscore are kept for this function.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    digit = [F.instr(F.lit(HEX), F.substring("_order", i, 1)) - 1 for i in (1, 2, 3)]
    bucket = (digit[0] * 256 + digit[1] * 16 + digit[2]).cast("long")
    docs = docs.withColumn("_order", digest).withColumn("_bucket", bucket)
    counted = [F.sum("size").alias("words"), F.count("*").alias("rows")]
    buckets = written(docs.groupBy("source", "_bucket").agg(*counted), "mix-buckets")
    totals = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    aims = written(targets(cycled_weights(totals, cycle), max_repeats), "mix-targets")
    total = aims.agg(F.sum("source_size")).first()[0] or 0
    quotas = apportion(aims, (2 * total + block_words) // (2 * block_words))
    n = F.least(F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)), F.lit(MAX_SHARDS)).cast("long")
    quotas = written(quotas.select("source", "source_size", "target", "quota", n.alias("_shards")), "mix-quotas")

    a, b = buckets.alias("a"), quotas.alias("b")
    per_shard = written(
        a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")))
        .groupBy("a.source", (F.col("_bucket") % F.col("_shards")).alias("shard"), "quota")
        .agg(F.sum("words").alias("shard_words"), F.sum("rows").alias("rows")),
        "mix-sizes-of-shards",
    )
    large = (F.col("rows") > LARGE_ROWS) | (F.col("shard_words") > LARGE_WORDS)
    blocks = _shard_quotas(per_shard.drop("rows")).select("source", "shard", "blocks").alias("d")
    c = per_shard.alias("c")
    plan = written(
        c.join(blocks, F.col("c.source").eqNullSafe(F.col("d.source")) & (F.col("c.shard") == F.col("d.shard")), "left")
        .select("c.source", "c.shard", "c.shard_words", F.coalesce("d.blocks", F.lit(0)).alias("blocks"), large.alias("large")),
        "mix-shards",
    )

    def dealt(docs: DataFrame, shards: DataFrame) -> DataFrame:
        a, b, c = docs.alias("a"), quotas.alias("b"), shards.alias("c")
        shard = F.col("a._bucket") % F.col("b._shards")
        return (
            a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")))
            .join(c, F.col("a.source").eqNullSafe(F.col("c.source")) & (shard == F.col("c.shard")))
            .select(
                "a.*", "b.source_size", "b.target", shard.alias("_shard"), F.col("c.shard_words").alias("_words"),
                F.least(F.col("c.blocks") * block_words, F.col("c.shard_words") * max_repeats).alias("_take"),
            )
        )

    order = ["_order", F.col("doc_id").asc_nulls_last(), "size"]
    stream = Window.partitionBy("source", "_shard").orderBy(*order)
    end = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0))
    laid = dealt(docs, plan.filter(~F.col("large"))).withColumn("_end", end)
    if not plan.filter("large").isEmpty():
        numbered = docs.withColumn("_tie", F.monotonically_increasing_id())  # cuts rows of one id and size
        laid = laid.unionByName(_laid_apart(dealt(numbered, plan.filter("large")), [*order, "_tie"]).drop("_tie"))
    whole = F.expr("CASE WHEN _words > 0 THEN _take DIV _words ELSE 0 END")
    rest = F.expr("CASE WHEN _words > 0 THEN _take % _words ELSE 0 END")
    extra = F.greatest(F.least(F.col("_end"), rest) - (F.col("_end") - F.col("size")), F.lit(0))
    laid = laid.withColumns({"repeats": whole, "extra_words": extra})
    taken = (F.col("repeats") * F.col("size") + F.col("extra_words")).alias("taken")
    return laid.select("*", taken).drop("_order", "_bucket", "_shard", "_words", "_take", "_end")


def mixed_texts(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row per copy of a document, the last one perhaps cut
    to its first `extra_words` words, joined by spaces."""
    copies = mixed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("repeats") + F.signum("extra_words").cast("long"))))
    copies = copies.filter((F.col("copy") < F.col("repeats")) | ((F.col("copy") == F.col("repeats")) & (F.col("extra_words") > 0)))
    whole = (F.col("copy") < F.col("repeats")) | (F.col("extra_words") >= F.col("size"))
    part = F.array_join(F.slice(words(F.col("text")), 1, F.greatest(F.col("extra_words"), F.lit(1)).cast("int")), " ")
    return copies.withColumn("text", F.when(whole, F.col("text")).otherwise(part))
