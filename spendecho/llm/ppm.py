"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts, up to `ORDER` bytes, as tables that Spark
counts from all training texts: one row per context and next byte. In a context of
total N with D different next bytes, a byte seen n times has probability n / (N + D)
and the escape to the context shorter by one byte D / (N + D) (method C). There, the
bytes seen in the longer context are excluded. Below the empty context all bytes not
yet excluded are alike. A text begins in a context of pad bytes and ends with an end
symbol; neither byte occurs in UTF-8.

The probability of a byte depends on the last ORDER + 1 bytes (a gram) only, so each
different gram is worked out once, by joins of the trie's levels. Texts are scored in
one pass with the frequent grams, those of at least 1 / `FREQUENT` of all training
bytes, so at most `FREQUENT` rows are broadcast however large the corpus is. The rare
grams of each text are joined to the full table. The unigram base goes the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import mapped, written
from .tokens import LOWER, NOT_SPACE, Lookup, hashes, slices, spans

ORDER = 4
FREQUENT = 1 << 18
PAD, END = 0xFE, 0xFF
SYMBOLS = 255  # all bytes but the pad
#: Entries a task counts before it hands them on.
HELD = 1 << 21


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends in each byte and in each document's end symbol, with the document."""
    n = len(offsets) - 1
    room = np.full(len(data) + n * (ORDER + 1), PAD, dtype=np.uint8)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    at = np.arange(len(data)) + (ORDER + 1) * doc + ORDER
    room[at] = data
    last = offsets[1:] + (ORDER + 1) * np.arange(n) + ORDER
    room[last] = END
    total = room[: len(room) - ORDER].astype(np.int64) if len(room) > ORDER else np.zeros(0, np.int64)
    for j in range(1, ORDER + 1):
        total = (total << 8) | room[j : len(room) - ORDER + j]
    where = np.concatenate([at, last])
    return total[where - ORDER], np.concatenate([doc, np.arange(n)])


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, docs = spans(data, offsets, NOT_SPACE)
    return hashes(data, starts, ends).view(np.int64), docs


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, item, n) of the grams (0) and tokens (1) of some documents, in parts."""
    held: dict[int, list] = {0: [], 1: []}
    size = 0

    def merged(kind: int):
        items = np.concatenate([x[0] for x in held[kind]])
        times = np.concatenate([x[1] for x in held[kind]])
        items, where = np.unique(items, return_inverse=True)
        return items, np.bincount(where, times).astype(np.int64)

    def rows() -> Iterator[pa.RecordBatch]:
        for kind in held:
            if held[kind]:
                items, times = merged(kind)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(items), kind, np.int32)), pa.array(items), pa.array(times)], ["kind", "item", "n"])
            held[kind] = []

    for batch in batches:
        for _, data, offsets in slices(batch.column(0)):
            data = LOWER[data]
            for kind, items in ((0, _grams(data, offsets)[0]), (1, _tokens(data, offsets)[0])):
                held[kind].append(np.unique(items, return_counts=True))
                size += len(held[kind][-1][0])
            if size > 2 * HELD:
                held = {kind: [merged(kind)] if held[kind] else [] for kind in held}
                size = sum(len(x[0][0]) for x in held.values() if x)
                if size > HELD:
                    yield from rows()
                    size = 0
    yield from rows()


def _levels(grams: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """Per order, (gram, n) and (context, total, kinds, lower): lower is the total that
    the bytes seen in this context have in the context one byte shorter."""
    tables = {ORDER: grams}
    for order in range(ORDER - 1, -1, -1):
        short = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))
        tables[order] = written(tables[order + 1].groupBy(short.alias("gram")).agg(F.sum("n").alias("n")), f"ppm-grams-{order}")
    out = {}
    for order in range(ORDER, -1, -1):
        rows = tables[order].withColumn("context", F.shiftright("gram", 8))
        if order:
            below = tables[order - 1].select(F.col("gram").alias("short"), F.col("n").alias("below"))
            rows = rows.withColumn("short", F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))).join(below, "short")
        else:
            rows = rows.withColumn("below", F.lit(0).cast("long"))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("below").alias("lower"))
        out[order] = (tables[order], written(contexts, f"ppm-contexts-{order}"))
    return out


def unseen_scores(grams: DataFrame, levels: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(gram, logp) of grams that training lacks, by escapes with exclusion."""
    rows = grams.withColumns({"logp": F.lit(0.0), "done": F.lit(False), "kinds_up": F.lit(0).cast("long"), "lower_up": F.lit(0).cast("long")})
    for order in range(ORDER, -1, -1):
        table, contexts = levels[order]
        code = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))
        seen = table.select(F.col("gram").alias("code"), F.col("n").alias("seen"))
        contexts = contexts.withColumnRenamed("context", "near")
        rows = rows.withColumns({"code": code, "near": F.shiftright(code, 8)})
        rows = rows.join(seen, "code", "left").join(contexts, "near", "left")
        total, kinds = F.col("total") - F.col("lower_up"), F.col("kinds") - F.col("kinds_up")
        step = F.when(F.col("done") | F.col("total").isNull() | (kinds <= 0), 0.0).otherwise(
            F.log10(F.coalesce("seen", kinds) / (total + kinds))
        )
        rows = rows.select(
            "gram", (F.col("logp") + step).alias("logp"), (F.col("done") | F.col("seen").isNotNull()).alias("done"),
            F.coalesce("kinds", F.lit(0)).alias("kinds_up"), F.coalesce("lower", F.lit(0)).alias("lower_up"),
        )
    left = F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds_up"), F.lit(1)).cast("double"))
    return rows.select("gram", F.when(F.col("done"), F.col("logp")).otherwise(F.col("logp") - left).alias("logp"))


def _table(rows: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A frequent list as arrays."""
    found = rows.select(*names).toArrow()
    return found.column(names[0]).to_numpy(), found.column(names[1]).to_numpy()


PARTS = ("n_tokens long, n_frequent long, base double, logp double, "
         "rare_tokens array<long>, token_times array<int>, rare_grams array<long>, gram_times array<int>")


def _lists(items: np.ndarray, docs: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Per document, its different items and how often."""
    order = np.lexsort((items, docs))
    items, docs = items[order], docs[order]
    new = np.flatnonzero(np.concatenate([[True], (items[1:] != items[:-1]) | (docs[1:] != docs[:-1])])) if len(items) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(items))).astype(np.int32)
    bounds = pa.array(np.concatenate([[0], np.cumsum(np.bincount(docs[new], minlength=n))]), pa.int32())
    return pa.ListArray.from_arrays(bounds, pa.array(items[new])), pa.ListArray.from_arrays(bounds, pa.array(times))


def _scorer(frequent: Broadcast, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, tokens = (Lookup(*x) for x in frequent.value)
        for batch in batches:
            for first, data, offsets in slices(batch.column(len(keep))):
                data, n = LOWER[data], len(offsets) - 1
                codes, docs = _grams(data, offsets)
                hit, value = grams(codes)
                logp = np.bincount(docs[hit], value[hit], minlength=n)
                rare_grams = _lists(codes[~hit], docs[~hit], n)
                words, docs = _tokens(data, offsets)
                hit, value = tokens(words)
                base = np.bincount(docs[hit], value[hit], minlength=n)
                rare_words = _lists(words[~hit], docs[~hit], n)
                added = [
                    pa.array(np.bincount(docs, minlength=n) + 1, pa.int64()), pa.array(np.bincount(docs[hit], minlength=n), pa.int64()),
                    pa.array(base.astype(float)), pa.array(logp.astype(float)), *rare_words, *rare_grams,
                ]
                mine = [c.slice(first, n) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*mine, *added], [*keep, *[x.split()[0] for x in PARTS.split(", ")]])

    return run


def score(docs: DataFrame, training: Column, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with n_tokens, n_known, train_tokens, base_score and
    score (log10 probabilities of the whole text), learned from the texts for which
    `training` holds. NULL and empty texts are the end alone; repeated rows score
    alike and count again in training. Without training all bytes and the end are
    equally likely and the base is that of a count of 0 in an empty vocabulary."""
    spark = docs.sparkSession
    learned = docs.filter(training).select("text")
    counted = mapped(learned, _count, "kind int, item long, n long").groupBy("kind", "item").agg(F.sum("n").alias("n"))
    counted = written(counted, "ppm-counts")
    grams = written(counted.filter("kind = 0").select(F.col("item").alias("gram"), "n"), "ppm-grams")
    tokens = counted.filter("kind = 1").select(F.col("item").alias("token"), "n")
    ends = learned.count()
    n_tokens, vocab = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_tokens, vocab = n_tokens + ends, vocab + (ends > 0)
    size = n_tokens + 0.5 * (vocab + 1)
    base_of = lambda count: F.log10((count + 0.5) / F.lit(size))

    levels = _levels(grams)
    contexts = levels[ORDER][1].select("context", "total", "kinds")
    known = grams.withColumn("context", F.shiftright("gram", 8)).join(contexts, "context")
    known = written(known.select("gram", "n", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("logp")), "ppm-known")
    all_bytes = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    many = known.filter(F.col("n") * FREQUENT >= all_bytes)
    usual = tokens.filter(F.col("n") * FREQUENT >= n_tokens).withColumn("logp", base_of(F.col("n")))
    held = spark.sparkContext.broadcast((_table(many, ["gram", "logp"]), _table(usual, ["token", "logp"])))

    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(PARTS)])
    parts = mapped(docs.select(*keep, F.col("text").alias("_text")), _scorer(held, keep), schema)
    parts = written(parts.withColumn("_row", F.monotonically_increasing_id()), "ppm-parts")

    each = parts.select("_row", F.explode(F.arrays_zip("rare_grams", "gram_times")).alias("x"))
    each = each.select("_row", F.col("x.rare_grams").alias("gram"), F.col("x.gram_times").alias("times"))
    new = written(each.select("gram").distinct().join(known, "gram", "left_anti"), "ppm-new")
    table = written(known.select("gram", "logp").union(unseen_scores(new, levels)), "ppm-table")
    rare_grams = each.join(table, "gram").groupBy("_row").agg(F.sum(F.col("times") * F.col("logp")).alias("rare_logp"))

    each = parts.select("_row", F.explode(F.arrays_zip("rare_tokens", "token_times")).alias("x"))
    each = each.select("_row", F.col("x.rare_tokens").alias("token"), F.col("x.token_times").alias("times"))
    rare_tokens = each.join(tokens, "token", "left").groupBy("_row").agg(
        F.sum(F.col("times") * base_of(F.coalesce("n", F.lit(0)))).alias("rare_base"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).cast("long").alias("rare_known"),
    )
    rare_grams, rare_tokens = written(rare_grams, "ppm-rare-grams"), written(rare_tokens, "ppm-rare-tokens")
    zero = F.lit(0.0)
    return parts.select(*keep, "_row", "n_tokens", "n_frequent", "base", "logp").join(rare_grams, "_row", "left").join(rare_tokens, "_row", "left").select(
        *keep, "n_tokens",
        (F.col("n_frequent") + F.coalesce("rare_known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero) + base_of(F.lit(ends))).alias("base_score"),
        (F.col("logp") + F.coalesce("rare_logp", zero)).alias("score"),
    )
