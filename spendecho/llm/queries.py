"""The corpus operators as registered queries: whole tables in, digest rows out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chats, codes, decontaminate, langid, licenses, merkle, mixing, ppm, quality_rules, ranking, simhash, substring, urls
from .common import small, table, written
from .oracle import ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _remainder(n: int):
    """crc32 of doc_id as text, modulo n; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


@query
def op1_mix(spark, sf_dir):
    docs = mixing.sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    return mixing.mix(written(docs, "mix-sizes")).drop("source")


@query
def op2_quality(spark, sf_dir):
    measured = quality_rules.measure(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return quality_rules.judge(written(measured.drop("text"), "quality-features")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rule_table(spark, urls.RULES)).drop("url")


@query
def op3_simhash(spark, sf_dir):
    found = simhash.grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op4_decontaminate(spark, sf_dir):
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op5_licenses(spark, sf_dir):
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"]))


@query
def op10_ranking(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = _remainder(3) == 1
    model = ranking.train(docs, labels, "quality", ~held_out)
    return ranking.score(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_substring(spark, sf_dir):
    return substring.deduplicate(table(spark, sf_dir, "documents"), ["doc_id"]).drop("kept_text")


@query
def op7_language(spark, sf_dir):
    docs, held_out, vocab = table(spark, sf_dir, "documents"), _remainder(5) == 0, langid.vocabulary()
    model = langid.train(docs, ~held_out, vocab)
    return langid.predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op6_ppm(spark, sf_dir):
    held_out = _remainder(5) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return ppm.score(docs, ~F.col("held_out"), ["doc_id", "held_out"])


@query
def op12_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    fields = {c: F.col(c) for c in merkle.FIELDS}
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(_remainder(5) == 0, merkle.leaf(fields | {"text": lowered})).otherwise(F.col("leaf"))
    leaves = docs.withColumn("leaf", merkle.leaf(fields)).select("doc_id", "source", "leaf", claimed.alias("claimed"))
    tree = merkle.build(written(leaves, "merkle-leaves"), "source", "doc_id")
    if tree is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    found = tree.proofs().withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op11_codes(spark, sf_dir):
    found = codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), ["vec_id", "label"])
    by_label = written(found.rows.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    by_label = by_label.withColumnRenamed("label", "_label")
    joined = found.rows.join(small(by_label), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256")
    )


@query
def op13_chats(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chats.digest(chats.pack(turns.unionByName(more)))
