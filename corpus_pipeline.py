"""A corpus through its stages: each reads what the one before kept.

    run(spark, sf_dir)   applies STAGES to the table `documents`

A stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes it as
Parquet under the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendecho.llm import decontaminate, mixing, quality_rules, simhash, substring
from spendecho.llm.common import table, written


def _packed(docs: DataFrame, needed: list[str]) -> DataFrame:
    """The columns an operator needs, and all others as one, so that no name clashes."""
    rest = [c for c in docs.columns if c not in needed]
    return docs.select(*needed, *([F.struct(*rest).alias("_rest")] if rest else []))


def _unpacked(df: DataFrame, docs: DataFrame, needed: list[str]) -> list:
    return [df[c] if c in needed else df["_rest"][c].alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, by themselves and as part of their source."""
    needed = ["text", "source"]
    measured = written(quality_rules.measure(_packed(docs, needed)), "pipeline-measured")
    kept = quality_rules.judge(measured).filter("kept")
    return kept.select(*_unpacked(kept, docs, needed))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked fingerprints (three-word shingles, two bits)."""
    needed = ["doc_id", "text"]
    kept = simhash.first_of_groups(_packed(docs, needed))
    return kept.select(*_unpacked(kept, docs, needed))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; nothing left: no document."""
    needed = ["doc_id", "text", "n_chars"] if "n_chars" in docs.columns else ["doc_id", "text"]
    packed = _packed(docs, needed)
    cut = substring.deduplicate(packed, [c for c in packed.columns if c != "text"])
    cut = cut.filter("n_removed = 0 OR n_removed < n_words").withColumn("text", F.col("kept_text"))
    if "n_chars" in needed:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, changed).otherwise(F.col("n_chars")))
    return cut.select(*_unpacked(cut, docs, needed))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    packed = _packed(docs, ["text"])
    found = decontaminate.contaminated(packed, table(spark, sf_dir, "benchmark"), keep=packed.columns)
    found = found.filter("NOT contaminated")
    return found.select(*_unpacked(found, docs, ["text"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row per copy (`copy`, from 0) that it takes of a document, the
    last one perhaps cut to its first words. With it what the mix takes of the document
    in all (`repeats` whole copies and `extra_words` of its first words)."""
    needed = ["doc_id", "text", "source"]
    sized = written(mixing.sized(_packed(docs, needed)), "pipeline-sized")
    taken = mixing.mixed_texts(mixing.mix(sized))
    own = ["size", "source_size", "target", "repeats", "extra_words", "taken", "copy"]
    new = [F.col(c).alias(c if c not in docs.columns else f"mix_{c}") for c in own]
    mixed = taken.select(*_unpacked(taken, docs, needed), *new, F.expr("copy = repeats AND extra_words < size").alias("_cut"))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        mixed = mixed.withColumn("n_chars", F.when(F.col("_cut"), changed).otherwise(F.col("n_chars")))
    return mixed.drop("_cut")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("decontamination", benchmark_free),
    ("mixing", mix),
]

#: Stages have no SQL; they are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
