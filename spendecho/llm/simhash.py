"""SimHash fingerprints, and near duplicates by Golay-code fuzzy hashing.

`link` finds every pair of 64-bit fingerprints at 2 or fewer differing bits: the
fingerprint is three segments, so two errors leave one of them whole, and the
segment after it has at most two. The whole segment together with the Golay
indices near the next one are up to six keys a segment; fingerprints that share a
key are compared. Where more than `FULL` fingerprints share one, pairs are not
listed: each of them is tied to all words within one bit of it, and two
fingerprints differ in two bits or less exactly when they meet in such a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import discard, mapped, written
from .golay import nearby
from .graph import components

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and number of bits
FULL = 64
#: Shingles turned into bits at once.
STEP = 1 << 15


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64, seed 42, of each run of `shingle` lower-cased words, repeats included
    (fewer words: of the whole sequence; none: nothing)."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    edges = zip(starts, ends[min(shingle, len(found)) - 1 :].tolist())
    return np.fromiter((digest(line[a:b], 42) for a, b in edges), dtype=np.uint64)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), STEP):
        part = np.ascontiguousarray(h[at : at + STEP])
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits, signed; a bit is 1 if set in over half of the shingles' hashes."""
    h = shingle_hashes(text, shingle)
    return int(np.packbits(2 * bit_counts(h) > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int) -> DataFrame:
    """Columns `keep` of `docs` with `fp` of its `text`."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(x.as_py(), shingle) for x in batch.column(len(keep))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], [*keep, "fp"])

    return mapped(docs.select(*keep, F.col("text").alias("_text")), run, schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy().view(np.uint64)
        part = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        for i in range(len(SEGMENTS)):
            j = (i + 1) % len(SEGMENTS)
            near = nearby(part[j], SEGMENTS[j][1])
            row, column = np.nonzero(near >= 0)
            key = (np.int64(i) << 34) | (part[i][row] << 12) | near[row, column]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row].view(np.int64))], ["key", "fp"])


def link(fps: DataFrame, full: int = FULL) -> DataFrame:
    """Edges (a, b) among distinct fingerprints `fp`: their components are those of
    all links at 2 or fewer differing bits."""
    keys = written(mapped(fps.select("fp"), _keys, "key long, fp long"), "simhash-keys")
    shared = written(keys.groupBy("key").count().filter("count > 1"), "simhash-shared")
    few = keys.join(shared.filter(F.col("count") <= full).select("key"), "key")
    few = written(few, "simhash-candidates")
    a, b = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = a.join(b, "key").filter("a < b AND bit_count(a ^ b) <= 2").select("a", "b")
    many = keys.join(shared.filter(F.col("count") > full).select("key"), "key").select("fp").distinct()
    hubs = written(
        many.select("fp", F.explode(F.expr("transform(sequence(0, 64), i -> CASE WHEN i < 64 THEN fp ^ shiftleft(1L, i) ELSE fp END)")).alias("hub")),
        "simhash-hubs",
    )
    lows = hubs.groupBy("hub").agg(F.min("fp").alias("low"), F.count("*").alias("n")).filter("n > 1")
    met = hubs.join(lows, "hub").filter("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return pairs.union(met).distinct()


def grouped(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id that links reach from the row's
    fingerprint; NULL ids are passed over, and it is NULL if there is no other.
    NULL, empty and blank texts share fingerprint 0, which links like any other.
    Repeated rows share a component. An empty table gives an empty one.
    """
    known = written(fingerprints(docs, ["doc_id"], shingle), "simhash-fingerprints")
    nodes = written(known.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    roots = components(link(nodes)).withColumnRenamed("node", "fp")
    rooted = written(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return known.join(rooted.join(lowest, "root").select("fp", "component_id"), "fp")


def first_of_groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Of each group of linked fingerprints in `docs` (doc_id, text, any other columns)
    the row with the smallest doc_id, NULL last, then by the text's hash. Texts without
    words have fingerprint 0 and are one group with all that link to it. Of repeated
    rows one stays."""
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_order")
    rows = docs.select("*", order, F.xxhash64("text").alias("_key"))
    known = written(fingerprints(rows, ["_order", "_key"], shingle), "simhash-fingerprints")
    nodes = written(known.groupBy("fp").agg(F.min(F.struct("_order", "_key")).alias("first")), "simhash-nodes")
    roots = components(link(nodes)).withColumnRenamed("node", "fp")
    kept = nodes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = written(kept.select("first.*"), "simhash-kept")
    discard(known, nodes)
    one = F.row_number().over(Window.partitionBy("_order", "_key").orderBy(F.lit(0)))
    return rows.join(kept, ["_order", "_key"]).withColumn("_copy", one).filter("_copy = 1").select(*docs.columns)
