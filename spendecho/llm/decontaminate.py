"""Benchmark decontamination with one Aho-Corasick automaton.

Test items and documents are normalised alike: A-Z lower-cased, words
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` joined by one space. The automaton holds every
window of `window` consecutive item words (all words of a shorter item), as numbers of
words, and scans each whole text once; hits are mapped back to words and to characters
of the original text.

Only the test set is gathered, a shard at a time. Its size is summed first: an automaton
takes about `MAX_CHARS` characters of items (ten nodes a word, some 100 MB). A larger set
is dealt over several, long items in overlapping parts; they scan one after the other and
add to the same hits. Rows are written between them, so that no stage, driver or executor
holds more than one.

NULL and empty texts have no words; a text of any length is scanned whole, its batch held
by a task. Windows that tie or overlap all count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import discard, mapped, written

WINDOW = 10
MAX_CHARS = 1_000_000

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def normalised(text: str | None) -> list[bytes]:
    """The words of a text; NULL has none."""
    return (text or "").encode().translate(_TABLE).split()


class Windows:
    """An automaton over word numbers; words that no item has are 0."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in normalised(text)]
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                owners.setdefault(tuple(words[i : i + n]), set()).add(item)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, value in owners.items():
            self.found.add_word(key, (len(key), value))
        self.any = bool(owners)
        if self.any:
            self.found.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [first, last] of window occurrences, by their end, and the items hit."""
        ranges, items = [], set()
        if self.any and words:
            for last, (n, owners) in self.found.iter(tuple(map(self.number.get, words, repeat(0)))):
                ranges.append((last - n + 1, last))
                items |= owners
        return ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered words."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def characters(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as [start, end) in characters of the original text."""
    raw = text.encode()
    spans = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
    return [(len(raw[: spans[a][0]].decode()), len(raw[: spans[b][1]].decode())) for a, b in ranges]


#: Words of an item that go to one automaton together.
PART = 20_000


def _parts(window: int):
    """Items as normalised texts of at most `PART` words, with the windows across their edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = normalised(text.as_py())
                starts = range(0, max(1, len(words) - window + 1), PART - window + 1) if len(words) > PART else [0]
                found += [(item, b" ".join(words[i : i + PART]).decode()) for i in starts]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found)] or [pa.nulls(0, pa.string())] * 2, ["item", "text"])

    return run


RANGE = pa.struct([("first", pa.int64()), ("last", pa.int64())])
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _scanner(items: Broadcast, window: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(items.value, window)
        for batch in batches:
            k = len(keep)
            counts, all_ranges, all_spans, all_items = [], [], [], []
            for text, ranges, ids in zip(batch.column(k), batch.column(k + 1), batch.column(k + 2)):
                text = text.as_py()
                words = normalised(text)
                new, hit = windows.scan(words)
                before = [(r["first"], r["last"]) for r in ranges.as_py()]
                found = merged(before + new) if new else before
                counts.append(len(words))
                all_ranges.append([{"first": a, "last": b} for a, b in found])
                all_spans.append([{"start": a, "end": b} for a, b in characters(text, found)] if found else [])
                all_items.append(sorted(hit.union(ids.as_py())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:k], batch.column(k), pa.array(all_ranges, pa.list_(RANGE)), pa.array(all_items, pa.list_(pa.string())),
                 pa.array(counts, pa.int64()), pa.array(all_spans, pa.list_(SPAN))],
                [*keep, "_text", "ranges", "items", "n_words", "spans"],
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, *, keep: list[str], window: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """Columns `keep` of `docs` with, per row, `n_words`, `n_hit` (words inside any
    occurring window), `items` (ids of items hit, as sorted strings), `spans` (the
    covered stretches, in characters of the text) and `contaminated`.

    NULL texts have no words. Items without words hit nothing; a NULL item id is
    the empty string; repeated items count once. Empty tables give no hits.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    items = written(mapped(items, _parts(window), "item string, text string").distinct(), "decontaminate-items")
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shards = max(1, -(-size // max_chars))
    frame = docs.select(
        *keep, F.col("text").alias("_text"),
        F.array().cast("array<struct<first:bigint,last:bigint>>").alias("ranges"), F.array().cast("array<string>").alias("items"),
    )
    added = ("_text string, ranges array<struct<first:bigint,last:bigint>>, items array<string>, "
             "n_words bigint, spans array<struct<start:bigint,end:bigint>>")
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(added)])
    before = None
    for shard in range(shards):
        mine = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard)
        held = spark.sparkContext.broadcast([tuple(r) for r in mine.collect()])
        frame = mapped(frame.select(*keep, "_text", "ranges", "items"), _scanner(held, window, keep), schema)
        if shard < shards - 1:
            frame = written(frame, "decontaminate-shard")
            held.destroy()
            if before is not None:
                discard(before)
            before = frame
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return frame.withColumns({"n_hit": hit, "contaminated": F.size("ranges") > 0}).drop("_text", "ranges")
