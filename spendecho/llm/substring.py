"""Substring dedup with suffix automata of reference shards.

A window is `WINDOW` consecutive words. A word goes if a window over it also starts
in a document with a smaller id. The reference is the corpus itself, which has no
size bound, so shards are not sent to every task: documents are routed to them.

1. A window is sampled by its smallest hash of `GRAM` words: equal windows have equal
   anchors, about one word in five is one. Anchors found in one document only are
   dropped; no window with such an anchor can be shared.
2. The remaining windows are hashed; the smallest document with a window owns it.
   Windows of one owner only are dropped.
3. The first places of shared windows, as stretches of words of their owner, are the
   reference, dealt by owner to shards of about `SHARD_WORDS` words. Stretches of
   other documents go to their owners' shards; a shard with many of them is copied
   to several tasks (salts), so an owner of a third of all documents is no hot key.
4. A task builds the suffix automaton of its shard, streams the stretches over it,
   and keeps the windows that it really finds with a smaller owner. Hashes only
   route: nothing is removed that the automaton has not matched word for word.

A missing id counts as larger than all others. Rows with the same id are no smaller
than each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import discard, mapped, written
from .tokens import NOT_SPACE, hashes, mix64, slices, spans, word_bounds

WINDOW = 13
GRAM = 5
SHARD_WORDS = 50_000
NO_ID = (1 << 63) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _rolling(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive values."""
    total = h[: len(h) - n + 1].copy()
    for j in range(1, n):
        total = total * _STEP + h[j : len(h) - n + 1 + j]
    return mix64(total)


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """Word starts, ends, documents; then window starts, anchors and word hashes."""
    starts, ends, docs = spans(data, offsets, NOT_SPACE)
    if len(starts) < WINDOW:
        return starts, ends, docs, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = hashes(data, starts, ends)
    grams, n = _rolling(h, GRAM), len(h) - WINDOW + 1
    anchor = grams[:n].copy()
    for j in range(1, WINDOW - GRAM + 1):
        np.minimum(anchor, grams[j : n + j], out=anchor)
    whole = np.flatnonzero(docs[:n] == docs[WINDOW - 1 :])
    return starts, ends, docs, whole, anchor[whole], h


def _pairs(docs: np.ndarray, values: np.ndarray) -> np.ndarray:
    return values ^ mix64((docs.astype(np.uint64) + np.uint64(1)) * _STEP)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each document."""
    for batch in batches:
        order, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for first, data, offsets in slices(batch.column(2)):
            _, _, docs, at, anchor, _ = _windows(data, offsets)
            if not len(at):
                continue
            doc = docs[at]
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
            doc, anchor = doc[new], anchor[new]
            _, one = np.unique(_pairs(doc, anchor), return_index=True)
            doc, anchor = doc[one] + first, anchor[one]
            yield pa.RecordBatch.from_arrays(
                [pa.array(order[doc]), pa.array(key[doc]), pa.array(anchor.view(np.int64))], ["order", "key", "anchor"]
            )


RUN = pa.struct([("first", pa.int32()), ("text", pa.binary())])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: places and hashes of the windows with a shared anchor, and the
    text under each run of them."""
    for batch in batches:
        order, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        lists = batch.column(3)
        for first, data, offsets in slices(batch.column(2)):
            starts, ends, docs, at, anchor, h = _windows(data, offsets)
            if not len(at):
                continue
            n = len(offsets) - 1
            mine = lists.slice(first, n)
            shared = _pairs(np.repeat(np.arange(n), mine.value_lengths().to_numpy()), mine.flatten().to_numpy().view(np.uint64))
            keep = np.isin(_pairs(docs[at], anchor), shared)
            at = at[keep]
            if not len(at):
                continue
            window = _rolling(h, WINDOW)[at].view(np.int64)
            bounds = word_bounds(docs, n)
            doc = docs[at]
            place = at - bounds[doc]
            cuts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]), [True]]))
            runs = [
                {"first": int(place[a]), "text": data[starts[at[a]] : ends[at[b - 1] + WINDOW - 1]].tobytes()}
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            run_doc = doc[cuts[:-1]]
            found = np.unique(doc)
            lo, hi = np.searchsorted(doc, found), np.searchsorted(doc, found, side="right")
            ra = np.concatenate([np.searchsorted(run_doc, found), [len(runs)]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(order[found + first]), pa.array(key[found + first]),
                    pa.ListArray.from_arrays(pa.array(np.append(lo, hi[-1]), pa.int32()), pa.array(place.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(np.append(lo, hi[-1]), pa.int32()), pa.array(window)),
                    pa.ListArray.from_arrays(pa.array(ra, pa.int32()), pa.array(runs, RUN)),
                ],
                ["order", "key", "places", "windows", "runs"],
            )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared windows of a document joined to stretches of one owner: its own (kind 0,
    the reference) and other owners' (kind 1)."""
    for batch in batches:
        rows, orders = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        runs, shared = batch.column(2), batch.column(3)
        doc = np.repeat(np.arange(batch.num_rows), shared.value_lengths().to_numpy())
        places, owners = (shared.flatten().field(i).to_numpy().astype(np.int64) for i in range(2))
        turn = np.lexsort((owners, places, doc))
        doc, places, owners = doc[turn], places[turn], owners[turn]
        new = (doc[1:] != doc[:-1]) | (places[1:] != places[:-1] + 1) | (owners[1:] != owners[:-1])
        cuts = np.flatnonzero(np.concatenate([[True], new, [True]])) if len(doc) else np.zeros(1, np.int64)
        at, stop = cuts[:-1], cuts[1:]
        run_doc = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
        firsts, texts = runs.flatten().field(0).to_numpy().astype(np.int64), runs.flatten().field(1)
        inside = np.searchsorted((run_doc << 32) + firsts, (doc[at] << 32) + places[at], side="right") - 1
        lines, counts, held, words = [], (stop - at + WINDOW - 1).tolist(), -1, []
        for i, low, n in zip(inside.tolist(), (places[at] - firsts[inside]).tolist(), counts):
            if i != held:
                held, words = i, texts[i].as_py().split()
            lines.append(b" ".join(words[low : low + n]))
        order = orders[doc[at]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owners[at]), pa.array((owners[at] != order).astype(np.int32)), pa.array(order), pa.array(rows[doc[at]]),
                pa.array(places[at]), pa.array(lines, pa.binary()), pa.array(counts, pa.int64()),
            ],
            STRETCH,
        )


STRETCH = ["owner", "kind", "order", "row", "first", "text", "n"]


class Automaton:
    """Suffix automaton over words of several texts, each with an owner; every state
    knows the smallest owner of its strings."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [NO_ID]
        self.ready = False

    def _state(self, length: int, owner: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.next) - 1

    def _clone(self, p: int, word: bytes, q: int) -> int:
        new = self._state(self.length[p] + 1, NO_ID)
        self.next[new] = dict(self.next[q])
        self.link[new] = self.link[q]
        self.link[q] = new
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        return new

    def add(self, words: list[bytes], owner: int) -> None:
        follow, link, length, last = self.next, self.link, self.length, 0
        for word in words:
            q = follow[last].get(word)
            if q is not None:  # already there from an earlier text
                last = q if length[q] == length[last] + 1 else self._clone(last, word, q)
                self.owner[last] = min(self.owner[last], owner)
                continue
            new, p = self._state(length[last] + 1, owner), last
            while p >= 0 and word not in follow[p]:
                follow[p][word] = new
                p = link[p]
            if p >= 0:
                q = follow[p][word]
                link[new] = q if length[p] + 1 == length[q] else self._clone(p, word, q)
            last = new

    def finish(self) -> None:
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.owner[state] < self.owner[up]:
                self.owner[up] = self.owner[state]
        self.ready = True

    def shared(self, words: list[bytes], order: int, least: int) -> list[int]:
        """Starts of the windows of `least` words that stand in a text of an owner
        smaller than `order`: from matching statistics, cut to the window."""
        follow, link, length, state, matched, out = self.next, self.link, self.length, 0, 0, []
        for i, word in enumerate(words):
            while state and word not in follow[state]:
                state = link[state]
                matched = length[state]
            if word in follow[state]:
                state = follow[state][word]
                matched += 1
            while state and length[link[state]] >= least:
                state = link[state]
                matched = length[state]
            if matched >= least and self.owner[state] < order:
                out.append(i - least + 1)
        return out


SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per stretch, the spans of words under windows that the shard's automaton finds.
    Rows come sorted by shard and salt, references first."""
    at, automaton = None, Automaton()
    for batch in batches:
        out = []
        for shard, salt, kind, owner, order, row, first, text in zip(*[batch.column(i).to_pylist() for i in range(8)]):
            if (shard, salt) != at:
                at, automaton = (shard, salt), Automaton()
            words = text.split()
            if kind == 0:
                automaton.add(words, owner)
                continue
            if not automaton.ready:
                automaton.finish()
            found: list[dict] = []
            for start in automaton.shared(words, order, WINDOW):
                if found and first + start <= found[-1]["last"] + 1:
                    found[-1]["last"] = first + start + WINDOW - 1
                else:
                    found.append({"first": first + start, "last": first + start + WINDOW - 1})
            if found:
                out.append((row, found))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.int64()), pa.array([f for _, f in out], pa.list_(SPAN))], ["row", "spans"])


SPANS = "array<struct<first:bigint,last:bigint>>"


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(order, key, spans): removable stretches of words, per document content.

    `docs` is (order, key, text): the id, or the largest number, and a hash of the text."""
    anchors = written(mapped(docs, _anchors, "order long, key long, anchor long"), "substring-anchors")
    shared = anchors.groupBy("anchor").agg(F.min("order").alias("low"), F.max("order").alias("high"))
    shared = written(shared.filter("low < high").select("anchor"), "substring-shared")
    mine = anchors.join(shared, "anchor").groupBy("order", "key").agg(F.collect_set("anchor").alias("anchors"))
    mine = written(mine, "substring-mine")
    windows = mapped(
        docs.join(mine, ["order", "key"]).select("order", "key", "text", "anchors"), _candidates,
        "order long, key long, places array<int>, windows array<long>, runs array<struct<first:int,text:binary>>",
    )
    windows = written(windows.withColumn("row", F.monotonically_increasing_id()), "substring-windows")
    discard(anchors, shared, mine)

    each = windows.select("row", "order", F.explode(F.arrays_zip("places", "windows")).alias("x"))
    each = each.select("row", "order", F.col("x.places").alias("place"), F.col("x.windows").alias("window"))
    owners = each.groupBy("window").agg(F.min("order").alias("owner"), F.max("order").alias("high"))
    owners = written(owners.filter("owner < high").drop("high"), "substring-owners")
    shared = each.join(owners, "window").groupBy("row").agg(F.collect_list(F.struct("place", "owner")).alias("shared"))
    shared = written(shared, "substring-places")
    discard(owners)
    stretches = windows.join(shared, "row").select("row", "order", "runs", "shared")
    stretches = written(
        mapped(stretches, _stretches, "owner long, kind int, order long, row long, first long, text binary, n long"), "substring-stretches"
    )
    discard(shared)

    reference = stretches.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    shards = -(-reference // SHARD_WORDS) or 1
    dealt = stretches.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)))
    load = dealt.filter("kind = 1").groupBy("shard").agg(F.ceil(F.sum("n") / (4 * SHARD_WORDS)).cast("int").alias("salts"))
    load = written(load, "substring-load")
    dealt = dealt.join(load, "shard")
    salts = F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("row", "first"), F.col("salts")).cast("int")))
    dealt = dealt.withColumn("salt", F.explode(salts)).select("shard", "salt", "kind", "owner", "order", "row", "first", "text")
    matched = mapped(
        dealt.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind"), _match, f"row long, spans {SPANS}"
    )
    matched = written(matched, "substring-matched")
    found = matched.join(windows.select("row", "order", "key"), "row").groupBy("order", "key")
    return found.agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, out = len(keep), []
            for text, found in zip(batch.column(k), batch.column(k + 1)):
                text = text.as_py()
                words, gone, left = (text or "").encode().split(), 0, text
                n = len(words)
                if found.as_py():
                    stay = np.ones(n, dtype=bool)
                    for x in found.as_py():
                        stay[x["first"] : x["last"] + 1] = False
                    words, gone = [w for w, s in zip(words, stay.tolist()) if s], int(n - stay.sum())
                    left = b" ".join(words).decode()
                out.append((n, gone, hashlib.sha256(b" ".join(words)).hexdigest(), left))
            columns = list(zip(*out)) or [(), (), (), ()]
            added = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *added], [*keep, "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def deduplicate(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` (doc_id, text) with n_words, n_removed, kept_sha256 and
    kept_text: the text itself if nothing goes, else the kept words joined by spaces.

    NULL and empty texts have no words; texts below `WINDOW` words lose nothing;
    repeated rows are treated alike; an empty table gives an empty one."""
    order, key = F.coalesce("doc_id", F.lit(NO_ID)), F.coalesce(F.xxhash64("text"), F.lit(0))
    named = docs.select(order.cast("long").alias("order"), key.alias("key"), F.col("text"))
    found = repeated_spans(named).toDF("_order", "_key", "_spans")
    rows = docs.select(*keep, F.col("text").alias("_text"), order.cast("long").alias("_o"), key.alias("_k"))
    rows = rows.join(found, (F.col("_o") == F.col("_order")) & (F.col("_k") == F.col("_key")), "left")
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL("n_words long, n_removed long, kept_sha256 string, kept_text string")])
    return mapped(rows.select(*keep, "_text", "_spans"), _cut(keep), schema)
