"""Language identification by unigrams of pieces, summed over all segmentations.

Pieces are the letter pieces of a fixed public vocabulary. Per language, a piece's
probability comes from the expected times it is used in the training words, over all
ways to cut a word into pieces (one forward-backward pass from equal probabilities).
A text is scored by the forward algorithm: the probability of a word is the sum over
all its segmentations. Words are maximal runs of letters, lower-cased, with a mark in
front, of any length: those above `LONG` letters are scored one by one with logarithms,
from the last columns of the forward pass, all others many at once.

What is gathered is one table of pieces by languages, and the score of the frequent
words, at most `FREQUENT`. Words are counted by Spark; tasks score rare words anew. In training
a run of letters above `LONG` takes some 150 bytes a letter of its task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import mapped, written
from .tokens import Lookup, mix64

#: Letters of a word above which it is scored by itself, and places looked up at once then.
LONG, BLOCK = 64, 1 << 16
#: Words held by a task at once, and their letters.
HELD_WORDS, HELD_LETTERS = 300_000, 1 << 25
#: Training words of a task.
WORDS_A_TASK = 50_000
#: Languages of a model: the table of pieces by languages is held by driver and tasks.
MOST_LANGUAGES = 1000
#: Words of documents scored together.
TOGETHER = 500_000
#: Words of at least 1 / FREQUENT of all training words are scored once and broadcast.
FREQUENT = 1 << 17
SMOOTHING = 0.5
#: A letter without a piece, against the share of such letters in training.
OTHER = 1e-3
UNDETERMINED = "und"
#: ASCII bytes that are no lower-case letters become spaces.
_ASCII = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MARK = "▁"
_BASE = 0x9E3779B97F4A7C15


def vocabulary(path: str | None = None) -> list[str]:
    """Lower-case letter pieces of a sentencepiece model, word starts with a mark.
    `path` defaults to the installed public tokenizers."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in found if (p.removeprefix(_MARK).isalpha() or p == _MARK) and p == p.lower()})


def letters(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    text = (text or "").lower()
    out = text.encode().translate(_ASCII).decode().split()
    if not text.isascii() and out and not "".join(out).isalpha():
        out = "".join(c if c.isalpha() else " " for c in text).split()
    return out


class Pieces:
    """Looks up substrings of many words at once; index `n` stands for no piece."""

    def __init__(self, pieces: list[str]):
        self.n, self.longest = len(pieces), max(map(len, pieces), default=1)
        keys = np.zeros(self.n, dtype=np.uint64)
        for size in sorted({len(p) for p in pieces}):
            at = [i for i, p in enumerate(pieces) if len(p) == size]
            keys[at] = self._hash(self._totals([pieces[i] for i in at], size), 0, size)
        self.find = Lookup(keys.view(np.int64), np.arange(self.n, dtype=float))

    @staticmethod
    def _totals(words: list[str], size: int) -> np.ndarray:
        codes = np.array(words, dtype=f"U{size}").view(np.uint32).reshape(len(words), size).astype(np.uint64)
        powers = np.array([pow(_BASE, i, 1 << 64) for i in range(size)], dtype=np.uint64)
        totals = np.zeros((size + 1, len(words)), dtype=np.uint64)
        np.cumsum((mix64((codes + np.uint64(1)) * np.uint64(_BASE)) * powers).T, axis=0, out=totals[1:])
        return totals

    @staticmethod
    def _hash(totals: np.ndarray, a: int, b: int) -> np.ndarray:
        return mix64((totals[b] - totals[a]) * np.uint64(pow(_BASE, -a, 1 << 64)))

    def cuts(self, words: list[str], size: int) -> dict[tuple[int, int], np.ndarray]:
        """Index of the piece from a to b of each word, all of `size` characters with
        the mark, where any word has one; single characters always."""
        totals, out = self._totals(words, size), {}
        for b in range(1, size + 1):
            for a in range(max(0, b - self.longest), b):
                hit, at = self.find(self._hash(totals, a, b).view(np.int64))
                if b == a + 1 or hit.any():
                    out[a, b] = np.where(hit, at, self.n).astype(np.int64)
        return out


    def ending(self, word: str, first: int, last: int) -> np.ndarray:
        """Index of the piece of each length (rows, from 1) that ends at each place from
        `first` to `last` of one word (columns); n + 1 for none, n for a single letter
        without a piece."""
        start = max(0, first - self.longest)
        part = word[start:last]
        totals = self._totals([part], len(part))[:, 0]
        inverse = np.full(len(part) + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        out = np.full((self.longest, last - first + 1), self.n + 1, dtype=np.int64)
        for size in range(1, min(self.longest, len(part)) + 1):
            hit, at = self.find(mix64((totals[size:] - totals[:-size]) * inverse[: len(totals) - size]).view(np.int64))
            ends = start + size + np.arange(len(hit))  # where each of them ends
            inside = (ends >= first) & (ends <= last)
            out[size - 1, ends[inside] - first] = np.where(hit, at, self.n if size == 1 else self.n + 1)[inside]
        return out


def _blocks(pieces: Pieces, word: str) -> Iterator[tuple[int, np.ndarray]]:
    """(place, index of the pieces by length that end there), a block looked up at a time."""
    for first in range(1, len(word) + 1, BLOCK):
        found = pieces.ending(word, first, min(len(word), first + BLOCK - 1))
        yield from zip(range(first, first + found.shape[1]), found.T)


def _forward(pieces: Pieces, logs: np.ndarray, word: str) -> Iterator[np.ndarray]:
    """Log probability of the first 0, 1, 2 ... characters, per column of `logs`; of
    earlier ones only as many are held as a piece is long."""
    held = np.full((pieces.longest, logs.shape[1]), -np.inf)  # the nearest first
    held[0] = 0.0
    yield held[0].copy()
    for _, found in _blocks(pieces, word):
        new = np.logaddexp.reduce(held + logs[found], axis=0)
        held[1:] = held[:-1].copy()
        held[0] = new
        yield new


def _logs(table: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(table)


@dataclass
class Model:
    vocab: list[str]
    langs: list[str]
    table: np.ndarray  # probability of a piece (the last: of no piece) by language
    words: list[str]  # frequent words,
    rows: np.ndarray  # and their log likelihood by language


def _by_size(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w) + 1, []).append(i)
    return out


def log_likelihood(pieces: Pieces, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log of each word's probability, per column of `probability` (a row per
    piece, the last for letters without one)."""
    table = np.vstack([probability, np.zeros((1, probability.shape[1]))])
    out = np.zeros((len(words), probability.shape[1]))
    sizes, logs = _by_size(words), None
    for at in [sizes.pop(n) for n in sorted(sizes) if n > LONG]:
        logs = _logs(table) if logs is None else logs
        for i in at:
            for last in _forward(pieces, logs, _MARK + words[i]):
                pass
            out[i] = last
    for size, at in sizes.items():
        forward = [np.ones((len(at), table.shape[1]))] + [0.0] * size
        for (a, b), piece in pieces.cuts([_MARK + words[i] for i in at], size).items():
            if b > a + 1:  # no piece adds nothing
                piece = np.where(piece == pieces.n, pieces.n + 1, piece)
            forward[b] = forward[b] + forward[a] * table[piece]
        out[at] = np.log(forward[size])
    return out


def expected_counts(pieces: Pieces, words: list[str], times: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, and of no piece, from equal probabilities."""
    even = np.full(pieces.n + 2, 1.0 / (pieces.n + 1))
    even[pieces.n] *= OTHER
    even[pieces.n + 1] = 0
    counts = np.zeros(pieces.n + 2)
    sizes = _by_size(words)
    for at in [sizes.pop(n) for n in sorted(sizes) if n > LONG]:
        for i in at:
            _expected_of_long(pieces, _logs(even), _MARK + words[i], times[i], counts)
    for size, at in sizes.items():
        found = pieces.cuts([_MARK + words[i] for i in at], size)
        found = {k: p if k[1] == k[0] + 1 else np.where(p == pieces.n, pieces.n + 1, p) for k, p in found.items()}
        forward, backward = [np.ones(len(at))] + [0.0] * size, [0.0] * size + [np.ones(len(at))]
        for (a, b), piece in found.items():
            forward[b] = forward[b] + forward[a] * even[piece]
        for (a, b), piece in sorted(found.items(), key=lambda x: -x[0][1]):
            backward[a] = backward[a] + backward[b] * even[piece]
        share = times[at] / forward[size]
        for (a, b), piece in found.items():
            counts += np.bincount(piece, forward[a] * even[piece] * backward[b] * share, minlength=pieces.n + 2)
    return counts[: pieces.n + 1]


def _expected_of_long(pieces: Pieces, logs: np.ndarray, word: str, times: float, counts: np.ndarray) -> None:
    """Adds one word's expected uses, by logarithms."""
    forward = np.concatenate(list(_forward(pieces, logs[:, None], word)))
    backward = np.full(len(word) + 1 + pieces.longest, -np.inf)
    backward[len(word)] = 0.0
    blocks = range(1, len(word) + 1, BLOCK)
    for first in reversed(blocks):
        last = min(len(word), first + BLOCK - 1)
        found = pieces.ending(word, first, last)
        for b in range(last, first - 1, -1):  # all pieces that end at b reach back from it
            starts = np.arange(b - 1, max(-1, b - 1 - pieces.longest), -1)
            way = backward[b] + logs[found[: len(starts), b - first]]
            backward[starts] = np.logaddexp(backward[starts], way)
        for size in range(1, pieces.longest + 1):
            ends = np.arange(max(first, size), last + 1)
            if len(ends):
                piece = found[size - 1, ends - first]
                share = np.exp(forward[ends - size] + logs[piece] + backward[ends] - forward[-1])
                counts += np.bincount(piece, share * times, minlength=len(counts))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, Counter] = {}
    taken = 0

    def rows():
        flat = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
        seen.clear()
        columns = list(zip(*flat)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            found = letters(text.as_py())
            seen.setdefault(lang.as_py(), Counter()).update(found)
            taken += sum(map(len, found))
            if sum(map(len, seen.values())) > HELD_WORDS or taken > HELD_LETTERS:
                taken = 0
                yield rows()
    yield rows()


def train(docs: DataFrame, usable: Column, vocab: list[str]) -> Model:
    """Piece probabilities by language, from `text` and `lang` of the documents for
    which `usable` holds; those without a language are left out."""
    known = docs.filter(usable & F.col("lang").isNotNull()).select("lang", "text")
    counted = mapped(known, _count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = written(counted, "langid-words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = Pieces(vocab), {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            words, times = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for lang in set(langs):
                at = np.flatnonzero(langs == lang)
                total[lang] = total.get(lang, 0) + expected_counts(pieces, [words[i] for i in at], times[at].astype(float))
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(counts[used])], ["lang", "piece", "uses"])

    spread = counted.repartition(1 + counted.count() // WORDS_A_TASK)
    uses = mapped(spread, run, "lang string, piece long, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
    found = uses.toArrow()  # at most pieces x languages
    langs = sorted(set(found.column("lang").to_pylist()))
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"{len(langs)} languages to learn; at most {MOST_LANGUAGES}")
    table = np.full((len(vocab) + 1, len(langs)), SMOOTHING)
    place = {x: i for i, x in enumerate(langs)}
    np.add.at(table, (found.column("piece").to_numpy(), [place[x] for x in found.column("lang").to_pylist()]), found.column("uses").to_numpy())
    table /= table.sum(axis=0)
    table[-1] *= OTHER
    total = counted.agg(F.sum("n")).first()[0] or 0
    usual = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") * FREQUENT >= total)
    words = usual.select("word").toArrow().column("word").to_pylist()  # at most FREQUENT
    return Model(vocab, langs, table, words, log_likelihood(Pieces(vocab), table, words))


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with `lang_pred`, the language under which the whole
    text is likeliest (ties: the first by code point), and `score`, its share of the
    probability. NULL texts, texts without a letter, and an empty model give `und`
    and 0. Repeated rows are alike; an empty table gives an empty one."""
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL("lang_pred string, score double")])
    held, langs = docs.sparkSession.sparkContext.broadcast(model), model.langs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        pieces, place = Pieces(known.vocab), dict(zip(known.words, range(len(known.words))))

        def judged(texts: list[list[str]]) -> Iterator[tuple[str, float]]:
            flat = [w for t in texts for w in t]
            if not flat or not langs:
                yield from [(UNDETERMINED, 0.0)] * len(texts)
                return
            new = list(set(flat).difference(place))
            here = place | dict(zip(new, range(len(place), len(place) + len(new)))) if new else place
            rows = np.vstack([known.rows, log_likelihood(pieces, known.table, new)])
            at = np.fromiter(map(here.__getitem__, flat), dtype=np.int64, count=len(flat))
            sums = np.vstack([np.zeros(len(langs)), np.cumsum(rows[at], axis=0)])
            ends = np.cumsum([len(t) for t in texts])
            for text, end in zip(texts, ends):
                if not text:
                    yield UNDETERMINED, 0.0
                    continue
                total = sums[end] - sums[end - len(text)]
                share = np.exp(total - total.max())
                yield langs[int(total.argmax())], float(share.max() / share.sum())

        for batch in batches:
            found, waiting, size = [], [], 0
            for text in batch.column(len(keep)):
                waiting.append(letters(text.as_py()))
                size += len(waiting[-1])
                if size > TOGETHER:
                    found += judged(waiting)
                    waiting, size = [], 0
            found += judged(waiting)
            preds, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    return mapped(docs.select(*keep, F.col("text").alias("_text")), run, schema)
