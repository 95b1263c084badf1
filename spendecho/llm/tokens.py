"""Word splitting and hashing of Arrow text columns with numpy, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once (a longer document is a slice of its own).
SLICE = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words `[^\x20\x09-\x0D]+` and, after lower-casing, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS = {1: np.ones(1, dtype=np.uint64), -1: np.ones(1, dtype=np.uint64)}


def _powers(n: int, sign: int) -> np.ndarray:
    """_BASE ** (sign * i) modulo 2 ** 64 for i < n."""
    if len(_POWERS[sign]) < n:
        step = np.full(max(n, 8 * SLICE), pow(_BASE, sign, 1 << 64), dtype=np.uint64)
        step[0] = 1
        out = np.multiply.accumulate(step)
        if n > 8 * SLICE:
            return out
        _POWERS[sign] = out
    return _POWERS[sign][:n]


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first document, bytes, offsets of each document and the end);
    NULLs are empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, side="right")) - 1)
        last = min(last, len(column))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word; no word crosses documents."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = table[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever it stands."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data), 1), out=total[1:])
    return mix64((total[ends] - total[starts]) * _powers(len(data) + 1, -1)[starts])


def word_bounds(docs: np.ndarray, n: int) -> np.ndarray:
    """Index of each document's first word, and the number of words."""
    return np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=n))])


class Lookup:
    """Values of 64-bit keys (not -1) by open addressing, for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.last = (1 << self.bits) - 1
        self.keys, self.values = np.full(self.last + 1, -1, np.int64), np.zeros(self.last + 1)
        todo, at = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[todo[free]]  # of several, one stays
            won = self.keys[at] == keys[todo]
            self.values[at[won]] = values[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_BASE)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their values (else 0)."""
        at = self._slots(keys)
        there = self.keys[at]
        hit, value = there == keys, self.values[at]
        left = np.flatnonzero(~hit & (there != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & self.last
            there = self.keys[at]
            found = there == keys[left]
            hit[left[found]], value[left[found]] = True, self.values[at[found]]
            more = ~found & (there != -1)
            left, at = left[more], at[more]
        value[~hit] = 0
        return hit, value
