"""Product codes of vectors: each of four parts of a vector by its nearest codebook entry.

Training and assignment are exact; bounds only save work. Of each part a row keeps an
upper bound on the distance to its entry, a lower bound for each of `GROUPS` runs of
entries (its own entry apart), and for every bound the round in which it was measured.
All earlier codebooks are kept: an entry's way since that round is the distance
between its place then and its place now (the norm of the summed moves), which is at
most the sum of the moves' norms. A run of entries whose lower bound, less the
farthest way in it, stays above the upper bound holds no nearest entry; only the
others are scanned again.

    encode(vectors, keep)         trains `ROUNDS` rounds on all vectors and codes them

A round is one pass: tasks read vectors with bounds, write them with new ones, and
emit one sum per part and entry; only those sums reach the driver (at most
4 x 256 x components values).

Rows whose vector is NULL or holds a NULL, NaN or infinite component are dropped.
Components become floor(1024 * x), held to +-2**26 so that squared distances fit a
long. The dimension is that of the smallest kept vec_id (NULL ids last, repeated ids by
vector); vectors of another one are dropped too. If it is no multiple of four, the
parts are as equal as can be. Fewer than 256 vectors: as many entries. Ties go to the
lower entry, repeated rows are coded each, an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import discard, mapped, written

PARTS, ENTRIES, ROUNDS, GROUPS = 4, 256, 4, 4
SCALE, LARGEST = 1024, 1 << 26
#: Vectors whose distances to all entries are held at once.
STEP = 4096
#: Bounds are loosened by this share, far more than rounding takes.
SLACK = 1e-6

STATE = "v binary, codes binary, upper binary, upper_round binary, lower binary, lower_round binary"
SUMS = "part int, entry int, n long, sums array<long>, scanned long"


def edges(dimension: int) -> list[int]:
    return [dimension * i // PARTS for i in range(PARTS + 1)]


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by entries."""
    width, most = x.shape[1], max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * max(width, 1) < 1 << 53:  # whole numbers that doubles hold
        x, entries = x.astype(np.float64), entries.astype(np.float64)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None]
    return out.astype(np.int64)


def _runs(k: int) -> list[tuple[int, int]]:
    return [(k * g // GROUPS, k * (g + 1) // GROUPS) for g in range(GROUPS)]


def _above(x: np.ndarray) -> np.ndarray:
    return (x * (1 + SLACK)).astype(np.float32)


def _below(x: np.ndarray) -> np.ndarray:
    return (x * (1 - SLACK)).astype(np.float32)


class Part:
    """One part of the vectors against its codebooks, of which the last one counts."""

    def __init__(self, books: list[np.ndarray]):
        self.books, self.now, self.runs = books, len(books) - 1, _runs(len(books[-1]))
        moved = [np.sqrt(((books[-1] - old).astype(np.float64) ** 2).sum(axis=1)) for old in books]
        self.moved = np.array(moved)  # by round and entry
        self.farthest = np.array([[m[a:b].max(initial=0) for a, b in self.runs] for m in moved])

    def scan(self, x: np.ndarray):
        """Everything measured anew."""
        d = squares(x, self.books[-1])
        codes = d.argmin(axis=1)
        rows = np.arange(len(x))
        own = d[rows, codes]
        rest = d.astype(np.float64)
        rest[rows, codes] = np.inf
        lower = np.stack([np.sqrt(rest[:, a:b].min(axis=1, initial=np.inf)) for a, b in self.runs], axis=1)
        stamps = np.full(len(x), self.now, np.uint8)
        return codes, own, _above(np.sqrt(own)), stamps, _below(lower), np.repeat(stamps[:, None], GROUPS, axis=1), len(x) * len(self.books[-1])

    def update(self, x, codes, upper, upper_round, lower, lower_round):
        """The same from bounds of earlier rounds; runs that cannot hold the nearest entry are passed over."""
        book, codes = self.books[-1], codes.astype(np.int64)
        high = upper + self.moved[upper_round, codes]
        low = lower - self.farthest[lower_round, np.arange(GROUPS)[None]]
        own, scanned = np.full(len(x), -1, np.int64), 0
        todo = np.flatnonzero((high[:, None] * (1 + SLACK) >= low).any(axis=1))
        diff = x[todo] - book[codes[todo]]
        own[todo] = (diff * diff).sum(axis=1)
        scanned += len(todo)
        upper, upper_round = upper.copy(), upper_round.copy()
        upper[todo], upper_round[todo] = _above(np.sqrt(own[todo])), self.now
        open_ = np.zeros(low.shape, bool)
        open_[todo] = np.sqrt(own[todo])[:, None] * (1 + SLACK) >= low[todo]
        best, found = own.copy(), codes.copy()
        lower, lower_round, seconds = lower.copy(), lower_round.copy(), {}
        for g, (a, b) in enumerate(self.runs):
            rows = np.flatnonzero(open_[:, g])
            if not len(rows) or a == b:
                continue
            d = squares(x[rows], book[a:b])
            scanned += len(rows) * (b - a)
            near = d.argmin(axis=1)
            at = d[np.arange(len(rows)), near]
            wins = (at < best[rows]) | ((at == best[rows]) & (near + a < found[rows]))
            best[rows[wins]], found[rows[wins]] = at[wins], near[wins] + a
            seconds[g] = rows, d
        for g, (rows, d) in seconds.items():
            a, b = self.runs[g]
            rest = d.astype(np.float64)
            mine = np.flatnonzero((found[rows] >= a) & (found[rows] < b))
            rest[mine, found[rows[mine]] - a] = np.inf
            lower[rows, g], lower_round[rows, g] = _below(np.sqrt(rest.min(axis=1))), self.now
        changed = np.flatnonzero(found != codes)
        for g, (a, b) in enumerate(self.runs):  # the entry that was left counts in its run again
            left = changed[(codes[changed] >= a) & (codes[changed] < b) & ~open_[changed, g]]
            lower[left, g] = _below(np.minimum(low[left, g], np.sqrt(own[left])))
            lower_round[left, g] = self.now
        upper[changed], upper_round[changed] = _above(np.sqrt(best[changed])), self.now
        return found, best, upper, upper_round, lower, lower_round, scanned


def _array(column: pa.Array, dtype, *shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


def _binary(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(x)], pa.binary())


def _pass(keep: list[str], history: list[np.ndarray], last: bool, state: list[str]):
    """One round over rows (keep, state): the rows with new state, then the sums. The
    last one gives codes and errors. `history`: all books of all rounds, entries by components."""
    dimension = history[0].shape[1]
    cuts = edges(dimension)
    names = [*keep, *(["codes", "error", "scanned"] if last else [*state, "part", "entry", "n", "sums", "scanned"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [Part([book[:, a:b] for book in history]) for a, b in zip(cuts, cuts[1:])]
        k = len(history[0])
        total, counts, scanned, kept = np.zeros((k, dimension), np.int64), np.zeros((PARTS, k), np.int64), np.zeros(PARTS, np.int64), None
        for whole in batches:
            kept = whole.schema
            for at in range(0, len(whole), STEP):
                batch = whole.slice(at, STEP)
                column = dict(zip(batch.schema.names, batch.columns))
                x = _array(column["v"], np.int32, dimension).astype(np.int64)
                n, fresh = len(x), "codes" not in column
                if not fresh:
                    codes, upper = _array(column["codes"], np.uint8, PARTS), _array(column["upper"], np.float32, PARTS)
                    upper_round = _array(column["upper_round"], np.uint8, PARTS)
                    lower, lower_round = _array(column["lower"], np.float32, PARTS, GROUPS), _array(column["lower_round"], np.uint8, PARTS, GROUPS)
                new, error = [], np.zeros(n, np.int64)
                for i, part in enumerate(parts):
                    mine = x[:, cuts[i] : cuts[i + 1]]
                    if fresh:
                        found = part.scan(mine)
                    else:
                        found = part.update(mine, codes[:, i], upper[:, i], upper_round[:, i], lower[:, i], lower_round[:, i])
                    new.append(found[:-1])
                    scanned[i] += found[-1]
                    entry = found[0]
                    if last:
                        gap = mine - part.books[-1][entry]
                        error += (gap * gap).sum(axis=1)
                    else:
                        counts[i] += np.bincount(entry, minlength=k)
                        for j in range(cuts[i], cuts[i + 1]):
                            total[:, j] += _added(entry, x[:, j], k)
                codes_out = np.stack([p[0] for p in new], axis=1).astype(np.uint8)
                columns = [column[c] for c in keep]
                if last:
                    columns += [_binary(codes_out), pa.array(error), pa.nulls(n, pa.int64())]
                else:
                    bounds = [np.stack([p[i] for p in new], axis=1) for i in (2, 3, 4, 5)]
                    columns += [column["v"], _binary(codes_out), *map(_binary, bounds)]
                    columns += [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)
        if kept is not None and not last:
            rows = [(i, j) for i in range(PARTS) for j in range(k) if counts[i, j] or not j]
            columns = [pa.nulls(len(rows), kept.field(c).type) for c in keep] + [pa.nulls(len(rows), pa.binary()) for _ in state]
            columns += [
                pa.array([i for i, _ in rows], pa.int32()), pa.array([j for _, j in rows], pa.int32()), pa.array([int(counts[r]) for r in rows], pa.int64()),
                pa.array([total[j, cuts[i] : cuts[i + 1]].tolist() for i, j in rows], pa.list_(pa.int64())),
                pa.array([0 if j else int(scanned[i]) for i, j in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _added(entry: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Sums by entry; whole numbers below 2**53, at most STEP of them a time."""
    return np.bincount(entry, weights=values, minlength=k).astype(np.int64)


@dataclass
class Codes:
    rows: DataFrame  # the kept columns, codes (binary, a byte a part), error
    books: np.ndarray | None  # the final entries by components; None if there are no rows
    scanned: list[int]  # distances measured in each round, the first one all

    def digest(self) -> str:
        if self.books is None:
            return hashlib.sha256(b"").hexdigest()
        cuts = edges(self.books.shape[1])
        numbers = [str(x) for a, b in zip(cuts, cuts[1:]) for x in self.books[:, a:b].ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def encode(vectors: DataFrame, keep: list[str], vector: str = "embedding", key: str = "vec_id") -> Codes:
    """Train on all of `vectors` and code them. `keep` are columns to return, `key` among them."""
    cell = F.col(vector)
    finite = F.forall(cell, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    most = F.lit(float(LARGEST))
    whole = F.transform(cell, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, most), -most)).cast("int"))
    vectors_ = kept = written(vectors.filter(cell.isNotNull() & finite).select(*keep, whole.alias("v")), "codes-vectors")
    first = kept.orderBy(F.col(key).asc_nulls_last(), "v").select("v").limit(ENTRIES)
    first = [r.v for r in first.collect()]
    if not first:
        return Codes(kept.select(*keep, F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")), None, [])
    dimension = len(first[0])
    first = [v for v in first if len(v) == dimension]
    kept = kept.filter(F.size("v") == dimension)
    if len(first) < ENTRIES:  # others may follow behind rows of another dimension
        first = [r.v for r in kept.orderBy(F.col(key).asc_nulls_last(), "v").select("v").limit(ENTRIES).collect()]
    history, scanned, cuts = [np.array(first, np.int64).reshape(len(first), dimension)], [], edges(dimension)
    state = [f.split()[0] for f in STATE.split(", ")]
    ids = kept.select(*keep).schema
    table, earlier = mapped(kept, _packed(keep), _schema(ids, "v binary")), None
    for _ in range(ROUNDS):
        schema = _schema(ids, f"{STATE}, {SUMS}")
        new = written(mapped(table, _pass(keep, history, False, state), schema), "codes-round")
        if earlier is not None:
            discard(earlier)
        sums = new.filter("part IS NOT NULL").select("part", "entry", "n", "scanned", F.posexplode("sums").alias("place", "sum"))
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("scanned").alias("scanned"))
        book = history[-1].copy()
        part, entry, place, n, total, measured = [c.to_numpy() for c in sums.toArrow().columns]  # a row a component of an entry
        used = n > 0
        book[entry[used], np.array(cuts)[part[used]] + place[used]] = total[used] // n[used]
        scanned.append(int(measured[place == 0].sum()))
        history.append(book)
        table, earlier = new.filter("part IS NULL").select(*keep, *state), new
    schema = _schema(ids, "codes binary, error long, scanned long")
    coded = written(mapped(table, _pass(keep, history, True, state), schema), "codes")
    discard(earlier, vectors_)
    return Codes(coded.drop("scanned"), history[-1], scanned)


def _schema(ids: T.StructType, more: str) -> T.StructType:
    return T.StructType([*ids.fields, *T.StructType.fromDDL(more).fields])


def _packed(keep: list[str]):
    """Vectors as bytes of 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.names.index("v"))
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype(np.int32)
            data = [values[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in keep], pa.array(data, pa.binary())], [*keep, "v"])

    return run
