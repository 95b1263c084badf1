"""A quality classifier by Bradley-Terry pairwise ranking.

The chance that one document is better than another is the logistic function of
the difference of their scores; a score is linear in features of the text. Weights
are fitted by Newton steps on the differences of all (better, worse) pairs of labelled
documents, `PAIRS` being the weight of all pairs together against the penalty, and the
threshold is the quantile of all training scores that leaves the share of good labels
above it.

Sums over pairs take linear time: a score is spread over the nearest of equally spaced
nodes by interpolation weights (exact to some 1e-10 of a pair's chance), and sums over
pairs of documents become sums over pairs of nodes. Tasks add up their rows by node;
the driver holds a vector per node and the curvature, never a row. Up to `HELD` label
rows per class the same sums are made on the driver. Where `PAIRS` draws hold every
pair there is (a few hundred pairs), each pair weighs as often as it was drawn.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from .common import discard, mapped, running_totals, written

#: Label rows per class up to which their features are fitted on the driver.
HELD = 4096
PAIRS = 16384
PENALTY = 1.0
STEPS = 12
N_FEATURES = 256 + 8
#: Distance of nodes, those used around a score, and those kept: one more on either side,
#: for a score that another pass rounds to the next node.
SPACE, AROUND, KEPT = 0.125, np.arange(-3, 5), np.arange(-4, 6)
#: Nodes of one class that meet all nodes of the other at once.
NODES = 1024


def features(text: str | None) -> np.ndarray:
    """Shares of bytes (square roots), and ratios of words and lines. NULL and empty
    texts have zeros."""
    raw, out = (text or "").encode(), np.zeros(N_FEATURES)
    if not raw:
        return out
    out[:256] = np.sqrt(np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / len(raw))
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    upper = sum(map(bytes.isupper, words))
    out[256:] = (
        np.log1p(len(words)), len(raw) / n / 10, len(set(words)) / n, 1 - len(set(lines)) / m,
        n / m / 50, upper / n, sum(map(bytes.isalpha, words)) / n, 1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
    )
    return out


def _around(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The node below each score, and the weights of the nodes `AROUND` it (Lagrange)."""
    node = np.floor(scores / SPACE)
    part = (scores / SPACE - node)[:, None]
    weights = [np.prod((part - others) / (k - others), axis=1) for k in AROUND for others in [AROUND[AROUND != k]]]
    return node.astype(np.int64), np.stack(weights, axis=1)


def _by_node(z: np.ndarray, times: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes kept and, per node, the rows' weight and their weighted features."""
    node, weights = _around(z @ w)
    order = np.argsort(node, kind="stable")
    rows = np.column_stack([np.ones(len(z)), z])[order] * times[order, None]
    below, first = np.unique(node[order], return_index=True)
    nodes = np.unique(below[:, None] + KEPT)
    out = np.zeros((len(nodes), rows.shape[1]))
    for k, weight in zip(AROUND, weights[order].T):
        if len(below):
            out[np.searchsorted(nodes, below + k)] += np.add.reduceat(rows * weight[:, None], first)
    return nodes, out


def _curve(z: np.ndarray, times: np.ndarray, w: np.ndarray, nodes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the rows' outer products, weighted by the function of the score that has
    `values` at `nodes`."""
    node, weights = _around(z @ w)
    weight = (values[np.searchsorted(nodes, node[:, None] + AROUND)] * weights).sum(axis=1) * times
    return (z * weight[:, None]).T @ z


def _steps(slope: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights by Newton steps; `slope` gives gradient and curvature without the penalty."""
    w = np.zeros(N_FEATURES)
    for _ in range(STEPS):
        gradient, hessian = slope(w)
        step = np.linalg.solve(hessian + PENALTY * np.eye(N_FEATURES), gradient - PENALTY * w)
        w = w + step
        if np.abs(step).max() <= 1e-10 * np.abs(w).max():
            break
    return w


def _over_all(weight: float, by_node: Callable, curve: Callable) -> Callable:
    """The slope over all pairs, of `weight` each. `by_node(w)` gives nodes and sums of
    the worse and of the better rows; `curve(w, (nodes, values), ...)` for both classes
    the sum of their outer products."""

    def slope(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        (low, worse), (high, better) = by_node(w)
        gradient, cross = np.zeros(N_FEATURES), np.zeros((N_FEATURES, N_FEATURES))
        at_low, at_high = np.zeros(len(low)), np.zeros(len(high))
        for i in range(0, len(high), NODES):
            some, rows = slice(i, i + NODES), better[i : i + NODES]
            p = 1 / (1 + np.exp(np.clip((high[some, None] - low) * SPACE, -30, 30)))  # chance of the wrong order
            gradient += (p @ worse[:, 0]) @ rows[:, 1:] - (rows[:, 0] @ p) @ worse[:, 1:]
            p *= 1 - p
            cross += rows[:, 1:].T @ (p @ worse[:, 1:])
            at_high[some] = p @ worse[:, 0]
            at_low += rows[:, 0] @ p
        hessian = curve(w, (low, at_low), (high, at_high)) - cross - cross.T
        return weight * gradient, weight * hessian

    return slope


def _drawn(d: np.ndarray) -> Callable:
    """The slope over drawn differences of pairs."""

    def slope(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        return d.T @ p, (d * (p * (1 - p))[:, None]).T @ d

    return slope


def points(x: np.ndarray, center: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores row by row, rounded as in `score_of`: the row at the threshold gets one half."""
    return np.array([(row - center) @ weights for row in x], dtype=float)


def fit(x: np.ndarray, good: np.ndarray, base_rate: float, seed: int = 1) -> dict:
    """Weights, threshold and scale from features and labels; without both classes
    every score is one half."""
    center = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
    spread = x.std(axis=0) + 1e-3 if len(x) else np.ones(N_FEATURES)
    z = (x - center) / spread
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return {"center": center, "weights": np.zeros(N_FEATURES), "threshold": 0.0, "scale": 1.0}
    draw = np.random.default_rng(seed)
    high, low = draw.choice(better, PAIRS), draw.choice(worse, PAIRS)
    if len(np.unique(high * len(z) + low)) == len(better) * len(worse):
        w = _steps(_drawn(z[high] - z[low]))
    else:
        classes = [(z[rows], np.ones(len(rows))) for rows in (worse, better)]
        w = _steps(_over_all(
            PAIRS / len(better) / len(worse),
            lambda w: [_by_node(*rows, w) for rows in classes],
            lambda w, *values: sum(_curve(*rows, w, *v) for rows, v in zip(classes, values)),
        ))
    score = points(x, center, w / spread)
    weight = np.where(good, base_rate / len(better), (1 - base_rate) / len(worse))
    order = np.argsort(score)
    below = np.searchsorted(np.cumsum(weight[order]), 1 - base_rate)
    threshold = score[order][min(below, len(score) - 1)]
    return {"center": center, "weights": w / spread, "threshold": float(threshold), "scale": float(score.std() + 1e-9) / 4}


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Features, and how often each row is labelled 0 and 1."""
    x = np.frombuffer(b"".join(batch.column("x").to_pylist())).reshape(-1, N_FEATURES)
    return x, [batch.column(c).to_numpy().astype(float) for c in ("n_worse", "n_better")]


def _sums(table: DataFrame, value: Callable[[np.ndarray, list[np.ndarray]], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """Per key the sum of the vectors that `value` gives for the rows: by task, then by
    key in the order of tasks, so that reruns agree."""

    def added(pairs) -> pa.RecordBatch:
        out: dict[int, np.ndarray] = {}
        for key, vector in pairs:
            out[key] = out[key] + vector if key in out else vector
        return pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array([v.tobytes() for v in out.values()], pa.binary())], ["key", "x"])

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield added(pair for batch in batches if batch.num_rows for pair in value(*_rows(batch)))

    def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield added((k, np.frombuffer(v)) for b in batches for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))

    parts = mapped(table, by_task, "key long, x binary").withColumn("part", F.spark_partition_id())
    found = mapped(parts.repartition("key").sortWithinPartitions("key", "part").select("key", "x"), by_key, "key long, x binary").toArrow()
    return {k: np.frombuffer(v) for k, v in zip(found.column(0).to_pylist(), found.column(1).to_pylist())}


def fit_table(table: DataFrame, base_rate: float) -> dict:
    """`fit` over all pairs of a written table of any size: rows of features `x` (bytes of
    doubles) that count `n_worse` and `n_better` times."""
    sums = _sums(table, lambda x, times: [(0, np.array([t.sum() for t in times])), (1, (sum(times)[:, None] * x).sum(axis=0))])
    n_worse, n_better = sums.get(0, np.zeros(2))
    n = n_worse + n_better
    if not n_worse or not n_better:
        return {"center": np.zeros(N_FEATURES), "weights": np.zeros(N_FEATURES), "threshold": 0.0, "scale": 1.0}
    center = sums[1] / n
    spread = np.sqrt(_sums(table, lambda x, times: [(0, (sum(times)[:, None] * (x - center) ** 2).sum(axis=0))])[0] / n) + 1e-3

    def by_node(w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        def value(x, times):
            for c, t in enumerate(times):
                some = t > 0
                nodes, rows = _by_node(((x - center) / spread)[some], t[some], w)
                yield from zip((2 * nodes + c).tolist(), rows)

        found = _sums(table, value)
        keys = [sorted(k for k in found if k % 2 == c) for c in (0, 1)]
        return [(np.array(k) // 2, np.array([found[i] for i in k])) for k in keys]

    def curve(w: np.ndarray, *values: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        def value(x, times):
            z = (x - center) / spread
            yield from enumerate(sum(_curve(z[t > 0], t[t > 0], w, *v) for t, v in zip(times, values)))

        found = _sums(table, value)
        return np.array([found[i] for i in range(N_FEATURES)])

    w = _steps(_over_all(PAIRS / n_better / n_worse, by_node, curve))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = points(_rows(batch)[0], center, w / spread)
            yield pa.RecordBatch.from_arrays([pa.array(found), *batch.columns[1:]], ["point", "n_worse", "n_better"])

    counts = {c: F.col(c) for c in ("n_worse", "n_better")}
    tied = mapped(table, scored, "point double, n_worse long, n_better long").groupBy("point").agg(*[F.sum(v).alias(k) for k, v in counts.items()])
    below = running_totals(tied.withColumnsRenamed({c: f"{c}_here" for c in counts}), [F.col("point")], {c: F.col(f"{c}_here") for c in counts}, "ranking-points")
    here = {c: F.col(c) + F.col(f"{c}_here") for c in counts}
    share = here["n_better"] * (base_rate / n_better) + here["n_worse"] * ((1 - base_rate) / n_worse)
    times = F.col("n_better_here") + F.col("n_worse_here")
    reached, highest, first, second = below.agg(
        F.min(F.when(share >= 1 - base_rate - 1e-12, F.col("point"))), F.max("point"),
        F.sum(times * F.col("point")), F.sum(times * F.col("point") ** 2),
    ).first()
    deviation = np.sqrt(max(0.0, second / n - (first / n) ** 2))
    threshold = highest if reached is None else reached
    return {"center": center, "weights": w / spread, "threshold": float(threshold), "scale": float(deviation + 1e-9) / 4}


def score_of(model: dict, x: np.ndarray) -> float:
    """0 to 1; one half at the threshold."""
    value = ((x - model["center"]) @ model["weights"] - model["threshold"]) / model["scale"]
    return float(1 / (1 + np.exp(-np.clip(value, -500, 500))))


def _mapped(docs: DataFrame, keep: list[str], name: str, dtype, arrow, value):
    schema = StructType([*docs.select(*keep).schema, StructField(name, dtype)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [value(t.as_py()) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, arrow)], [*keep, name])

    return mapped(docs.select(*keep, F.col("text").alias("_text")), run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str, usable: Column, held: int = HELD) -> dict:
    """A model from all rows of `labels` (doc_id, `label` 0 or 1) for which `usable`
    holds; NULL labels are left out, repeated ones count again. Of documents with the
    same id the text with the smallest hash is taken."""
    rows = labels.filter(usable & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("long").alias("good"))
    n_better, n = rows.agg(F.coalesce(F.sum("good"), F.lit(0)), F.count("*")).first()
    rate = n_better / n if n else 0.0
    counted = rows.groupBy("doc_id").agg(F.sum(1 - F.col("good")).alias("n_worse"), F.sum("good").alias("n_better"))
    texts = docs.select("doc_id", "text").join(counted, "doc_id").groupBy("doc_id", "n_worse", "n_better")
    chosen = texts.agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
    table = _mapped(chosen, ["doc_id", "n_worse", "n_better"], "x", BinaryType(), pa.binary(), lambda text: features(text).tobytes())
    if max(n_better, n - n_better) > held:
        table = written(table.sortWithinPartitions("doc_id"), "ranking-features")
        model = fit_table(table.select("x", "n_worse", "n_better"), rate)
        discard(table)
        return model
    found = table.orderBy("doc_id").toArrow()
    x = np.frombuffer(b"".join(found.column("x").to_pylist())).reshape(-1, N_FEATURES)
    times = np.array([found.column(c).to_pylist() for c in ("n_worse", "n_better")], dtype=int).reshape(2, -1).T
    return fit(np.repeat(x, times.sum(axis=1), axis=0), np.repeat(np.tile([False, True], len(x)), times.ravel()), rate)


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with `score` and `predicted` (score >= 0.5). NULL and
    empty texts get the score of all-zero features."""
    scored = _mapped(docs, keep, "score", DoubleType(), pa.float64(), lambda text: score_of(model, features(text)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
