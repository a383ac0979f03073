"""Linear support vector machine with squared hinge loss (M8), all folds and classes at once.

Minimises ``|w|^2 / 2 + C sum max(0, 1 - t f(x))^2`` in the primal, t = +1 / -1 (one class against the rest; two classes: one problem); the
intercept is the weight of a constant feature and penalised like the others.  The loss is piecewise quadratic, so a Newton step
solves the active rows' normal equations.  One pass over the rows sums gradient and Hessian of all problems, one more
the losses at all candidate step lengths.  A problem is done when its gradient norm, relative to that at zero, is below the tolerance;
the norm is part of the result, and ``fit`` raises if the passes run out before.

Sums are (features + 1)^2 numbers per problem and task, added up behind an exchange by problem; rows never leave the tasks.  A feature
map (``expand``) is applied there, batch by batch: only the features it starts from are written and read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.extra_trees import matrix, score_with
from foldwise.session import discard, stage_spread

STEPS = np.array([0.0] + [0.5**k for k in range(12)])


def packed_sums(rows: DataFrame, make, keys: int | None = None) -> dict[int, np.ndarray]:
    """key -> sum of the float arrays that ``make(batch)`` gives as (key, array): added up in the tasks, then by key (at most ``keys`` of them)."""
    def part(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if len(b):
                for key, v in make(b):
                    sums[key] = sums[key] + v if key in sums else v
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.asarray(v, "<f8").tobytes() for v in sums.values()], pa.binary())], ["k", "v"])

    def add(batches):
        key, total = None, None
        out: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column("k").to_pylist(), b.column("v").to_pylist(), strict=True):
                v = np.frombuffer(v, "<f8")
                if k != key:
                    if key is not None:
                        out[key] = total
                    key, total = k, v.copy()
                else:
                    total += v
        if key is not None:
            out[key] = total
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([v.tobytes() for v in out.values()], pa.binary())], ["k", "v"])

    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = n if keys is None else min(n, keys)
    got = rows.mapInArrow(part, "k int, v binary").repartition(n, "k").sortWithinPartitions("k").mapInArrow(add, "k int, v binary").collect()  # one row per problem
    return {r["k"]: np.frombuffer(r["v"], "<f8") for r in got}


class LinearSVM:
    """``weights[name]``: [classes or 1, features + 1]; ``norms[name]``: largest relative gradient norm; ``passes`` over the rows."""

    def __init__(self, weights: dict, norms: dict, classes: int, passes: int, expand=None):
        self.weights, self.norms, self.classes, self.passes, self.expand = weights, norms, classes, passes, expand

    def margins(self, x: np.ndarray, name) -> np.ndarray:
        w, x = self.weights[name], expanded(x, self.expand)
        return x @ w[:, :-1].T + w[:, -1]

    def probabilities(self, x: np.ndarray, name) -> np.ndarray:
        """Sigmoid of the margin (two classes), else soft-max of the margins."""
        m = self.margins(x, name)
        if self.classes == 2:
            p = 1 / (1 + np.exp(-np.clip(m[:, 0], -20, 20)))
            return np.stack([1 - p, p], axis=1)
        e = np.exp(m - m.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def expanded(x: np.ndarray, expand) -> np.ndarray:
    """The mapped features of rows; what isn't finite is NaN."""
    if expand is None or not len(x):
        return x
    x = expand(x)
    return np.where(np.isfinite(x), x, np.nan)


def fit(rows: DataFrame, classes: int, subsets: dict, C: float = 1.0, tolerance: float = 1e-8, max_steps: int = 100, expand=None) -> LinearSVM:
    """rows: x array<double>, y int, and the columns of ``subsets``: name -> {column: value that its rows do NOT have} (empty: all rows).

    Every name is a model of its own, e.g. ``{f: {"fold": f}}`` for out-of-fold fits.  Values that are no numbers raise.  ``expand`` maps
    the features [rows, n] of a batch to those that the machine is fitted on."""
    columns = sorted({c for s in subsets.values() for c in s})
    rows = stage_spread(rows.select("x", F.col("y").cast("int").alias("y"), *[F.col(c).cast("int").alias(c) for c in columns]))
    names, outputs = list(subsets), 1 if classes == 2 else classes
    d = rows.select(F.size("x").alias("d")).first()
    if d is None:
        raise ValueError("no rows to fit")
    d = (d["d"] if expand is None else expand(np.zeros((1, d["d"]))).shape[1]) + 1
    problems = [(name, k) for name in names for k in range(outputs)]
    w = np.zeros((len(problems), d))
    direction = np.zeros_like(w)
    open_, norms, start = set(range(len(problems))), np.full(len(problems), np.inf), np.ones(len(problems))

    def opened(b):
        x = expanded(matrix(b), expand)
        if np.isnan(x).any():
            raise ValueError("impute missing values before an SVM fit")
        x, y = np.concatenate([x, np.ones((len(x), 1))], axis=1), np.asarray(b.column("y"))
        rows_of = {}
        for name in names:
            ok = np.ones(len(y), bool)
            for c, v in subsets[name].items():
                ok &= np.asarray(b.column(c)) != v
            rows_of[name] = ok
        return x, y, rows_of

    def one(y, k):
        return np.where(y == (1 if outputs == 1 else k), 1.0, -1.0)

    i, j = np.triu_indices(d)
    passes = 0
    while open_ and passes < 2 * max_steps:
        at, now = frozenset(open_), w.copy()

        def newton(b, at=at, now=now):
            x, y, rows_of = opened(b)
            todo = sorted(at)
            scores = x @ now[todo].T  # of all open problems at once
            for f, p in zip(scores.T, todo, strict=True):
                name, k = problems[p]
                t = one(y, k)
                act = np.flatnonzero(rows_of[name] & (t * f < 1))
                if len(act):
                    a = x[act]
                    yield p, np.concatenate([(f[act] - t[act]) @ a, (a.T @ a)[i, j]])

        sums = packed_sums(rows, newton)
        passes += 1
        for p in at:
            s = sums.get(p, np.zeros(d + len(i)))
            g = w[p] + 2 * C * s[:d]
            h = np.zeros((d, d))
            h[i, j] = h[j, i] = 2 * C * s[d:]
            if passes == 1:
                start[p] = max(np.linalg.norm(g), 1e-300)
            norms[p] = np.linalg.norm(g) / start[p]
            if norms[p] <= tolerance:
                open_.discard(p)
            direction[p] = -np.linalg.solve(h + np.eye(d), g)
        if not open_:
            break
        at, step = frozenset(open_), direction.copy()

        def losses(b, at=at, now=now, step=step):
            x, y, rows_of = opened(b)
            todo = sorted(at)
            scores, slopes = x @ now[todo].T, x @ step[todo].T
            for f, s, p in zip(scores.T, slopes.T, todo, strict=True):
                name, k = problems[p]
                ok = rows_of[name]
                t, f, s = one(y, k)[ok], f[ok], s[ok]
                yield p, np.array([(np.maximum(1 - t * (f + s * length), 0) ** 2).sum() for length in STEPS])

        sums = packed_sums(rows, losses)
        passes += 1
        for p in at:
            value = C * sums.get(p, np.zeros(len(STEPS))) + ((w[p][:, None] + direction[p][:, None] * STEPS[None, :]) ** 2).sum(axis=0) / 2
            best = int(np.argmin(value))
            if best == 0:  # no step lowers the loss: the last bits are reached
                open_.discard(p)
            w[p] += STEPS[best] * direction[p]
    discard(rows)
    if open_:
        raise RuntimeError(f"{len(open_)} of {len(problems)} fits have gradient norms of up to {max(norms[p] for p in open_):.1e} after {passes} passes")
    shape = lambda name: np.stack([w[problems.index((name, k))] for k in range(outputs)])
    return LinearSVM({name: shape(name) for name in names}, {name: max(norms[problems.index((name, k))] for k in range(outputs)) for name in names}, classes, passes, expand)


def score(svm: LinearSVM, rows: DataFrame, mode: str, model: str, folds: list) -> DataFrame:
    """rows: id, x, [fold] -> long (id, model, [fold], class, p); modes as in ``extra_trees.score``; models are named by fold."""
    return score_with(rows, mode, model, svm.probabilities, folds, svm.classes)


def margins(svm: LinearSVM, rows: DataFrame, names: list) -> DataFrame:
    """The rows with ``margins``: array<double> of the first output of each named model."""
    fields = rows.schema
    w = {n: svm.weights[n][0] for n in names}

    def run(batches):
        for b in batches:
            x = expanded(matrix(b), svm.expand)
            m = np.stack([x @ w[n][:-1] + w[n][-1] for n in names], axis=1) if len(x) else np.zeros((0, len(names)))
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, len(names), dtype=np.int32)), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, values], [*b.schema.names, "margins"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", margins array<double>")
