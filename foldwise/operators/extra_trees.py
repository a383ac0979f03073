"""Extremely randomised trees (M13), all trees of all folds at once.

The forest grows level by level.  A level is two aggregations over the rows, whatever the number of trees and folds:

1. (model, node): least and greatest value of the node's candidate features;
2. (model, node): class counts left of one threshold per candidate, drawn uniformly between those values.

Both are partial sums in the tasks and native ``min`` / ``max`` / ``sum`` behind the exchange.  The driver gets one row per node that may be
split, that is, no more than the model itself, and takes the best candidate (weighted Gini) of all nodes of a tree at once.  A node that finds all candidates constant draws the
next ones on the following level.  Candidates and thresholds come from a hash of (seed, fold, tree, node, feature): the forest does
not depend on partitions or on the number of tasks.

Counts are whole numbers and class weights multiply sums only, so a single-process version grows identical trees.  Trees and their
class counts live on the driver and are broadcast, as those of every ``pyspark.ml`` tree model; the rows never do.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.session import discard, stage_spread

_MASK = (1 << 64) - 1
BLOCK = 1 << 15  # rows of a task that go through the trees together


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser with full avalanche (multiply-xorshift)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw(seed: int, fold: int, tree: int, nodes: np.ndarray, features: int, salt: int) -> np.ndarray:
    """[nodes, features] hashes."""
    base = mix(np.uint64(((seed * 1_000_003 + fold + 1) * 1_000_003 + tree * 7 + salt) & _MASK))
    with np.errstate(over="ignore"):
        per = mix(base + np.asarray(nodes, np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
        return mix(per + np.arange(1, features + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03))


@dataclass
class Settings:
    n_trees: int = 350
    max_depth: int = 14
    min_split: int = 2
    candidates: int | None = None  # features tried at a node; None: square root
    balanced: bool = True
    seed: int = 42


class Tree:
    """Arrays by node: feature (-1: leaf), threshold, left child (right is the next), class counts, depth, and how many candidate sets were tried."""

    def __init__(self, counts: np.ndarray):
        self.feature, self.threshold, self.left = np.array([-1], np.int32), np.zeros(1), np.array([-1], np.int32)
        self.counts, self.depth, self.tries = counts[None, :], np.zeros(1, np.int32), np.zeros(1, np.int32)

    def split(self, nodes: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Splits nodes; the numbers of their children, those of a node next to each other."""
        at = len(self.feature) + 2 * np.arange(len(nodes), dtype=np.int32)
        self.feature[nodes], self.threshold[nodes], self.left[nodes] = feature, threshold, at
        n = 2 * len(nodes)
        self.feature = np.concatenate([self.feature, np.full(n, -1, np.int32)])
        self.threshold = np.concatenate([self.threshold, np.zeros(n)])
        self.left = np.concatenate([self.left, np.full(n, -1, np.int32)])
        self.counts = np.concatenate([self.counts, np.stack([left, self.counts[nodes] - left], axis=1).reshape(n, self.counts.shape[1])])
        self.depth = np.concatenate([self.depth, np.repeat(self.depth[nodes] + 1, 2)])
        self.tries = np.concatenate([self.tries, np.zeros(n, np.int32)])
        return np.arange(n) + len(self.feature) - n

    def arrays(self):
        return self.feature, self.threshold, self.left


def columns(x: np.ndarray) -> np.ndarray:
    """The values of rows, column after column; what is no number is infinite, above all thresholds."""
    flat = x.T.copy().reshape(-1)
    flat[np.isnan(flat)] = np.inf
    return flat


def walk(flat: np.ndarray, n: int, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The node of each of ``n`` rows after ``depth`` steps; a leaf's threshold is infinite, so its rows stay."""
    inner = feature >= 0
    at, cut = np.where(inner, feature, 0).astype(np.intp) * n, np.where(inner, threshold, np.inf)
    to, row, node = np.where(inner, left, np.arange(len(feature))).astype(np.intp), np.arange(n), np.zeros(n, np.intp)
    for _ in range(depth if inner.any() else 0):
        node = to.take(node) + (flat.take(at.take(node) + row) > cut.take(node))
    return node


def route(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row; values that are no numbers go right."""
    return walk(columns(x), len(x), feature, threshold, left, depth)


def best_score(left: np.ndarray, total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted purity of a split, larger is better; classes on the last axis, summed in order."""
    out = 0.0
    for side in (left, total - left):
        s = q = 0.0
        for c in range(len(weight)):
            v = side[..., c] * weight[c]
            s, q = s + v, q + v * v
        with np.errstate(invalid="ignore", divide="ignore"):
            out = out + q / s
    return out


class Forest:
    """Trees of each fold model: ``trees[fold]``; model ``fold`` was fitted on the rows of the other folds (None: all rows)."""

    def __init__(self, trees: dict, weights: dict, classes: int, depth: int):
        self.trees, self.weights, self.classes, self.depth = trees, weights, classes, depth

    def probabilities(self, x: np.ndarray, fold) -> np.ndarray:
        """Mean over the trees of the weighted class shares of each row's leaf."""
        out, flat = np.zeros((len(x), self.classes)), columns(x)
        for t in self.trees[fold]:
            c = t.counts * self.weights[fold][None, :]
            out += (c / c.sum(axis=1, keepdims=True)).take(walk(flat, len(x), *t.arrays(), int(t.depth.max())), axis=0)
        return out / len(self.trees[fold])


def matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """An array column as a matrix; what isn't finite is NaN."""
    a = batch.column(column)
    x = a.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(a), -1) if len(a) else np.zeros((0, 0))
    return np.where(np.isfinite(x), x, np.nan)


def fit(rows: DataFrame, folds: Iterable, classes: int, settings: Settings | None = None) -> Forest:
    """rows: x array<double> (one length), y int (0 .. classes - 1), fold int.  One model for each of ``folds`` (None: of all rows).

    Not-a-number and infinite values have no part in thresholds and go right; a null or empty fold model raises."""
    s = settings or Settings()
    folds = list(folds)
    sc = rows.sparkSession.sparkContext
    rows = stage_spread(rows.select("x", F.col("y").cast("int").alias("y"), F.col("fold").cast("int").alias("fold")).filter("x IS NOT NULL AND y IS NOT NULL"))
    per = rows.groupBy("fold", "y").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).collect()  # a row per fold and class
    if not per:
        raise ValueError("no rows to fit")
    d = max(r["d"] for r in per)
    k = s.candidates or max(1, int(np.sqrt(d)))
    trees, weights, active = {}, {}, []
    for m, f in enumerate(folds):
        n = np.zeros(classes, np.int64)
        for r in per:
            if f is None or r["fold"] != f:
                n[r["y"]] += r["n"]
        if not n.sum():
            raise ValueError(f"no rows outside fold {f}")
        weights[f] = np.where(n > 0, n.sum() / ((n > 0).sum() * np.maximum(n, 1)), 0.0) if s.balanced else np.ones(classes)
        trees[f] = [Tree(n) for _ in range(s.n_trees)]
        active += [(m, t) for t in range(s.n_trees)]

    def worth(tree, nodes):
        """The nodes that may be split: deep ones, small ones, pure ones and those without candidates left are not."""
        c = tree.counts[nodes]
        return nodes[(tree.depth[nodes] < s.max_depth) & (c.sum(axis=1) >= s.min_split) & ((c > 0).sum(axis=1) > 1) & (tree.tries[nodes] * k < d)]

    names = [f"l{j}_{c}" for j in range(k) for c in range(classes)]
    active = {key: v for key in active if len(v := worth(trees[folds[key[0]]][key[1]], np.zeros(1, int)))}
    while active:
        plan = {}
        for (m, t), nodes in active.items():
            tree = trees[folds[m]][t]
            order = np.argsort(draw(s.seed, m, t, nodes, d, 1), axis=1, kind="stable")
            pick = tree.tries[nodes][:, None] * k + np.arange(k)[None, :]
            feats = np.where(pick < d, np.take_along_axis(order, np.minimum(pick, d - 1), axis=1), -1)
            place = np.full(len(tree.feature), -1, np.int32)
            place[nodes] = np.arange(len(nodes))
            plan[m, t] = (*tree.arrays(), place, feats, nodes, int(tree.depth.max()))
        shared = sc.broadcast(plan)
        spans = rows.mapInArrow(_spans(shared, folds, k), "m int, t int, node int, " + ", ".join(f"lo{j} double, hi{j} double" for j in range(k)))
        spans = _by_tree(spans.groupBy("m", "t", "node").agg(*[F.min(f"lo{j}").alias(f"lo{j}") for j in range(k)], *[F.max(f"hi{j}").alias(f"hi{j}") for j in range(k)]))
        thr = {}
        for key, p in plan.items():
            thr[key] = np.full(p[4].shape, np.nan)
            at, got = spans[key]
            i = p[3][at]
            u = (np.take_along_axis(draw(s.seed, *key, p[5][i], d, 2), np.maximum(p[4][i], 0), axis=1) >> np.uint64(11)) * 2.0**-53
            lo, hi = (np.stack([got[f"{e}{j}"] for j in range(k)], axis=1) for e in ("lo", "hi"))
            cut = lo + u * (hi - lo)
            thr[key][i] = np.where(lo < hi, np.where(cut < hi, cut, lo), np.nan)
        shared.destroy()
        cuts = sc.broadcast({key: (*p[:6], thr[key], p[6]) for key, p in plan.items()})
        counts = rows.mapInArrow(_counts(cuts, folds, k, classes), "m int, t int, node int, " + ", ".join(f"{x} long" for x in names))
        counts = _by_tree(counts.groupBy("m", "t", "node").agg(*[F.sum(x).alias(x) for x in names]))
        cuts.destroy()
        active = {}
        for (m, t), p in plan.items():
            tree, nodes = trees[folds[m]][t], p[5]
            at, got = counts[m, t]
            left = np.zeros((len(nodes), k, classes), np.int64)
            left[p[3][at]] = np.stack([got[x] for x in names], axis=1).reshape(-1, k, classes)
            ok = ~np.isnan(thr[m, t])
            score = np.where(ok, best_score(left, tree.counts[nodes][:, None, :], weights[folds[m]]), -np.inf)
            j = score.argmax(axis=1)
            i = np.flatnonzero(ok.any(axis=1))
            tree.tries[nodes[~ok.any(axis=1)]] += 1  # these draw their next candidates
            made = tree.split(nodes[i], p[4][i, j[i]], thr[m, t][i, j[i]], left[i, j[i]])
            again = np.full(len(nodes), -1)
            again[i] = np.arange(len(i))
            # in the order of the nodes: the children of a split one, or the node itself
            todo = [made[2 * a : 2 * a + 2] if a >= 0 else nodes[x : x + 1] for x, a in enumerate(again.tolist())]
            if len(todo := worth(tree, np.concatenate(todo))):
                active[m, t] = todo
    discard(rows)
    return Forest(trees, weights, classes, s.max_depth)


def _by_tree(found: DataFrame) -> dict:
    """(model, tree) -> (nodes, columns) of an aggregation by (m, t, node): one row per node that may be split."""
    r = found.toArrow()
    m, t = np.asarray(r["m"]), np.asarray(r["t"])
    order = np.lexsort((t, m))
    ends = np.flatnonzero(np.concatenate([[True], (np.diff(m[order]) != 0) | (np.diff(t[order]) != 0), [True]])) if len(m) else np.zeros(1, int)
    cols = {c: r[c].to_numpy()[order] for c in r.column_names}
    return {(int(cols["m"][a]), int(cols["t"][a])): (cols["node"][a:b], {c: v[a:b] for c, v in cols.items()}) for a, b in zip(ends[:-1], ends[1:], strict=True)}


def _blocks(batches):
    """(values, labels, folds) of the rows, block by block."""
    held, n = [], 0
    for b in batches:
        if len(b):
            held.append((matrix(b), np.asarray(b.column("y")), np.asarray(b.column("fold"))))
            n += len(b)
        if n >= BLOCK:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _placed(block, shared, folds):
    """(model key, its plan, values column after column, their rows, labels, the rows at active nodes, their place among those) of a block, model by model."""
    x, y, fold = block
    own = {m: np.flatnonzero(fold != f) if f is not None else np.arange(len(fold)) for m, f in enumerate(folds)}
    mine = {m: (columns(x[at]), len(at), y[at]) for m, at in own.items()}
    for (m, t), p in shared.value.items():
        flat, n, labels = mine[m]
        if n:
            place = p[3].take(walk(flat, n, p[0], p[1], p[2], p[-1]))
            here = np.flatnonzero(place >= 0)
            if len(here):
                yield (m, t), p, flat, n, labels, here, place.take(here).astype(np.intp)


def _sent(held: dict, shared, names: list[str], rows: int = 100_000):
    """The nodes that a task has seen, with their sums: ``held`` has (seen, columns) by model key."""
    out, n = [], 0
    for key, (seen, cols) in held.items():
        at = np.flatnonzero(seen)
        nodes = shared.value[key][5][at]
        out.append([np.full(len(at), key[0], np.int32), np.full(len(at), key[1], np.int32), nodes.astype(np.int32), *(c[at] for c in cols)])
        n += len(at)
        if n >= rows:
            yield _flush(out, names)
            out, n = [], 0
    if out:
        yield _flush(out, names)


def _flush(out: list, names: list[str]) -> pa.RecordBatch:
    cols = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, from_pandas=True) for c in cols], names)


def _spans(shared, folds, k: int, flush: int = 256 << 20):
    """A row per node and task: a task keeps its nodes' least and greatest values, and sends them early only beyond ``flush`` bytes."""
    names = ["m", "t", "node"] + [f"{e}{j}" for j in range(k) for e in ("lo", "hi")]

    def bounds(held, plans):
        for key, (seen, cols) in held.items():
            none = np.isinf(cols)
            none[0::2] |= (plans[key][4] < 0).T
            none[1::2] |= (plans[key][4] < 0).T
            yield key, (seen, np.where(none, np.nan, cols))

    def run(batches):
        held, size = {}, 0
        for block in _blocks(batches):
            missing = np.isnan(block[0]).any()
            for key, p, flat, n, _, here, place in _placed(block, shared, folds):
                if key not in held:
                    held[key] = np.zeros(len(p[5]), bool), np.repeat([[np.inf], [-np.inf]] * k, len(p[5]), axis=1)
                    size += held[key][1].nbytes
                seen, cols = held[key]
                seen[place] = True
                first = np.maximum(p[4], 0).astype(np.intp) * n
                for j in range(k):
                    v = flat.take(first[:, j].take(place) + here)
                    np.minimum.at(cols[2 * j], place, v)
                    np.maximum.at(cols[2 * j + 1], place, np.where(v == np.inf, -np.inf, v) if missing else v)
            if size > flush:
                yield from _sent(dict(bounds(held, shared.value)), shared, names)
                held, size = {}, 0
        yield from _sent(dict(bounds(held, shared.value)), shared, names)
    return run


def _counts(shared, folds, k: int, classes: int, flush: int = 256 << 20):
    """A row per node and task, as in ``_spans``."""
    names = ["m", "t", "node"] + [f"l{j}_{c}" for j in range(k) for c in range(classes)]

    def run(batches):
        held, size = {}, 0
        for block in _blocks(batches):
            for key, p, flat, n, y, here, place in _placed(block, shared, folds):
                m = len(p[5])
                if key not in held:
                    held[key] = np.zeros(m, bool), np.zeros((k * classes, m), np.int64)
                    size += held[key][1].nbytes
                seen, cols = held[key]
                seen[place] = True
                first, cell = np.maximum(p[4], 0).astype(np.intp) * n, place * classes + y.take(here)
                for j in range(k):
                    goes = flat.take(first[:, j].take(place) + here) <= p[6][:, j].take(place)
                    cols[j * classes : (j + 1) * classes] += np.bincount(cell, goes, m * classes).astype(np.int64).reshape(m, classes).T
            if size > flush:
                yield from _sent(held, shared, names)
                held, size = {}, 0
        yield from _sent(held, shared, names)
    return run


def score(forest: Forest, rows: DataFrame, mode: str, model: str) -> DataFrame:
    """rows: id, x, [fold] -> long (id, model, [fold], class, p).  mode 'oof': the model of the row's own fold; 'test': mean of all
    fold models; 'full': the model of all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)
    return score_with(rows, mode, model, lambda x, f: shared.value.probabilities(x, f), [f for f in forest.trees if f is not None], forest.classes)


def score_with(rows: DataFrame, mode: str, model: str, probabilities, folds: list, classes: int) -> DataFrame:
    """Long predictions of any model that gives ``probabilities(x, fold)``."""
    def run(batches):
        for b in batches:
            x, fold = matrix(b), np.asarray(b.column("fold")) if mode == "oof" else None
            p = np.zeros((len(x), classes))
            if mode == "oof":
                for f in folds:
                    if (fold == f).any():
                        p[fold == f] = probabilities(x[fold == f], f)
            elif len(x):
                p = sum(probabilities(x, f) for f in folds) / len(folds) if mode == "test" else probabilities(x, None)
            n = len(x)
            cols = {"id": np.repeat(np.asarray(b.column("id")), classes), "model": np.full(n * classes, model)}
            if mode == "oof":
                cols["fold"] = np.repeat(fold, classes).astype(np.int32)
            cols |= {"class": np.tile(np.arange(classes, dtype=np.int32), n), "p": p.reshape(-1)}
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "model" else None) for k, c in cols.items()], list(cols))

    cols = ["id", "x"] + (["fold"] if mode == "oof" else [])
    return rows.select(*cols).mapInArrow(run, "id long, model string, " + ("fold int, " if mode == "oof" else "") + "class int, p double")
