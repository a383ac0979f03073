"""Gaussian naive Bayes written as DataFrame aggregations.

Fit: ONE aggregation of the training rows by (fold, class) -> count, mean and
population variance of every feature (Spark's stable streaming moments; partial
aggregation map-side).  The k x K x d moments are tiny; the out-of-fold model of
fold f merges the cells of the other folds with the parallel-variance rule.
Variances get ``var_smoothing * max feature variance`` added (as the reference model).

Score: Arrow-batched numpy in the tasks (log joint likelihood per class, soft-max);
no join and no shuffle -- each partition is scored where it lies.  Test rows
are scored by every fold model and the probabilities averaged (fold-averaged test).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _moments(train: DataFrame, feats: list[str], y: str, fold_col: str):
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(feats):
        aggs += [F.count(c).alias(f"k{i}"), F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}")]
    rows = train.groupBy(F.col(fold_col).alias("fold"), F.col(y).cast("long").alias("cls")).agg(*aggs).collect()
    return rows


def _merge(cells):
    """Merge (rows, count[d], mean[d], var[d]) cells into one (rows, mean, var) with the parallel rule; counts leave nulls out, a feature
    without a value has mean and variance 0."""
    k = np.maximum(sum(c[1] for c in cells), 1)
    mean = sum(c[1] * c[2] for c in cells) / k
    m2 = sum(c[1] * c[3] + c[1] * (c[2] - mean) ** 2 for c in cells)
    return sum(c[0] for c in cells), mean, m2 / k


class NaiveBayesFit:
    def __init__(self, rows, d: int, var_smoothing: float = 1e-9):
        self.folds = sorted({r["fold"] for r in rows})
        self.classes = sorted({r["cls"] for r in rows})
        column = lambda r, x: np.array([r[f"{x}{i}"] or 0.0 for i in range(d)], dtype=float)
        cells = {(r["fold"], r["cls"]): (r["n"], column(r, "k"), column(r, "m"), column(r, "v")) for r in rows}
        self.params = {}
        for f in self.folds + [None]:  # None = all folds (full refit)
            keep = {key: v for key, v in cells.items() if key[0] != f}
            _, _, var_all = _merge(list(keep.values()))
            eps = var_smoothing * float(np.max(var_all))
            n_tot = sum(v[0] for v in keep.values())
            mu, var, c0 = [], [], []
            for c in self.classes:
                cc = [v for key, v in keep.items() if key[1] == c]
                if not cc:  # class absent from this training part: it gets probability 0
                    mu.append([0.0] * d)
                    var.append([1.0] * d)
                    c0.append(-1e300)
                    continue
                n_c, m_c, v_c = _merge(cc)
                v_c = v_c + eps
                mu.append(m_c.tolist())
                var.append(v_c.tolist())
                c0.append(math.log(n_c / n_tot))
            self.params[f] = (mu, var, c0)

    # Scoring is Arrow-batched numpy inside the tasks (``mapInPandas``): the fitted numbers
    # (k x K x d) travel in the closure, rows stay where Spark partitioned them, no shuffle.
    # (An unrolled column expression of k x K x d terms outgrows the 64 KB generated-method limit.)
    def _probs(self, X, f):
        mu, var, c0 = (np.asarray(a, dtype=float) for a in self.params[f])
        # a missing value has no part in the likelihood, nor one of a feature that is constant in all rows
        known = np.where(np.isnan(X), 0.0, 1.0)
        scale = np.where(var > 0, var, 1.0)
        norm = np.where(var > 0, np.log(2.0 * math.pi * scale), 0.0)
        far = (np.nan_to_num(X)[:, None, :] - mu[None, :, :]) ** 2 / scale[None, :, :] * (var > 0)[None, :, :]
        jll = c0[None, :] - 0.5 * ((far + norm[None, :, :]) * known[:, None, :]).sum(axis=2)
        e = np.exp(jll - jll.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def score(self, df: DataFrame, feats: list[str], mode: str, model: str) -> DataFrame:
        """df: (id, [fold], feats...) -> long (id, model, [fold], class, p).
        mode 'oof': model of the row's own fold; 'test': mean over the fold models; 'full': refit."""
        folds, K = self.folds, len(self.classes)

        def fn(batches):
            for pdf in batches:
                X = pdf[feats].to_numpy(dtype=float)
                n = len(pdf)
                if mode == "oof":
                    P = np.zeros((n, K))
                    fv = pdf["fold"].to_numpy()
                    for f in folds:
                        m = fv == f
                        if m.any():
                            P[m] = self._probs(X[m], f)
                elif mode == "test":
                    P = sum(self._probs(X, f) for f in folds) / len(folds)
                else:
                    P = self._probs(X, None)
                outd = {"id": np.repeat(pdf["id"].to_numpy(), K), "model": model}
                if mode == "oof":
                    outd["fold"] = np.repeat(pdf["fold"].to_numpy(), K).astype(np.int32)
                outd["class"] = np.tile(np.array(self.classes, dtype=np.int32), n)
                outd["p"] = P.reshape(-1)
                yield pd.DataFrame(outd)

        schema = "id long, model string, " + ("fold int, " if mode == "oof" else "") + "class int, p double"
        return df.mapInPandas(fn, schema)


def fit_naive_bayes(train: DataFrame, feats: list[str], y: str = "y", fold_col: str = "fold",
                    var_smoothing: float = 1e-9) -> NaiveBayesFit:
    return NaiveBayesFit(_moments(train, feats, y, fold_col), len(feats), var_smoothing)


def naive_bayes_oof(train: DataFrame, test: DataFrame | None, feats: list[str], y: str = "y", fold_col: str = "fold",
                    id_col: str = "id", model: str = "nb", var_smoothing: float = 1e-9):
    """K1 with M10: long OOF table (id, model, fold, class, p) and test table (id, model, class, p)."""
    fit = fit_naive_bayes(train, feats, y, fold_col, var_smoothing)
    cast = [F.col(c).cast("double").alias(c) for c in feats]
    oof = fit.score(train.select(F.col(id_col).alias("id"), F.col(fold_col).alias("fold"), *cast), feats, "oof", model)
    tst = None
    if test is not None:
        tst = fit.score(test.select(F.col(id_col).alias("id"), *cast), feats, "test", model)
    return oof, tst, fit
