"""Fits without the own fold (``fit_scope='fold'``) of medians, scalers and the quantile transform.

A row of fold f is transformed with numbers that no row of fold f had a part in; rows without a fold (test rows) with those of all
training rows.  Moments come from one aggregation by fold, merged without the own fold.  Order statistics come from the exact
quantile routine over one masked column per fold (null on the fold's rows), so all folds share its brackets, counts and passes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.quantile import exact_quantiles
from foldwise.operators.scale import apply_quantile_normal, fit_quantile_normal

ALL = -1  # key of the fit on all rows


def folds_of(train: DataFrame, fold_col: str = "fold") -> list[int]:
    """The folds, as many rows as there are."""
    return sorted(r[0] for r in train.select(fold_col).filter(F.col(fold_col).isNotNull()).distinct().collect())


def masked(train: DataFrame, cols: list[str], fold_col: str = "fold") -> tuple[DataFrame, dict[str, tuple[str, int]]]:
    """One column per (column, fold), null on the fold's rows; and the columns themselves under the key ``ALL``."""
    names = {f"{c}__{f}": (c, f) for c in cols for f in [*folds_of(train, fold_col), ALL]}
    return train.select(*[(F.col(c) if f == ALL else F.when(~F.col(fold_col).eqNullSafe(F.lit(f)), F.col(c))).alias(n) for n, (c, f) in names.items()]), names


def fit_quantiles(train: DataFrame, cols: list[str], probs: list[float], fold_col: str = "fold") -> dict[int, dict[str, list]]:
    """fold -> column -> quantiles of the rows outside the fold; key ``ALL`` for all rows."""
    wide, names = masked(train, cols, fold_col)
    out: dict[int, dict[str, list]] = {}
    for n, q in exact_quantiles(wide, list(names), probs).items():
        c, f = names[n]
        out.setdefault(f, {})[c] = q
    return out


def fit_median(train: DataFrame, cols: list[str], fold_col: str = "fold") -> dict[int, dict[str, float]]:
    return {f: {c: q[0] for c, q in by.items()} for f, by in fit_quantiles(train, cols, [0.5], fold_col).items()}


def fit_standard(train: DataFrame, cols: list[str], fold_col: str = "fold") -> dict[int, dict[str, tuple[float, float]]]:
    """fold -> column -> (mean, population sd, 1 if zero) of the rows outside the fold."""
    aggs = [x for c in cols for x in (F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.var_pop(c).alias(f"v_{c}"))]
    rows = train.groupBy(fold_col).agg(*aggs).collect()  # a row per fold
    out = {}
    for f in [*sorted(r[fold_col] for r in rows if r[fold_col] is not None), ALL]:
        out[f] = {}
        for c in cols:
            n = mean = m2 = 0.0
            for r in rows:
                k = r[f"n_{c}"]
                if (f != ALL and r[fold_col] == f) or not k:
                    continue
                delta = r[f"m_{c}"] - mean  # merge of (n, mean, sum of squares)
                m2 += k * r[f"v_{c}"] + delta * delta * n * k / (n + k)
                mean += delta * k / (n + k)
                n += k
            out[f][c] = (mean, math.sqrt(m2 / n) or 1.0) if n else (0.0, 1.0)
    return out


def fit_robust(train: DataFrame, cols: list[str], fold_col: str = "fold") -> dict[int, dict[str, tuple[float, float]]]:
    """fold -> column -> (median, interquartile range, 1 if zero) of the rows outside the fold."""
    q = fit_quantiles(train, cols, [0.25, 0.5, 0.75], fold_col)
    return {f: {c: (v[1], (v[2] - v[0]) or 1.0) if v[1] is not None else (0.0, 1.0) for c, v in by.items()} for f, by in q.items()}


def of_fold(values: dict[int, float | None], fold_col: str | None = "fold") -> Column:
    """The number of each row's fold; that of all rows where there is no fold or an unknown one."""
    whole = F.lit(values[ALL]).cast("double")
    if fold_col is None:
        return whole
    own = [x for f, v in values.items() if f != ALL for x in (F.lit(f), F.lit(v).cast("double"))]
    return F.coalesce(F.create_map(*own)[F.col(fold_col)], whole) if own else whole


def apply_fill(df: DataFrame, medians: dict, fold_col: str | None = "fold") -> DataFrame:
    cols = medians[ALL]
    return df.select(*[F.coalesce(F.col(c).cast("double"), of_fold({f: m[c] for f, m in medians.items()}, fold_col)).alias(c) if c in cols else F.col(c) for c in df.columns])


def apply_center_scale(df: DataFrame, params: dict, fold_col: str | None = "fold") -> DataFrame:
    cols = params[ALL]
    at = lambda c, i: of_fold({f: p[c][i] for f, p in params.items()}, fold_col)
    return df.select(*[((F.col(c) - at(c, 0)) / at(c, 1)).alias(c) if c in cols else F.col(c) for c in df.columns])


def quantile_normal(train: DataFrame, test: DataFrame | None, cols: list[str], n_quantiles: int = 1000, fold_col: str = "fold"):
    """N8 for train (each row by the fit without its fold) and test rows (by all): each (column, fold) is a column of its own."""
    wide, names = masked(train, cols, fold_col)
    params = fit_quantile_normal(wide, list(names), n_quantiles)
    own = [n for n, (_, f) in names.items() if f != ALL]
    split = train.select("*", *[F.when(F.col(fold_col) == names[n][1], F.col(names[n][0]).cast("double")).alias(n) for n in own])
    done = apply_quantile_normal(split, {n: params[n] for n in own})
    out = done.select(*[F.coalesce(*[F.col(n) for n in own if names[n][0] == c]).alias(c) if c in cols else F.col(c) for c in train.columns])
    return out, (apply_quantile_normal(test, {c: params[f"{c}__{ALL}"] for c in cols}) if test is not None else None)
