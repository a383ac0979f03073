"""Numeric scalers and transforms fitted on training rows.

Fit = one aggregation (or the exact-quantile routine) -> a few numbers per column;
apply = one projection of column expressions, so all columns are scaled in a single
``select`` and the plan stays flat.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.quantile import exact_quantiles


def fit_standard(train: DataFrame, cols: list[str]) -> dict:
    """Mean and POPULATION standard deviation (a zero sd becomes 1, as the reference scaler)."""
    r = train.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).collect()[0]
    return {c: (r[f"m_{c}"], r[f"s_{c}"] if r[f"s_{c}"] else 1.0) for c in cols}


def fit_robust(train: DataFrame, cols: list[str]) -> dict:
    """Exact median and interquartile range (q75 - q25; zero -> 1)."""
    q = exact_quantiles(train, cols, [0.25, 0.5, 0.75])
    return {c: (q[c][1], (q[c][2] - q[c][0]) or 1.0) for c in cols}


def apply_center_scale(df: DataFrame, params: dict, suffix: str = "") -> DataFrame:
    """Apply (x - center) / scale for every fitted column in one projection."""
    rep = {c: ((F.col(c) - F.lit(m)) / F.lit(s)).alias(c + suffix) for c, (m, s) in params.items()}
    if suffix:
        return df.select("*", *rep.values())
    return df.select(*[rep.get(c, F.col(c)) for c in df.columns])


def pairwise_products(df: DataFrame, cols: list[str], fmt: str = "{a}_x_{b}") -> tuple[DataFrame, list[str]]:
    """Degree-2 interaction-only products, no bias and no squares (n(n-1)/2 columns)."""
    names, exprs = [], []
    for a, b in combinations(cols, 2):
        n = fmt.format(a=a, b=b)
        names.append(n)
        exprs.append((F.col(a) * F.col(b)).alias(n))
    return df.select("*", *exprs), names


def jitter(df: DataFrame, cols: list[str], sd: float = 0.003, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Gaussian noise on training features, repeatable in any engine: the normal draw is made from 52 bits of
    ``md5('<seed>:<id>:<column>:<1 or 2>')`` through the Box-Muller transform, so a recomputed partition gets the same noise
    (``randn`` depends on partitioning)."""
    bits = lambda c, k: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), F.lit(c), F.lit(str(k)))), 1, 13), 16, 10).cast("double")
    out = {}
    for c in cols:
        u1 = (bits(c, 1) + 1) / F.lit(float(2**52 + 1))
        u2 = bits(c, 2) / F.lit(float(2**52))
        z = F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * 3.141592653589793 * u2)
        out[c] = (F.col(c) + F.lit(sd) * z).alias(c)
    return df.select(*[out.get(c, F.col(c)) for c in df.columns])


# ---- N8: quantile transform to a normal distribution -----------------------------------------

BOUNDS_THRESHOLD = 1e-7  # fixed value of the reference transformer


def fit_quantile_normal(train: DataFrame, cols: list[str], n_quantiles: int = 1000) -> dict:
    """Exact quantiles at ``linspace(0, 1, min(n_quantiles, n))`` per column, reduced to the distinct
    quantile values with the first and last reference level of each (tied quantiles)."""
    import numpy as np
    counts = train.agg(*[F.count(c).alias(c) for c in cols]).collect()[0]
    out, found = {}, {}
    for nq in {min(n_quantiles, counts[c]) for c in cols}:  # one round of passes for all columns with as many quantiles
        found |= exact_quantiles(train, [c for c in cols if min(n_quantiles, counts[c]) == nq], np.linspace(0.0, 1.0, nq).tolist())
    for c in cols:
        q = found[c]
        refs = np.linspace(0.0, 1.0, len(q)).tolist()
        u, rlo, rhi = [], [], []
        for v, r in zip(q, refs):
            if u and v == u[-1]:
                rhi[-1] = r
            else:
                u.append(v)
                rlo.append(r)
                rhi.append(r)
        out[c] = (u, rlo, rhi)
    return out


def apply_quantile_normal(df: DataFrame, params: dict) -> DataFrame:
    """Map each value to its interpolated reference level (the mean of the left and right
    interpolation on tied quantiles), then through the inverse normal CDF, clipped at
    ``ppf(1e-7 - eps)``.  The segment is found by ``Bucketizer`` (binary search over the
    quantiles) and its end points come from a broadcast equi-join on the segment index."""
    from statistics import NormalDist

    from pyspark.ml.feature import Bucketizer

    from foldwise.functions.normal import with_inv_norm_cdf
    clip = -NormalDist().inv_cdf(BOUNDS_THRESHOLD - 2.220446049250313e-16)
    spark = df.sparkSession
    cols = list(params)
    bz = Bucketizer(inputCols=cols, outputCols=[f"_qb_{c}" for c in cols],
                    splitsArray=[[float("-inf")] + params[c][0] + [float("inf")] for c in cols], handleInvalid="keep")
    out = bz.transform(df)
    for c in cols:
        u, rlo, rhi = params[c]
        seg = spark.createDataFrame(
            [(m, float(u[m]), float(rlo[m]), float(rhi[m]),
              float(u[m + 1]) if m + 1 < len(u) else None, float(rlo[m + 1]) if m + 1 < len(u) else None)
             for m in range(len(u))], f"_m int, _u double, _rlo double, _rhi double, _u2 double, _rlo2 double")
        out = out.join(F.broadcast(seg), F.col(f"_qb_{c}").cast("int") - 1 == F.col("_m"), "left")  # <= n_quantiles rows
        x = F.col(c).cast("double")
        mid = F.when(x == F.col("_u"), (F.col("_rlo") + F.col("_rhi")) / 2.0).otherwise(
            F.col("_rhi") + (x - F.col("_u")) / (F.col("_u2") - F.col("_u")) * (F.col("_rlo2") - F.col("_rhi")))
        level = (F.when(x - BOUNDS_THRESHOLD < F.lit(u[0]), F.lit(0.0))
                 .when(x + BOUNDS_THRESHOLD > F.lit(u[-1]), F.lit(1.0)).otherwise(mid))
        out = with_inv_norm_cdf(out.withColumn("_lv", level), "_lv", "_z")
        lv, z = F.col("_lv"), F.col("_z")
        z = F.when(lv <= 0.0, F.lit(-clip)).when(lv >= 1.0, F.lit(clip)).otherwise(
            F.greatest(F.least(z, F.lit(clip)), F.lit(-clip)))
        out = out.withColumn(c, F.when(x.isNull(), F.lit(None).cast("double")).otherwise(z)).drop(
            "_m", "_u", "_rlo", "_rhi", "_u2", "_rlo2", "_lv", "_z")
    return out.select(*df.columns)


# ---- N9: Yeo-Johnson power transform -----------------------------------------------------------

def yeo_johnson(x, lam: float):
    """Column expression of the Yeo-Johnson transform for a fixed lambda."""
    x = F.col(x) if isinstance(x, str) else x
    pos = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    neg = -F.log1p(-x) if abs(lam - 2.0) < 1e-12 else -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def _yj_grid_best(train: DataFrame, grids: dict[str, list[float]]) -> dict[str, float | None]:
    """Maximum-likelihood lambda of each column over its grid, all columns and grid points in ONE pass (population variance of every
    candidate transform, merged over batches and tasks); first grid point wins ties."""
    cols = list(grids)

    def moments(x, lams):
        """Rows, sum of the signed logarithms, and mean and sum of squared distances of every transform."""
        up = x >= 0
        a, b = x[up] + 1.0, 1.0 - x[~up]
        mean, far = np.zeros((2, len(lams)))
        for i, lam in enumerate(lams):
            y = np.concatenate([np.log(a) if abs(lam) < 1e-12 else (a**lam - 1.0) / lam, -np.log(b) if abs(lam - 2.0) < 1e-12 else -(b ** (2.0 - lam) - 1.0) / (2.0 - lam)])
            mean[i] = y.mean()
            far[i] = ((y - mean[i]) ** 2).sum()
        return np.concatenate([[len(x), (np.sign(x) * np.log1p(np.abs(x))).sum()], mean, far])

    def merged(p, q, k):
        if p is None:
            return q
        n = p[0] + q[0]
        gap = q[2 : 2 + k] - p[2 : 2 + k]
        return np.concatenate([[n, p[1] + q[1]], p[2 : 2 + k] + gap * q[0] / n, p[2 + k :] + q[2 + k :] + gap**2 * p[0] * q[0] / n])

    def part(batches):
        sums: dict[int, np.ndarray] = {}
        with np.errstate(all="ignore"):
            for b in batches:
                for i, c in enumerate(cols):
                    x = b.column(f"c{i}").drop_null().to_numpy()
                    if len(x):
                        sums[i] = merged(sums.get(i), moments(x, grids[c]), len(grids[c]))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["i", "v"])

    rows = train.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    total: dict[int, np.ndarray] = {}
    with np.errstate(all="ignore"):
        for r in rows.mapInArrow(part, "i int, v binary").collect():  # a row per task and column
            total[r["i"]] = merged(total.get(r["i"]), np.frombuffer(r["v"], float), len(grids[cols[r["i"]]]))
    out = {}
    for j, c in enumerate(cols):
        best, best_ll, k = None, None, len(grids[c])
        for i, lam in enumerate(grids[c]):
            v = total[j][2 + k + i] / total[j][0] if j in total else None
            if v is None or v <= 0:
                continue
            ll = -total[j][0] / 2.0 * math.log(v) + (lam - 1.0) * total[j][1]
            if best_ll is None or ll > best_ll:
                best, best_ll = lam, ll
        out[c] = best
    return out


def fit_yeo_johnson(train: DataFrame, cols: list[str]) -> dict:
    """Lambda by maximum likelihood (grid -3..3 step 0.1, moved on while its best point is an end, then +-0.1 step 0.005),
    then the mean and population sd of the transformed training column (standardize=True).  A constant or empty column keeps 1.
    A pass serves all columns."""
    out = {}
    x = {c: F.col(c).cast("double") for c in cols}
    ends = train.agg(*[f(x[c]).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("a", F.min), ("b", F.max))]).first()
    for i, c in enumerate(cols):
        if ends[f"a{i}"] is None or ends[f"a{i}"] == ends[f"b{i}"]:
            out[c] = (1.0, ends[f"a{i}"] or 0.0, 1.0)
    low, found = {c: -3.0 for c in cols if c not in out}, {}
    while low:
        coarse = {c: [round(v + 0.1 * i, 10) for i in range(61)] for c, v in low.items()}
        for c, l0 in _yj_grid_best(train, coarse).items():
            if l0 is None or coarse[c][0] < l0 < coarse[c][-1] or abs(low[c]) > 60:
                found[c] = 1.0 if l0 is None else l0  # None: no transform has a variance
                del low[c]
            else:
                low[c] += 3.0 if l0 == coarse[c][-1] else -3.0
    if found:
        fine = _yj_grid_best(train, {c: [round(l0 - 0.1 + 0.005 * i, 10) for i in range(41)] for c, l0 in found.items()})
        r = train.agg(*[f(yeo_johnson(c, fine[c])).alias(f"{n}{i}") for i, c in enumerate(found) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        out |= {c: (fine[c], r[f"m{i}"], r[f"s{i}"] or 1.0) for i, c in enumerate(found)}
    return {c: out[c] for c in cols}


def apply_yeo_johnson(df: DataFrame, params: dict) -> DataFrame:
    rep = {c: ((yeo_johnson(c, lam) - F.lit(m)) / F.lit(s)).alias(c) for c, (lam, m, s) in params.items()}
    return df.select(*[rep.get(c, F.col(c)) for c in df.columns])
