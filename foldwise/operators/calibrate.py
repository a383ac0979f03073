"""Sigmoid calibration of margins (M9): p = 1 / (1 + exp(-(a m + b))), one pair (a, b) per group, all groups at once.

Targets are smoothed: (n1 + 1) / (n1 + 2) for rows of class 1 and 1 / (n0 + 2) for those of class 0, n1 and n0 counted by group.  Each Newton
step is one grouped aggregation with native expressions; the pairs join the rows as a literal map, sized by the number of groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import sigmoid


def _by_group(key: Column, values: dict) -> Column:
    """The value of each row's group, from a map with one entry per group."""
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))])[key]


def fit(rows: DataFrame, group: str, margin: str, label: str, steps: int = 50, tolerance: float = 1e-10, damping: float = 1e-12) -> dict:
    """group -> (a, b).  Starts from a = 0 and the logarithm of the groups' odds; a step that would raise a group's loss is halved until
    it does not.  Rows without margin or label have no part; a group of one class gets a finite pair, thanks to the smoothed targets."""
    rows = rows.select(F.col(group).alias("g"), F.col(margin).cast("double").alias("m"), F.col(label).cast("int").alias("y")).filter("g IS NOT NULL AND m IS NOT NULL AND y IS NOT NULL AND NOT isnan(m)")
    n = {r["g"]: (r["n0"], r["n1"]) for r in rows.groupBy("g").agg(F.count(F.when(F.col("y") != 1, 1)).alias("n0"), F.count(F.when(F.col("y") == 1, 1)).alias("n1")).collect()}  # a row per group
    if not n:
        return {}
    t = F.when(F.col("y") == 1, _by_group(F.col("g"), {g: (b + 1) / (b + 2) for g, (_, b) in n.items()})).otherwise(_by_group(F.col("g"), {g: 1 / (a + 2) for g, (a, _) in n.items()}))
    rows = rows.withColumn("t", t)
    now = {g: np.array([0.0, np.log((b + 1) / (a + 1))]) for g, (a, b) in n.items()}
    step = {g: np.zeros(2) for g in n}
    best, done = dict.fromkeys(n, np.inf), set()
    for _ in range(steps):
        z = _by_group(F.col("g"), {g: v[0] for g, v in now.items()}) * F.col("m") + _by_group(F.col("g"), {g: v[1] for g, v in now.items()})
        p = 1 / (1 + F.exp(-F.col("z")))
        e, w = p - F.col("t"), p * (1 - p)
        loss = F.greatest("z", F.lit(0.0)) - F.col("t") * F.col("z") + F.log1p(F.exp(-F.abs("z")))
        # the aggregation reads the rows once for all groups
        sums = rows.withColumn("z", z).groupBy("g").agg(F.sum(loss).alias("loss"), F.sum(e * F.col("m")).alias("ga"), F.sum(e).alias("gb"), F.sum(w * F.col("m") * F.col("m")).alias("haa"), F.sum(w * F.col("m")).alias("hab"), F.sum(w).alias("hbb")).collect()
        for r in sums:
            g = r["g"]
            if g in done:
                continue
            if r["loss"] > best[g] + 1e-9 * abs(best[g]):  # too far: half the way back
                step[g] = step[g] / 2
                now[g] = now[g] - step[g]
                continue
            best[g] = r["loss"]
            grad = np.array([r["ga"], r["gb"]])
            if np.abs(grad).max() <= tolerance * sum(n[g]):
                done.add(g)
                continue
            hess = np.array([[r["haa"], r["hab"]], [r["hab"], r["hbb"]]]) + damping * np.eye(2)
            step[g] = -np.linalg.solve(hess, grad)
            now[g] = now[g] + step[g]
        if len(done) == len(n):
            break
    return {g: (float(v[0]), float(v[1])) for g, v in now.items()}


def apply(margin: Column, pair: tuple[float, float]) -> Column:
    """Calibrated probability of class 1."""
    return sigmoid(margin * F.lit(pair[0]) + F.lit(pair[1]), clip=700.0)
