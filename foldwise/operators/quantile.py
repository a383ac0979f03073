"""Exact, interpolated quantiles that never gather a whole column -- or a hot value -- into one task.

``percentile`` (exact) keeps every value of a group in one aggregation buffer, which does
not survive 100 TB.  Instead, for all columns and probabilities at once:

1. one aggregation: count n of values and ``percentile_approx`` brackets [a, b] around every
   needed order statistic (rank error <= n / accuracy, so [p - 2/acc, p + 2/acc] holds it);
2. one aggregation over bucketized values (``Bucketizer`` binary search over the bracket
   bounds): rows per bucket and rows equal to each bound -> count below a, ties at a and b;
3. only rows strictly inside a bracket (a, b) are ranked -- a proven bound of ~4n/accuracy
   rows per bracket; a tie block at a bound (a hot value) is resolved from the counts alone,
   never by sorting it.

Result = linear interpolation between the order statistics around ``p * (n - 1)``, i.e.
numpy's default, DuckDB ``quantile_cont`` and Spark ``percentile``.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


ACCURACY = 10_000      # entries of a partial sketch, so its merge stays small whatever the column
MAX_BAND = 1_000_000  # rows of a bracket that are ranked in one window; a larger bracket is bracketed again
LARGEST = 1.7976931348623157e308  # stands for an infinity, which the bucket search cannot hold


def _merge(intervals):
    """Merge overlapping [a, b] intervals; returns list of (a, b, [member indices])."""
    order = sorted(range(len(intervals)), key=lambda j: intervals[j])
    out = []
    for j in order:
        a, b = intervals[j]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            out[-1][2].append(j)
        else:
            out.append([a, b, [j]])
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = ACCURACY) -> dict:
    """Return {col: [q(p) for p in probs]} (None for a column without values).

    NaN counts as missing, as null does; infinities are values, ordered below and above all others."""
    xs = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    xs = [F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST))) for x in xs]
    n_r = df.agg(*[F.count(x).alias(f"n{i}") for i, x in enumerate(xs)]).collect()[0]
    aggs = []
    for i, x in enumerate(xs):
        # +-(2 ranks of approximation error + 2 ranks for the interpolation neighbours), in probability units
        delta = 2.0 / accuracy + 2.0 / max(1, n_r[f"n{i}"])
        lows = [max(0.0, p - delta) for p in probs]
        highs = [min(1.0, p + delta) for p in probs]
        aggs += [F.count(x).alias(f"n{i}"), F.percentile_approx(x, lows, accuracy).alias(f"lo{i}"),
                 F.percentile_approx(x, highs, accuracy).alias(f"hi{i}")]
    r = df.agg(*aggs).collect()[0]

    plan = {}  # col index -> (n, bands, splits)
    for i in range(len(cols)):
        n = r[f"n{i}"]
        if not n:
            continue
        bands = _merge([(r[f"lo{i}"][j], r[f"hi{i}"][j]) for j in range(len(probs))])
        splits = sorted({v for a, b, _ in bands for v in (a, b)})
        plan[i] = (n, bands, [float("-inf")] + splits + [float("inf")])
    out = {c: [None] * len(probs) for c in cols}
    if not plan:
        return out

    ids = sorted(plan)
    bz = Bucketizer(inputCols=[f"_x{i}" for i in ids], outputCols=[f"_b{i}" for i in ids],
                    splitsArray=[plan[i][2] for i in ids], handleInvalid="keep")
    wide = bz.transform(df.select(*[xs[i].alias(f"_x{i}") for i in ids]))
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("cid"), F.col(f"_x{i}").alias("x"),
                                                   F.col(f"_b{i}").cast("int").alias("bk")) for i in ids])))
    long = long.filter(F.col("x").isNotNull() & ~F.isnan("x"))
    # left split value of every bucket: a small table (<= 2 x probs + 2 rows per column), broadcast
    lefts = df.sparkSession.createDataFrame([(i, t, float(v)) for i in ids for t, v in enumerate(plan[i][2])],
                                            "cid int, bk int, left double")
    counts = (long.join(F.broadcast(lefts), ["cid", "bk"]).groupBy("cid", "bk")
              .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("x") == F.col("left")).cast("long")).alias("eq")).collect())
    cnt = {(c["cid"], c["bk"]): (c["n"], c["eq"]) for c in counts}

    need = []       # (cid, band, local rank)
    resolved = {}   # (cid, k) -> value
    tasks = []      # (i, j, pos, k_lo, k_hi)
    band_ranges = []
    inner = {}      # (i, band) -> rows strictly inside
    for i in ids:
        n, bands, splits = plan[i]
        idx = {v: t for t, v in enumerate(splits)}
        below = []  # below[t] = rows in buckets < t
        acc = 0
        for t in range(len(splits)):
            below.append(acc)
            acc += cnt.get((i, t), (0, 0))[0]
        for m, (a, b, members) in enumerate(bands):
            ia, ib = idx[a], idx[b]
            lt_a, eq_a = below[ia], cnt.get((i, ia), (0, 0))[1]
            eq_b = cnt.get((i, ib), (0, 0))[1]
            le_b = below[ib] + eq_b
            band_ranges.append((i, m, ia, ib, a))
            inner[(i, m)] = below[ib] - lt_a - eq_a
            for j in members:
                pos = probs[j] * (n - 1)
                if abs(pos - round(pos)) <= 1e-9 * n:  # a whole rank, but for rounding
                    pos = float(round(pos))
                k_lo, k_hi = int(math.floor(pos)), int(math.ceil(pos))
                tasks.append((i, j, pos, k_lo, k_hi))
                for k in (k_lo, k_hi):
                    if k < lt_a or k >= le_b:
                        raise RuntimeError("quantile bracket missed its rank; raise accuracy")
                    if k < lt_a + eq_a:
                        resolved[(i, k)] = a
                    elif k >= le_b - eq_b:
                        resolved[(i, k)] = b
                    else:
                        need.append((i, m, k - (lt_a + eq_a), k))
    if need:
        spark = df.sparkSession
        # band id of a bucket: buckets ia..ib-1 of band m (rows == a excluded below)
        band_of = {}
        for i, m, ia, ib, a in band_ranges:
            for t in range(ia, ib):
                band_of[(i, t)] = (m, a)
        keys = spark.createDataFrame([(i, t, m, float(a)) for (i, t), (m, a) in band_of.items()],
                                     "cid int, bk int, band int, a double")
        inside = long.join(F.broadcast(keys), ["cid", "bk"]).filter(F.col("x") > F.col("a"))
        for i, m in sorted({(i, m) for i, m, _, _ in need if inner[(i, m)] > MAX_BAND}):
            ranks = [(rk, k) for i2, m2, rk, k in need if (i2, m2) == (i, m)]
            part = inside.filter((F.col("cid") == i) & (F.col("band") == m))
            size = inner[(i, m)]
            found = exact_quantiles(part, ["x"], [rk / (size - 1) for rk, _ in ranks], accuracy)["x"]
            resolved.update({(i, k): v for (_, k), v in zip(ranks, found)})
            need = [x for x in need if (x[0], x[1]) != (i, m)]
    if need:
        w = Window.partitionBy("cid", "band").orderBy("x")  # at most MAX_BAND rows, strictly inside one bracket
        want = spark.createDataFrame([(i, m, rk, k) for i, m, rk, k in need], "cid int, band int, rk long, k long")
        got = (inside.withColumn("rk", F.row_number().over(w) - 1)
               .join(F.broadcast(want), ["cid", "band", "rk"]).select("cid", "k", "x").collect())
        for g in got:
            resolved[(g["cid"], g["k"])] = g["x"]
    for i, j, pos, k_lo, k_hi in tasks:
        v_lo, v_hi = (math.copysign(math.inf, v) if abs(v) == LARGEST else v for v in (resolved[(i, k_lo)], resolved[(i, k_hi)]))
        out[cols[i]][j] = v_lo if pos == k_lo or v_lo == v_hi else v_lo + (pos - k_lo) * (v_hi - v_lo)
    return out


def exact_median(df: DataFrame, cols: list[str]) -> dict:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5]).items()}
