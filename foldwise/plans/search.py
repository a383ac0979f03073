"""Weight searches over stored OOF scores (K9-K11) in ONE pass per candidate set.

Candidate weight vectors are a parameter-sized literal (grid or Dirichlet draws made
on the driver from a seeded generator); every batch of scored rows is multiplied with them
inside the task, which sends one row of hits per candidate, so the shuffle is
(candidates x partitions) rows however many rows are scored.  The winner is the best
score, first candidate on ties (strict improvement in candidate order).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.rank import best_by
from foldwise.session import stage_spread


def wide_scores(pred: DataFrame, models: list[str], cls: int = 1, id_col: str = "id") -> DataFrame:
    """Long (id, model, class, p) -> (id, p_<model>...) for one class, explicit model order."""
    # one exchange by id; a pivot takes another one by id and model before it
    return pred.filter(F.col("class") == cls).groupBy(id_col).agg(*[F.first(F.when(F.col("model") == m, F.col("p")), ignorenulls=True).alias(f"p_{m}") for m in models])


def score_candidates(scored: DataFrame, models: list[str], y: str, candidates: list[list[float]],
                     threshold: float = 0.5) -> DataFrame:
    """(wid, accuracy) of ``sum_m w_m p_m >= threshold`` against y (0/1) for every candidate; a row without a label or a score is an error."""
    w = np.asarray(candidates, float)
    block = min(255, max(1, (1 << 18) // max(len(w), 1)))  # its hits fit a byte, its numbers the cache
    cols = [F.col(f"p_{m}").cast("double").alias(f"p{i}") for i, m in enumerate(models)]

    def hits(batches):
        """Per batch one row per candidate: rows are never multiplied by the candidates outside a small block."""
        total, n = np.zeros(len(w), np.int64), 0
        blends, parts = np.empty((2, block, len(w)))
        for b in batches:
            if any(c.null_count for c in b.columns):
                raise ValueError("a row lacks its label or the score of a model")
            truth = np.asarray(b.column("_y"))
            p = [np.asarray(b.column(f"p{i}")) for i in range(len(models))]
            for k in range(0, len(truth), block):
                y1 = truth[k : k + block] == 1
                blend, part = blends[: len(y1)], parts[: len(y1)]
                blend[:] = 0
                for i, x in enumerate(p):  # the order of the sums is that of the models
                    blend += np.multiply(x[k : k + block, None], w[None, :, i], out=part)
                right = (blend >= threshold) == y1[:, None]
                total += np.add.reduce(right.view(np.uint8), axis=0, dtype=np.uint8)
            n += len(truth)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w), dtype=np.int32)), pa.array(total), pa.array(np.full(len(w), n))], ["wid", "hits", "n"])

    rows = scored.select(F.col(y).cast("double").alias("_y"), *cols)
    return stage_spread(rows).mapInArrow(hits, "wid int, hits long, n long").groupBy("wid").agg((F.sum("hits") / F.sum("n")).alias("accuracy"))


def grid_2d(step_den: int = 20, lo=(0, 0), hi=None, total: int | None = None) -> list[tuple[int, int]]:
    """Integer grid (i, j) for weights (i/den, j/den) with i + j <= total, in loop order (i outer)."""
    total = step_den if total is None else total
    hi = hi or (step_den, step_den)
    return [(i, j) for i in range(lo[0], hi[0] + 1) for j in range(lo[1], hi[1] + 1) if i + j <= total]


def grid_search(scored: DataFrame, models: list[str], y: str, den: int = 20, refine_den: int = 100,
                refine_radius: int = 10) -> DataFrame:
    """K9 coarse grid (step 1/den, w1 + w2 <= 1) then K10 refinement (step 1/refine_den, +-radius steps)."""
    g1 = grid_2d(den)
    s1 = score_candidates(scored, models, y, [[i / den, j / den] for i, j in g1])
    b1 = best_by(s1, "accuracy", ["wid"]).collect()[0]
    i0, j0 = g1[b1["wid"]]
    f = refine_den // den
    a0, c0 = i0 * f, j0 * f
    g2 = grid_2d(refine_den, (max(0, a0 - refine_radius), max(0, c0 - refine_radius)),
                 (min(refine_den, a0 + refine_radius), min(refine_den, c0 + refine_radius)), refine_den)
    s2 = score_candidates(scored, models, y, [[i / refine_den, j / refine_den] for i, j in g2])
    b2 = best_by(s2, "accuracy", ["wid"]).collect()[0]
    i1, j1 = g2[b2["wid"]]
    spark = scored.sparkSession
    return spark.createDataFrame(
        [("coarse", float(i0 / den), float(j0 / den), float(b1["accuracy"])),
         ("refine", float(i1 / refine_den), float(j1 / refine_den), float(b2["accuracy"]))],
        "stage string, w_a double, w_b double, accuracy double")


def dirichlet_draws(n_models: int, n_draws: int, seed: int = 42) -> list[list[float]]:
    """K11 candidates: Dirichlet(1, ..., 1) draws from numpy's default_rng(seed), in draw order."""
    rng = np.random.default_rng(seed)
    return [rng.dirichlet(np.ones(n_models)).tolist() for _ in range(n_draws)]


def dirichlet_search(scored: DataFrame, models: list[str], y: str, n_draws: int = 10_000, seed: int = 42) -> DataFrame:
    """Best of ``n_draws`` random weight vectors (strict improvement = first on ties)."""
    draws = dirichlet_draws(len(models), n_draws, seed)
    s = score_candidates(scored, models, y, draws)
    best = best_by(s, "accuracy", ["wid"]).first()  # one row
    row = (best["wid"], best["accuracy"], *draws[best["wid"]])
    return scored.sparkSession.createDataFrame([row], "wid int, accuracy double, " + ", ".join(f"w_{m} double" for m in models))
