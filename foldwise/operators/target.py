"""Out-of-fold target encoders.

Fit aggregates the training rows ONCE into ``(col, value, fold, n, s)`` for all
encoded columns together (map-side partial aggregation, one shuffle).  The
out-of-fold statistics of fold f are the column totals minus fold f's own cell,
taken with a window over the tiny ``(col, value)`` groups; no per-fold loop, no
self-join.  The ``(col, value) x fold`` grid is completed first so a value absent
from a fold still gets that fold's encoding (needed for fold-averaged test values).

Apply is a join of the rows with the fitted dimension on (value, fold) for train
rows and on value for test rows, followed by ``coalesce`` with the fill value.

Encoder kinds (all priors are the mean over ALL training rows unless noted):

* ``mestimate`` (T2/T3): ``(s_oof + prior*m) / (n_oof + m)``
* ``sigmoid``   (T1/T7): ``w = 1/(1+exp(-(n_oof-min_leaf)/smoothing))``,
  ``prior_f*(1-w) + mean_oof*w`` where prior_f is the mean of the training part of
  the fold; values unseen in the training part get the global mean
* ``mean``      (T4):    ``mean_oof``, unseen -> global mean
* ``mean_catmean`` (T5): ``mean_oof``, unseen -> mean of that fold's category means
* multiclass (T6): ``P(class | value)`` over the training part, unseen -> ``1/K``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import cut_lineage, join_dim


def _long_values(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Stack several categorical columns into (col, value) rows; nulls kept (they never match)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(*keep, F.inline(pairs))


@dataclass
class TargetEncoding:
    cols: list[str]
    fold_col: str
    suffix: str
    oof_dim: DataFrame   # col, value, fold, enc     (train rows)
    test_dim: DataFrame  # col, value, enc           (test rows)
    fill_fold: dict      # (col, fold) -> fill for train rows without a match
    fill_test: dict      # col -> fill for test rows without a match
    dim_rows: int

    def apply_oof(self, train: DataFrame) -> DataFrame:
        out = train
        fill = F.create_map(*[x for (c, f), v in sorted(self.fill_fold.items()) for x in (F.lit(f"{c}|{f}"), F.lit(float(v)))])
        for c in self.cols:
            d = self.oof_dim.filter(F.col("col") == c).select(
                F.col("value").alias("_v"), F.col("fold").alias("_f"), F.col("enc").alias("_e"))
            out = join_dim(out, d, on=(F.col(c).cast("string") == F.col("_v")) & (F.col(self.fold_col) == F.col("_f")),
                           how="left", dim_rows=self.dim_rows)
            key = F.concat(F.lit(c + "|"), F.col(self.fold_col).cast("string"))
            out = out.withColumn(c + self.suffix, F.coalesce(F.col("_e"), fill[key])).drop("_v", "_f", "_e")
        return out

    def apply_test(self, test: DataFrame) -> DataFrame:
        out = test
        for c in self.cols:
            d = self.test_dim.filter(F.col("col") == c).select(F.col("value").alias("_v"), F.col("enc").alias("_e"))
            out = join_dim(out, d, on=F.col(c).cast("string") == F.col("_v"), how="left", dim_rows=self.dim_rows)
            out = out.withColumn(c + self.suffix, F.coalesce(F.col("_e"), F.lit(float(self.fill_test[c])))).drop("_v", "_e")
        return out


def _fold_totals(train: DataFrame, y: str, fold_col: str) -> list:
    return train.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("double")).alias("s")).collect()


def fit_target_encoder(train: DataFrame, cols: list[str], y: str = "y", fold_col: str = "fold",
                       kind: str = "mestimate", m: float = 1.0, min_leaf: float = 100.0, smoothing: float = 10.0,
                       test_mode: str = "fold_mean", prior_scope: str = "train", suffix: str = "_te") -> TargetEncoding:
    """Fit a binary / numeric-target encoder on ``train`` (which carries ``fold_col``)."""
    # k rows only: the per-fold totals give the global prior and each fold's training-part prior
    tot = {r[fold_col]: (r["n"], r["s"]) for r in _fold_totals(train, y, fold_col)}
    folds = sorted(tot)
    n_all = sum(v[0] for v in tot.values())
    s_all = sum(v[1] for v in tot.values())
    g = s_all / n_all
    # a single fold has no training part: its prior is the global one
    g_fold = {f: (s_all - tot[f][1]) / (n_all - tot[f][0]) if n_all > tot[f][0] else g for f in folds}

    stats = (
        _long_values(train, cols, [fold_col, y])
        .filter(F.col("value").isNotNull())
        .groupBy("col", "value", F.col(fold_col).alias("fold"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("double")).alias("s"))
    )
    # complete (value x fold) grid: each distinct value expanded to the k fold ids in-task
    g_map = F.create_map(*[x for f in folds for x in (F.lit(int(f)), F.lit(float(g_fold[f])))])
    grid = (stats.select("col", "value").distinct()
            .withColumn("fold", F.explode(F.array(*[F.lit(int(f)) for f in folds])))
            .withColumn("g_fold", g_map[F.col("fold")]))
    cell = grid.join(stats, ["col", "value", "fold"], "left").fillna(0, subset=["n", "s"])
    w = Window.partitionBy("col", "value")
    cell = cell.withColumn("n_oof", F.sum("n").over(w) - F.col("n")).withColumn("s_oof", F.sum("s").over(w) - F.col("s"))
    cell = cell.withColumn("n_tot", F.sum("n").over(w)).withColumn("s_tot", F.sum("s").over(w))

    prior = F.col("g_fold") if prior_scope == "fold" else F.lit(g)
    mean_oof = F.try_divide(F.col("s_oof"), F.col("n_oof"))
    if kind == "mestimate":
        enc = (F.col("s_oof") + prior * F.lit(m)) / (F.col("n_oof") + F.lit(m))
        full = (F.col("s_tot") + F.lit(g) * F.lit(m)) / (F.col("n_tot") + F.lit(m))
    elif kind == "sigmoid":
        wt = 1.0 / (1.0 + F.exp(-(F.col("n_oof") - F.lit(min_leaf)) / F.lit(smoothing)))
        enc = F.when(F.col("n_oof") > 0, F.col("g_fold") * (1 - wt) + mean_oof * wt).otherwise(F.lit(g))
        wt_full = 1.0 / (1.0 + F.exp(-(F.col("n_tot") - F.lit(min_leaf)) / F.lit(smoothing)))
        full = F.lit(g) * (1 - wt_full) + F.try_divide(F.col("s_tot"), F.col("n_tot")) * wt_full
    elif kind in ("mean", "mean_catmean"):
        enc = mean_oof
        full = F.try_divide(F.col("s_tot"), F.col("n_tot"))
    else:
        raise ValueError(f"unknown kind {kind}")
    cell = cell.withColumn("enc", enc).withColumn("enc_full", full)

    # fill values for rows whose value has no out-of-fold statistic
    if kind == "mean_catmean":
        cm = {(r["col"], r["fold"]): r["cm"] for r in
              cell.filter(F.col("n_oof") > 0).groupBy("col", "fold").agg(F.avg("enc").alias("cm")).collect()}
        fill_fold = {(c, f): cm.get((c, f), g) for c in cols for f in folds}
        cm_full = {r["col"]: r["cm"] for r in
                   cell.filter(F.col("fold") == folds[0]).groupBy("col").agg(F.avg("enc_full").alias("cm")).collect()}
        fill_full = {c: cm_full.get(c, g) for c in cols}
    else:
        fill_fold = {(c, f): g for c in cols for f in folds}
        fill_full = {c: g for c in cols}
    fill_map = F.create_map(*[x for (c, f), v in sorted(fill_fold.items()) for x in (F.lit(f"{c}|{f}"), F.lit(float(v)))])
    cell = cell.withColumn("enc", F.coalesce(F.col("enc"), fill_map[F.concat(F.col("col"), F.lit("|"), F.col("fold").cast("string"))]))

    oof_dim = cut_lineage(cell.select("col", "value", "fold", "enc", "enc_full"))
    dim_rows = oof_dim.count()
    if test_mode == "fold_mean":
        test_dim = oof_dim.groupBy("col", "value").agg(F.avg("enc").alias("enc"))
        fill_test = {c: sum(fill_fold[(c, f)] for f in folds) / len(folds) for c in cols}
    elif test_mode == "full":
        test_dim = oof_dim.filter(F.col("fold") == folds[0]).select("col", "value", F.col("enc_full").alias("enc"))
        fill_test = fill_full
    else:
        raise ValueError(f"unknown test_mode {test_mode}")
    return TargetEncoding(cols, fold_col, suffix, oof_dim.select("col", "value", "fold", "enc"), test_dim,
                          fill_fold, fill_test, dim_rows)


@dataclass
class MulticlassTargetEncoding:
    cols: list[str]
    fold_col: str
    k: int
    oof_dim: DataFrame   # col, value, fold, p array<double>
    test_dim: DataFrame  # col, value, p array<double>
    dim_rows: int

    def _expand(self, df: DataFrame, c: str) -> DataFrame:
        uniform = F.array(*[F.lit(1.0 / self.k) for _ in range(self.k)])
        p = F.coalesce(F.col("_p"), uniform)
        return df.select("*", *[p[i].alias(f"{c}_te_{i}") for i in range(self.k)]).drop("_v", "_f", "_p")

    def apply_oof(self, train: DataFrame) -> DataFrame:
        out = train
        for c in self.cols:
            d = self.oof_dim.filter(F.col("col") == c).select(F.col("value").alias("_v"), F.col("fold").alias("_f"), F.col("p").alias("_p"))
            out = join_dim(out, d, on=(F.col(c).cast("string") == F.col("_v")) & (F.col(self.fold_col) == F.col("_f")),
                           how="left", dim_rows=self.dim_rows)
            out = self._expand(out, c)
        return out

    def apply_test(self, test: DataFrame) -> DataFrame:
        out = test
        for c in self.cols:
            d = self.test_dim.filter(F.col("col") == c).select(F.col("value").alias("_v"), F.col("p").alias("_p"))
            out = join_dim(out, d, on=F.col(c).cast("string") == F.col("_v"), how="left", dim_rows=self.dim_rows)
            out = self._expand(out, c)
        return out


def fit_multiclass_target_encoder(train: DataFrame, cols: list[str], y: str, k: int, fold_col: str = "fold") -> MulticlassTargetEncoding:
    """K columns ``P(class | value)`` from the training part of each fold; test = fold average."""
    stats = (
        _long_values(train, cols, [fold_col, y])
        .filter(F.col("value").isNotNull())
        .groupBy("col", "value", F.col(fold_col).alias("fold"))
        .agg(*[F.sum((F.col(y) == i).cast("long")).alias(f"c{i}") for i in range(k)])
    )
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    grid = (stats.select("col", "value").distinct()
            .withColumn("fold", F.explode(F.array(*[F.lit(int(f)) for f in folds]))))
    cell = grid.join(stats, ["col", "value", "fold"], "left").fillna(0)
    w = Window.partitionBy("col", "value")
    oof = [F.sum(f"c{i}").over(w) - F.col(f"c{i}") for i in range(k)]
    cell = cell.select("col", "value", "fold", F.array(*oof).alias("cnt"))
    n = F.aggregate("cnt", F.lit(0).cast("long"), lambda a, x: a + x)
    p = F.when(n > 0, F.transform("cnt", lambda x: x / n)).otherwise(F.array(*[F.lit(1.0 / k) for _ in range(k)]))
    oof_dim = cut_lineage(cell.select("col", "value", "fold", p.alias("p")))
    dim_rows = oof_dim.count()
    # fold-average: every (value, fold) cell exists, so the sum over the k cells / k is the mean
    test_dim = (oof_dim.select("col", "value", F.posexplode("p").alias("cls", "pc"))
                .groupBy("col", "value", "cls").agg(F.avg("pc").alias("pc"))
                .groupBy("col", "value").agg(F.sort_array(F.collect_list(F.struct("cls", "pc"))).alias("_l"))
                .select("col", "value", F.transform("_l", lambda s: s["pc"]).alias("p")))
    return MulticlassTargetEncoding(cols, fold_col, k, oof_dim, test_dim, dim_rows)
