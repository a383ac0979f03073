"""Out-of-fold stacking with distributed learners.

The fold loop runs on the driver (k iterations, bounded); each fit is a distributed
``pyspark.ml`` job over the rows of the other folds.  Predictions are a long table
``(id, model, fold, class, p)``; test predictions are fold-averaged (``test_mode =
'fold_mean'``) or come from one refit on all training rows (``'refit'``, K4 / M23).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.arrays import softmax
from foldwise.functions.columns import sigmoid
from foldwise.operators import boost, calibrate, linear_svm, logistic, random_forest
from foldwise.operators.folds import stratified_kfold
from foldwise.session import cut_lineage


def assemble(df: DataFrame, features: list[str], y: str | None, id_col: str = "id", fold_col: str | None = "fold",
             extra: list[str] | None = None) -> DataFrame:
    """Feature vector + label (+ fold, weight) -- the model input table."""
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    cols = [F.col(id_col).alias("id"), "features"]
    if y is not None:
        cols.append(F.col(y).cast("double").alias("label"))
    if fold_col is not None and fold_col in df.columns:
        cols.append(F.col(fold_col).alias("fold"))
    cols += extra or []
    return va.transform(df).select(*cols)


def proba(pred: DataFrame, kind: str, k: int) -> DataFrame:
    """(id, ..., class, p) from a model output: ``probability`` vectors, binary margins -> sigmoid,
    K margins (one-vs-rest) -> soft-max."""
    if kind == "probability":
        arr = vector_to_array("probability")
    elif kind == "margin_sigmoid":
        m = vector_to_array("rawPrediction")[1]
        p1 = sigmoid(m, clip=20.0)
        arr = F.array(1 - p1, p1)
    elif kind == "margin_softmax":
        arr = softmax(vector_to_array("rawPrediction"))
    else:
        raise ValueError(kind)
    keep = [c for c in pred.columns if c in ("id", "fold")]
    return pred.select(*keep, F.posexplode(arr).alias("class", "p")).withColumn("class", F.col("class").cast("int"))


def oof_predict(train_in: DataFrame, test_in: DataFrame | None, make, model: str, kind: str = "probability",
                k_classes: int = 2, test_mode: str = "fold_mean", fit=None, parallelism: int = 5, refit=None):
    """K1-K4: fit ``make()`` on all folds but f, predict fold f and the test rows; ``refit()`` makes the estimator for all rows (K4).

    ``fit(estimator, rows)`` may replace ``estimator.fit`` (for composite learners)."""
    fit = fit or (lambda est, rows: est.fit(rows))
    folds = sorted(r[0] for r in train_in.select("fold").distinct().collect())
    # the k fold fits are independent: submit them from parallel driver threads (as CrossValidator's
    # ``parallelism``), so their many small iteration jobs share the cluster instead of queueing
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
        fitted = list(pool.map(lambda f: fit(make(), train_in.filter(F.col("fold") != f)), folds))
    oofs, tests = [], []
    for f, m in zip(folds, fitted):
        oofs.append(proba(m.transform(train_in.filter(F.col("fold") == f)), kind, k_classes))
        if test_in is not None and test_mode == "fold_mean":
            tests.append(proba(m.transform(test_in), kind, k_classes).withColumn("fold", F.lit(f)))
    oof = reduce(DataFrame.unionByName, oofs).select("id", F.lit(model).alias("model"), "fold", "class", "p")
    tst = None
    if test_in is not None:
        if test_mode == "refit":
            m = fit((refit or make)(), train_in)
            tst = proba(m.transform(test_in), kind, k_classes)
        else:
            tst = reduce(DataFrame.unionByName, tests).groupBy("id", "class").agg(F.avg("p").alias("p"))
        tst = tst.select("id", F.lit(model).alias("model"), "class", "p")
    return cut_lineage(oof), (cut_lineage(tst) if tst is not None else None)


# ---- composite learners ---------------------------------------------------------------------

def friedman_oof(train: DataFrame, test: DataFrame, classes: int, preset: boost.Preset, weights: list[float] | None = None, validation: str | None = None, bins: int = 32):
    """The boosted trees of all folds (and classes against the rest) in one growth; rows: id, x, y, fold (test: id, x)."""
    first = train.filter("x IS NOT NULL").select(F.size("x").alias("d")).first()
    if first is None:
        raise ValueError("no rows to fit")
    folds = sorted(r[0] for r in train.select("fold").distinct().collect())
    edges = random_forest.edges_of(train, first["d"], random_forest.Settings(max_bins=bins))
    b = boost.fit(train, folds, classes, [preset], bins, validation, edges=edges, weights=weights)
    return boost.score(b, train, "oof"), logistic.by_id(boost.score(b, test, "test"))


def platt_svm_oof(train: DataFrame, test: DataFrame | None, model: str, C: float = 1.0, inner_k: int = 3, seed: int = 7, expand=None):
    """M9: sigmoid-calibrated linear SVM (CalibratedClassifierCV, cv=3) for all outer folds at once; rows: id, x, y, fold (test: id, x).

    The inner folds are stratified by (label, outer fold), so every outer fold's training rows are split evenly by label.  One SVM is fitted
    for each (outer, inner) pair on the rows of neither, all in the same passes; one sigmoid for each on the rows of the inner
    fold, all in the same aggregations.  A probability is the mean over the inner models of the row's outer fold.  ``expand`` is the machines'
    feature map, applied in the tasks: the mapped features are never written."""
    rows = train.withColumn("_s", F.concat_ws(":", "y", "fold"))
    rows = cut_lineage(stratified_kfold(rows, "id", "_s", inner_k, seed, "inner").drop("_s"))
    outer = sorted(r[0] for r in rows.select("fold").distinct().collect())
    names = [(f, g) for f in outer for g in range(inner_k)]
    svm = linear_svm.fit(rows, 2, {n: {"fold": n[0], "inner": n[1]} for n in names}, C, expand=expand)
    scored = cut_lineage(linear_svm.margins(svm, rows.select("id", "x", "y", "fold", "inner"), names).drop("x"))
    # a row calibrates the pairs of its own inner fold and the other outer folds
    pairs = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(f).alias("f"), F.lit(g).alias("g")) for i, (f, g) in enumerate(names)])
    held = scored.select("y", "fold", "inner", "margins", F.explode(pairs).alias("p")).filter("p.f <> fold AND p.g = inner") \
        .select(F.col("p.pair").alias("pair"), F.element_at("margins", F.col("p.pair") + 1).alias("m"), "y")
    fitted = calibrate.fit(held, "pair", "m", "y")
    p1 = [calibrate.apply(F.col("margins")[i], fitted[i]) for i in range(len(names))]
    mean = lambda keep: sum((p1[i] for i, n in enumerate(names) if keep(n)), F.lit(0.0)) / F.lit(float(sum(map(keep, names))))
    own = F.coalesce(*[F.when(F.col("fold") == f, mean(lambda n, f=f: n[0] == f)) for f in outer])
    long = lambda df, p, *keys: df.select(*keys, F.lit(model).alias("model"), F.posexplode(F.array(1 - p, p)).alias("class", "p"))
    oof = long(scored, own, "id", "fold").select("id", "model", "fold", F.col("class").cast("int").alias("class"), "p")
    if test is None:
        return oof, None
    tst = long(linear_svm.margins(svm, test.select("id", "x"), names), mean(lambda n: True), "id").select("id", "model", F.col("class").cast("int").alias("class"), "p")
    return oof, tst


def fourier_map(d_in: int, n_components: int, gamma: float, seed: int = 42):
    """M15 feature map (Rahimi & Recht 2007): ``sqrt(2/D) cos(W x + b)``, W ~ N(0, 2 gamma), b ~ U(0, 2pi), of the rows of a batch.
    W and b are seeded and sized by the parameters."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d_in))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)

    def expand(x: np.ndarray) -> np.ndarray:
        z = np.zeros((len(x), n_components))
        for j in range(d_in):
            z += x[:, j, None] * W[None, :, j]
        return np.cos(z + b) * math.sqrt(2.0 / n_components)
    return expand


def poly3(x: np.ndarray, degree: int = 3) -> np.ndarray:
    """M16 feature map of the rows of a batch: full degree-3 polynomial expansion (kernel approximation of the cubic SVM), in the order
    of ``pyspark.ml.feature.PolynomialExpansion``, without the constant."""
    out = []

    def terms(last: int, left: int, product):
        if left == 0 or last < 0:
            out.append(product)
            return
        for _ in range(left + 1):
            terms(last - 1, left, product)
            product, left = product * x[:, last], left - 1

    terms(x.shape[1] - 1, degree, np.ones(len(x)))
    return np.stack(out[1:], axis=1)


def pivot_meta(oof: DataFrame, models: list[str], k: int, label_df: DataFrame | None = None) -> DataFrame:
    """Meta-feature vector in fixed (model x class) order; absent cells 0."""
    g = oof.groupBy("id").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws(":", "model", F.col("class").cast("string")), "p"))).alias("_m"))
    cells = [F.coalesce(F.col("_m")[f"{m}:{c}"], F.lit(0.0)) for m in models for c in range(k)]
    out = g.select("id", array_to_vector(F.array(*cells)).alias("features"))
    if label_df is not None:
        out = out.join(label_df, "id")
    return out
