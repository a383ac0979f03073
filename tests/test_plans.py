"""Seeds in one plan, neighbours, naive Bayes with nulls, SVM, calibration, search and fold-scoped fits against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import calibrate, fold_scope, knn, linear_svm
from foldwise.operators.bayes import naive_bayes_oof
from foldwise.operators.folds import stratified_kfold
from foldwise.plans import param_search, seeds


# ---- seeds -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(0, 3)), float(rng.normal() * 10 + 500), float(rng.normal()), None if i % 23 == 0 else f"v{rng.integers(0, 6)}") for i in range(600)]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c string").cache()


def test_seeded_folds_equal_those_of_each_seed(table):
    got = {r["id"]: r["folds"] for r in seeds.seeded_folds(table, "id", "y", 5, [3, 42]).collect()}
    for i, s in enumerate([3, 42]):
        want = {r["id"]: r["fold"] for r in stratified_kfold(table, "id", "y", 5, s).collect()}
        assert {k: v[i] for k, v in got.items()} == want


def test_sweep_reads_the_rows_once_for_all_seeds(table):
    many = list(range(50))
    sweep, rows = seeds.fit(table, ["a", "b"], "c", 3, many)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and len(sweep.fits) == 50
    out = seeds.oof_accuracy(sweep, rows).collect()
    assert [r["seed"] for r in out] == many and all(r["n"] == 600 and 0 < r["accuracy"] < 1 for r in out)


def test_sweep_equals_the_flow_of_one_seed(table):
    seed = 7
    sweep, _ = seeds.fit(table, ["a", "b"], None, 3, [1, seed])
    train = stratified_kfold(table, "id", "y", 5, seed)
    _, want, _ = naive_bayes_oof(train, table.limit(20), ["a", "b"], "y")
    got = seeds.test_probabilities(sweep, table.limit(20), "nb").filter(F.col("seed") == seed)
    a, b = ({(r["id"], r["class"]): r["p"] for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


# ---- naive Bayes -------------------------------------------------------------------------------------

def test_naive_bayes_leaves_missing_values_out(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) + np.arange(200)[:, None] % 2
    x[::7, 0] = np.nan
    y, fold = np.arange(200) % 2, np.arange(200) // 2 % 2
    df = spark.createDataFrame([(i, int(y[i]), int(fold[i]), None if np.isnan(x[i, 0]) else float(x[i, 0]), float(x[i, 1]), None) for i in range(200)],
                               "id long, y int, fold int, a double, b double, void double")
    oof, _, _ = naive_bayes_oof(df, None, ["a", "b", "void"], "y")
    got = {(r["id"], r["class"]): r["p"] for r in oof.collect()}
    for i in range(200):
        own = fold != fold[i]
        eps = 1e-9 * max(np.nanvar(x[own], axis=0))
        logs = []
        for c in (0, 1):
            part = x[own & (y == c)]
            v, m = np.nanvar(part, axis=0) + eps, np.nanmean(part, axis=0)
            terms = np.log(2 * np.pi * v) + (x[i] - m) ** 2 / v
            logs.append(np.log(len(part) / own.sum()) - 0.5 * np.nansum(np.where(np.isnan(x[i]), 0, terms)))
        p = np.exp(logs - np.max(logs))
        assert abs(got[i, 1] - (p / p.sum())[1]) < 1e-6


# ---- neighbours ----------------------------------------------------------------------------------------

def test_neighbours_with_several_folds_left_out(spark):
    rng = np.random.default_rng(3)
    x, fold = rng.normal(size=(300, 5)).round(1), rng.integers(0, 3, 300)
    ref = spark.createDataFrame([(i, int(fold[i]), 0, [float(v) for v in x[i]]) for i in range(300)], "tid long, fold int, label int, x array<double>")
    q = rng.normal(size=(20, 5)).round(1)
    queries = spark.createDataFrame([("test", i, [0, 1, 2], [float(v) for v in q[i]]) for i in range(20)], "part string, qid long, excl array<int>, x array<double>")
    got = {}
    for r in knn.knn_neighbours(ref, queries, 4).collect():
        got.setdefault((r["qid"], r["excl_fold"]), set()).add(r["tid"])
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(axis=2))
    for i in range(20):
        for e in range(3):
            order = sorted((j for j in range(300) if fold[j] != e), key=lambda j: (np.floor(d[i, j] * 1e9 + 0.5), j))
            assert got[i, e] == set(order[:4])


def test_pivot_distances_come_in_bounded_blocks():
    x, p = np.random.default_rng(0).normal(size=(50, 3)), np.random.default_rng(1).normal(size=(7, 3))
    parts = list(knn.pivot_distances(x, p, cells=21))
    assert all(d.size <= 21 for _, d in parts)
    assert np.allclose(np.concatenate([d for _, d in parts]), np.sqrt(((x[:, None] - p[None]) ** 2).sum(axis=2)))


def test_lsh_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 4
    x = centres[np.arange(600) % 12] + rng.normal(size=(600, 8)) * 0.3
    v = spark.createDataFrame([(i, [float(t) for t in x[i]]) for i in range(600)], "id long, x array<double>").cache()
    ref, queries = v.select(F.col("id").alias("tid"), "x"), v.select(F.col("id").alias("qid"), "x")
    bucket, recall, share = knn.tune_lsh(ref, queries, 5, 0.9, sample=40, start=0.1)
    assert recall >= 0.9 and share < 0.9
    found, _ = knn.lsh_neighbours(ref, queries, 5, bucket=bucket)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = {(i, j) for i in range(600) for j in np.argsort(d[i])[:5]}
    got = {(r["qid"], r["tid"]) for r in found.collect()}
    assert len(got) <= 3000 and len(got & want) / len(want) >= 0.85


# ---- SVM and calibration -------------------------------------------------------------------------------

def test_svm_is_at_the_optimum(spark):
    rng = np.random.default_rng(2)
    x, fold = rng.normal(size=(500, 4)), rng.integers(0, 3, 500)
    y = np.digitize(x[:, 0] + rng.normal(size=500), [-0.5, 0.7])
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i]), int(fold[i])) for i in range(500)], "id long, x array<double>, y int, fold int").repartition(3)
    svm = linear_svm.fit(df, 3, {0: {"fold": 0}, "all": {}}, C=0.7)
    z = np.concatenate([x, np.ones((500, 1))], axis=1)
    for name, own in ((0, fold != 0), ("all", np.ones(500, bool))):
        assert svm.norms[name] < 1e-8
        for k in range(3):
            t, w = np.where(y[own] == k, 1.0, -1.0), svm.weights[name][k]
            loss = lambda w: w @ w / 2 + 0.7 * (np.maximum(0, 1 - t * (z[own] @ w)) ** 2).sum()  # noqa: B023, E731
            act = t * (z[own] @ w) < 1
            grad = w + 1.4 * z[own][act].T @ ((z[own] @ w)[act] - t[act])
            assert np.linalg.norm(grad) < 1e-5
            assert all(loss(w) <= loss(w + 1e-3 * rng.normal(size=5)) for _ in range(20))


def test_calibration_equals_a_local_newton(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=400) * 3
    y, g = (rng.random(400) < 1 / (1 + np.exp(-0.8 * m + 0.3))).astype(int), np.arange(400) % 3
    y[g == 2] = 1  # one class only
    df = spark.createDataFrame([(int(g[i]), float(m[i]), int(y[i])) for i in range(400)] + [(0, None, 1), (None, 1.0, 1)], "g int, m double, y int")
    got = calibrate.fit(df, "g", "m", "y")
    for k in range(3):
        mm, yy = m[g == k], y[g == k]
        n1, n0 = yy.sum(), (1 - yy).sum()
        t = np.where(yy == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        w = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
        for _ in range(200):
            p = 1 / (1 + np.exp(-(w[0] * mm + w[1])))
            z = np.stack([mm, np.ones(len(mm))], axis=1)
            w = w - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-12 * np.eye(2), z.T @ (p - t))
        assert np.allclose(got[k], w, atol=1e-6)


# ---- search ----------------------------------------------------------------------------------------------

def test_search_by_callable():
    params = param_search.draws({"a": ("int", 1, 5), "b": ("float", 0.0, 1.0)}, 12, seed=3)
    assert params == param_search.draws({"a": ("int", 1, 5), "b": ("float", 0.0, 1.0)}, 12, seed=3)
    assert all(1 <= p["a"] <= 5 and 0 <= p["b"] <= 1 for p in params)
    ranked = param_search.search(param_search.each(lambda p: p["a"]), params, parallelism=3)
    assert [r[0] for r in ranked] == list(range(1, 13))
    assert ranked == sorted(ranked, key=lambda r: (-r[2], r[1]))
    assert param_search.search(lambda batch: [len(batch)] * len(batch), params, batch=5)[0][2] == 5


def test_macro_f1_evaluator(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "y int, pred int")
    e = param_search.MacroF1Evaluator("y", "pred")
    assert e.isLargerBetter() and abs(e.evaluate(df) - np.mean([2 * 1 / 4, 2 * 2 / 5, 0.0])) < 1e-12


# ---- fits without the own fold -----------------------------------------------------------------------------

def test_fold_scope_equals_numpy(spark):
    rng = np.random.default_rng(9)
    x, fold = rng.normal(size=300) * 5 + 100, rng.integers(0, 4, 300)
    x[::11] = np.nan
    x[3:60:5] = 100.0  # ties
    df = spark.createDataFrame([(i, int(fold[i]), None if np.isnan(x[i]) else float(x[i])) for i in range(300)], "id long, fold int, x double")
    med, std, rob = fold_scope.fit_median(df, ["x"]), fold_scope.fit_standard(df, ["x"]), fold_scope.fit_robust(df, ["x"])
    for f in [0, 1, 2, 3, fold_scope.ALL]:
        part = x[fold != f]
        part = part[~np.isnan(part)]
        assert np.isclose(med[f]["x"], np.median(part))
        assert np.allclose(std[f]["x"], (part.mean(), part.std()))
        assert np.allclose(rob[f]["x"], (np.median(part), np.quantile(part, 0.75) - np.quantile(part, 0.25)))
    done = {r["id"]: r["x"] for r in fold_scope.apply_center_scale(fold_scope.apply_fill(df, med), std).collect()}
    for i in range(300):
        v = med[fold[i]]["x"] if np.isnan(x[i]) else x[i]
        assert np.isclose(done[i], (v - std[fold[i]]["x"][0]) / std[fold[i]]["x"][1])
    tr, ts = fold_scope.quantile_normal(df, df, ["x"], 20)
    whole = {r["id"]: r["x"] for r in ts.collect()}
    own = {r["id"]: r["x"] for r in tr.collect()}
    assert all((own[i] is None) == bool(np.isnan(x[i])) for i in range(300))
    assert any(abs(own[i] - whole[i]) > 1e-9 for i in range(300) if own[i] is not None)
    order = [i for i in np.argsort(x) if not np.isnan(x[i]) and fold[i] == 1]
    assert all(own[a] <= own[b] + 1e-12 for a, b in zip(order, order[1:], strict=False))
