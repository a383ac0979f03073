"""The work of the learners on growing tables: what is written, shuffled and sent, beside the results on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import knn


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- neighbours ----------------------------------------------------------------------------------------

def test_neighbours_join_no_pairs_and_break_ties_by_id(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERIES", 7)
    monkeypatch.setattr(knn, "POINTS", 16)
    rng = np.random.default_rng(4)
    x, fold = rng.normal(size=(200, 6)).round(1), rng.integers(0, 3, 200)
    x[50:110] = x[3]  # equal vectors
    ref = spark.createDataFrame([(int(i) - 100, int(fold[i]), int(i) % 5, [float(v) for v in x[i]]) for i in rng.permutation(200)], "tid long, fold int, label long, x array<double>").repartition(3)
    q = [("train", i - 100, [int(fold[i])], x[i]) for i in range(200)] + [("test", i, [0, 1, 2], x[i] + 0.05) for i in range(20)]
    queries = spark.createDataFrame([(p, i, e, [float(v) for v in z]) for p, i, e, z in q], "part string, qid long, excl array<int>, x array<double>").repartition(4)
    found = knn.knn_neighbours(ref, queries, 5)
    assert "Join" not in plan_of(found)
    got = {}
    for r in found.collect():
        got.setdefault((r["part"], r["qid"], r["excl_fold"]), []).append((r["tid"], r["label"], r["d"]))
    for p, i, excl, z in q:
        d = np.sqrt(sum((z[c] - x[:, c]) ** 2 for c in range(6)))
        for e in excl:
            order = sorted((j for j in range(200) if fold[j] != e), key=lambda j: (np.floor(d[j] * 1e9 + 0.5), j))[:5]
            assert sorted(got.pop((p, i, e))) == [(j - 100, j % 5, d[j]) for j in sorted(order)]
    assert not got


def test_lsh_candidates_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERIES", 16)
    monkeypatch.setattr(knn, "POINTS", 32)
    x = np.random.default_rng(6).normal(size=(120, 4))
    v = spark.createDataFrame([(i % 110, [float(t) for t in x[i]]) for i in range(120)], "id long, x array<double>")  # ids 0 to 9 twice
    ref, queries = v.select(F.col("id").alias("tid"), "x"), v.select(F.col("id").alias("qid"), "x")
    found, met = knn.lsh_neighbours(ref, queries, 6, tables=2, bucket=0.7)
    assert "Join" not in plan_of(found)
    least = {}
    pairs = {(r["qid"], r["tid"]) for r in met.collect()}
    for i in range(120):
        for j in range(120):
            if (i % 110, j % 110) in pairs and i % 110 >= 10 and j % 110 >= 10:
                least[i % 110, j % 110] = float(np.sqrt(((x[i] - x[j]) ** 2).sum()))
    rows = [r for r in found.collect()]
    assert all(sum(r["qid"] == i for r in rows) == min(6, sum(q == i for q, _ in pairs)) for i in range(110))
    for i in range(10, 110):
        mine = sorted((d, t) for (q, t), d in least.items() if q == i)
        if all(t >= 10 for q, t in pairs if q == i):
            assert {r["tid"] for r in rows if r["qid"] == i} == {t for _, t in mine[:6]}


def test_lsh_finds_k_ids_beside_rows_that_come_twice(spark):
    x = np.random.default_rng(8).normal(size=(60, 3))
    v = spark.createDataFrame([(i, [float(t) for t in x[i]]) for i in range(60) for _ in range(1 + (i % 2))], "id long, x array<double>").repartition(1)
    found, _ = knn.lsh_neighbours(v.select(F.col("id").alias("tid"), "x"), v.select(F.col("id").alias("qid"), "x"), 4, bucket=50.0)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    assert {(r["qid"], r["tid"]) for r in found.collect()} == {(i, int(j)) for i in range(60) for j in np.argsort(d[i])[:4]}


# ---- feature maps of the SVM ---------------------------------------------------------------------------

def test_feature_maps_are_applied_in_the_tasks(spark):
    from pyspark.ml.feature import PolynomialExpansion
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from foldwise.operators import linear_svm
    from foldwise.plans import stack

    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3)).round(2)
    x[7, 1] = 0.0
    y, fold = (x[:, 0] * x[:, 1] + x[:, 2] ** 3 > 0.1).astype(int), rng.integers(0, 2, 300)
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i]), int(fold[i])) for i in range(300)], "id long, x array<double>, y int, fold int")
    wide = PolynomialExpansion(degree=3, inputCol="v", outputCol="w").transform(rows.withColumn("v", array_to_vector("x"))).select("id", vector_to_array("w").alias("x"), "y", "fold")
    assert np.array_equal(stack.poly3(x), np.array([r["x"] for r in wide.orderBy("id").collect()]))
    subsets = {0: {"fold": 0}, "all": {}}
    mapped, plain = linear_svm.fit(rows, 2, subsets, expand=stack.poly3), linear_svm.fit(wide, 2, subsets)
    assert all(np.allclose(mapped.weights[n], plain.weights[n], atol=1e-8) for n in subsets)
    a = {r["id"]: r["margins"] for r in linear_svm.margins(mapped, rows, [0, "all"]).collect()}
    b = {r["id"]: r["margins"] for r in linear_svm.margins(plain, wide, [0, "all"]).collect()}
    assert all(np.allclose(a[i], b[i], atol=1e-8) for i in range(300))
    z = stack.fourier_map(3, 20, 0.4)(x)
    draw = np.random.default_rng(42)
    w = draw.normal(0, np.sqrt(0.8), size=(20, 3))
    assert np.allclose(z, np.sqrt(0.1) * np.cos(x @ w.T + draw.uniform(0, 2 * np.pi, 20)))


def test_mapped_features_are_never_written(spark, monkeypatch):
    from foldwise import session
    from foldwise.plans import stack

    widths, real = [], session.stage

    def written(df, replaces=None):
        if "x" in df.columns:
            widths.append(df.select(F.max(F.size("x"))).first()[0])
        return real(df, replaces)

    monkeypatch.setattr(session, "stage", written)
    monkeypatch.setattr(stack, "cut_lineage", written)
    x = np.random.default_rng(3).normal(size=(240, 3))
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(x[i].sum() > 0), i % 3) for i in range(240)], "id long, x array<double>, y int, fold int")
    oof, _ = stack.platt_svm_oof(rows, None, "svc", expand=stack.poly3)
    assert oof.count() == 480
    assert widths and set(widths) == {3}


# ---- trees and boosters --------------------------------------------------------------------------------

def batches_of(x, y, fold, size, **more):
    import pyarrow as pa
    for a in range(0, len(x), size):
        cols = {"x": pa.array(x[a : a + size].tolist(), pa.list_(pa.float64())), "y": pa.array(y[a : a + size]), "fold": pa.array(fold[a : a + size])}
        yield pa.RecordBatch.from_pydict(cols | {k: v[a : a + size] for k, v in more.items()})


def test_a_task_sends_one_row_per_node(spark):
    from foldwise.operators import extra_trees

    rng = np.random.default_rng(2)
    x, y, fold = rng.normal(size=(400, 3)), rng.integers(0, 2, 400).astype(np.int32), rng.integers(0, 2, 400).astype(np.int32)
    tree = extra_trees.Tree(np.array([200, 200]))
    nodes = tree.split(np.zeros(1, int), np.array([0]), np.array([0.1]), np.array([[100, 100]]))
    place = np.full(3, -1, np.int32)
    place[nodes] = [0, 1]
    feats = np.array([[1, 2], [2, -1]])
    plan = {(0, 0): (*tree.arrays(), place, feats, nodes, 2)}
    run = extra_trees._spans(type("Shared", (), {"value": plan}), [None], 2)
    many = [b for b in run(batches_of(x, y, fold, 10))]
    rows = {n: (lo, hi) for b in many for n, lo, hi in zip(*(b.column(c).to_pylist() for c in ("node", "lo0", "hi0")), strict=True)}
    assert sum(len(b) for b in many) == 2 and set(rows) == {1, 2}
    left = x[:, 0] <= 0.1
    assert rows == {1: (x[left, 1].min(), x[left, 1].max()), 2: (x[~left, 2].min(), x[~left, 2].max())}


def test_a_task_adds_up_its_histograms(spark, monkeypatch):
    from foldwise.operators import boost

    made = []
    real = boost.Histograms.packs
    monkeypatch.setattr(boost.Histograms, "packs", lambda self: made.append(len(self.nodes)) or real(self))
    rng = np.random.default_rng(7)
    bins, node = rng.integers(0, 5, size=(90, 2)).astype(np.uint8), rng.integers(0, 4, 90)
    g, h = rng.integers(-9, 9, 90).astype(float), rng.integers(1, 9, 90).astype(float)
    sums = boost.Histograms([3, 1], 4, 2, 5)
    for a in range(0, 90, 7):
        sums.add(node[a : a + 7], bins[a : a + 7], g[a : a + 7], h[a : a + 7])
    got = {n: np.frombuffer(s, np.int64).reshape(2, 5, 3) for n, s in sums.packs()}
    assert set(got) == {1, 3} and made == [2]
    for n, s in got.items():
        for j in range(2):
            for v in range(5):
                r = (node == n) & (bins[:, j] == v)
                assert s[j, v].tolist() == [g[r].sum(), h[r].sum(), r.sum()]


# ---- passes of scalers, seeds and searches -------------------------------------------------------------

def test_yeo_johnson_takes_one_pass_for_all_columns(spark, monkeypatch):
    from foldwise.operators import scale

    rng = np.random.default_rng(11)
    x = np.stack([np.exp(rng.normal(size=400)), -np.exp(rng.normal(size=400)), rng.normal(size=400)], axis=1)
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in x] + [(None, None, None)], "a double, b double, c double").repartition(3)
    passes, real = [], scale._yj_grid_best
    monkeypatch.setattr(scale, "_yj_grid_best", lambda train, grids: passes.append(set(grids)) or real(train, grids))
    fit = scale.fit_yeo_johnson(df, ["a", "b", "c"])
    assert passes[0] == passes[-1] == {"a", "b", "c"} and len(passes) <= 4
    for j, c in enumerate("abc"):
        def value(lam, v=x[:, j]):
            up = v >= 0
            y = np.where(up, ((np.abs(v) + 1) ** lam - 1) / lam if lam else np.log1p(np.abs(v)), -((np.abs(v) + 1) ** (2 - lam) - 1) / (2 - lam) if lam != 2 else -np.log1p(np.abs(v)))
            return -200 * np.log(y.var()) + (lam - 1) * (np.sign(v) * np.log1p(np.abs(v))).sum()
        assert value(fit[c][0]) >= max(value(round(fit[c][0] + s, 6)) for s in (-0.01, 0.01)) - 1e-9


def test_wide_scores_take_one_exchange(spark):
    from foldwise.plans import search

    pred = spark.createDataFrame([(i, m, c, i + 0.1 * c) for i in range(20) for m in ("a", "b") if (i, m) != (3, "b") for c in (0, 1)], "id long, model string, class int, p double")
    wide = search.wide_scores(pred, ["a", "b"])
    assert plan_of(wide).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    assert {r["id"]: (r["p_a"], r["p_b"]) for r in wide.collect()} == {i: (i + 0.1, None if i == 3 else i + 0.1) for i in range(20)}


def test_fits_of_several_models_share_their_folds(spark):
    from foldwise.plans import seeds

    rng = np.random.default_rng(1)
    train = spark.createDataFrame([(i, int(rng.integers(0, 2)), float(rng.normal()), None if i % 9 == 0 else "uvw"[i % 3]) for i in range(150)], "id long, y int, n double, v string")
    folds = seeds.seeded_folds(train.select("id", "y"), "id", "y", 5, [1, 2]).cache()
    shared, _ = seeds.fit(train, ["n"], "v", 2, [1, 2], folds=folds)
    own, _ = seeds.fit(train, ["n"], "v", 2, [1, 2])
    a, b = (seeds.test_probabilities(s, train, "m").orderBy("seed", "id", "class").toPandas() for s in (shared, own))
    assert len(a) == 600 and np.allclose(a["p"], b["p"], atol=1e-12)


def test_weight_hits_are_counted_in_small_blocks(spark):
    from foldwise.plans import search

    rng = np.random.default_rng(5)
    p, y = rng.random((700, 2)), rng.integers(0, 2, 700)
    rows = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(p, y, strict=True)], "p_a double, p_b double, y double").coalesce(1)
    for n in (3, 3000):
        w = rng.random((n, 2))
        got = {r["wid"]: r["accuracy"] for r in search.score_candidates(rows, ["a", "b"], "y", w.tolist()).collect()}
        want = (((0 + p[:, :1] * w[:, 0]) + p[:, 1:] * w[:, 1] >= 0.5) == (y == 1)[:, None]).mean(axis=0)
        assert len(got) == n and all(abs(got[i] - want[i]) < 1e-12 for i in range(n))


def test_perceptrons_of_all_folds_share_their_passes(spark, monkeypatch):
    """All fits are summed in one pass, from the start of pyspark.ml's network and to its loss; ids may be null or repeat."""
    from pyspark.ml.functions import array_to_vector

    from foldwise.operators import models, perceptron
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 3))
    y, fold = ((x[:, 0] * x[:, 1] + 0.3 * x[:, 2]) > 0).astype(int), rng.integers(0, 3, 900)
    data = [(None if i < 3 else i // 2, [float(v) for v in x[i]], int(y[i]), int(fold[i])) for i in range(900)]
    rows = spark.createDataFrame(data, "id long, x array<double>, y int, fold int").repartition(3).cache()
    calls, sums = [], perceptron.packed_sums
    monkeypatch.setattr(perceptron, "packed_sums", lambda *a: calls.append(a[2]) or sums(*a))
    layers = [3, 5, 2]
    m = perceptron.fit(rows, layers, {f: {"fold": f} for f in range(3)}, max_steps=8)
    assert len(calls) == m.passes < 24 and calls[0] == 3
    start = perceptron.starting_weights(spark, layers, 42)
    # the gradient by differences
    out, parts = np.zeros(2 + len(start)), perceptron.opened(start, layers)
    perceptron.add_gradient(out, x, y, parts, layers)

    def loss(w, ok):
        p = perceptron.softmax(perceptron.activations(x[ok], perceptron.opened(w, layers))[-1])
        return -np.log(p[np.arange(ok.sum()), y[ok]]).mean()

    every = np.ones(900, bool)
    for i in range(0, len(start), 4):
        step = np.eye(len(start))[i] * 1e-6
        assert abs(out[2 + i] / 900 - (loss(start + step, every) - loss(start - step, every)) / 2e-6) < 1e-6
    for f in (1,):
        ok = fold != f
        ml = models.mlp(layers, max_iter=8).setBlockSize(1).fit(rows.filter(F.col("fold") != f).select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label")))
        assert loss(m.weights[f], ok) < loss(start, ok) and abs(loss(m.weights[f], ok) - loss(ml.weights.toArray(), ok)) < 2e-3
    oof, tst = perceptron.oof(rows, rows.limit(6).drop("y", "fold"), [0, 1, 2], layers, "mlp", 2)
    assert oof.count() == 1800 and tst.count() == 2 * rows.limit(6).select("id").distinct().count()
    with pytest.raises(Exception, match="impute"):
        perceptron.fit(rows.withColumn("x", F.array(F.lit(float("nan")), F.lit(0.0), F.lit(0.0))), layers, {0: {"fold": 0}}, 2)
    with pytest.raises(Exception, match="labels"):
        perceptron.fit(rows.withColumn("y", F.lit(None).cast("int")), layers, {0: {"fold": 0}}, 2)


def test_friedman_boosting_grows_the_trees_of_gbt_classifier(spark, monkeypatch):
    """All folds and classes in one growth, a pass a level, and the predictions of pyspark.ml's fits of each fold (few values: the same cuts)."""
    from pyspark.ml.functions import array_to_vector

    from foldwise.operators import boost, models
    from foldwise.plans import stack
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, size=(1200, 3))
    y, fold = np.digitize(x[:, 0] + x[:, 1] * (x[:, 2] > 3) + rng.normal(scale=2, size=1200), [5, 9]), rng.integers(0, 2, 1200)
    data = [(i, [float(v) for v in x[i]], int(y[i]), int(fold[i]), bool(i % 5 == 0)) for i in range(1200)]
    rows = spark.createDataFrame(data, "id long, x array<double>, y int, fold int, is_val boolean").repartition(3).cache()
    passes, sums = [], boost._sums
    monkeypatch.setattr(boost, "_sums", lambda *a, **k: passes.append(1) or sums(*a, **k))

    def compared(rows, make, classes, preset, kind, **more):
        passes.clear()
        oof, tst = stack.friedman_oof(rows, rows.limit(20), classes, preset, **more)
        found = {(r["id"], r["class"]): r["p"] for r in oof.collect()}
        ml = rows.withColumn("w", F.when(F.col("y") == 1, 1.7).otherwise(0.6))
        ml = ml.select("id", array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), "fold", "is_val", "w").cache()
        want = stack.oof_predict(ml, ml.limit(20), make, "m", kind=kind, k_classes=classes)[0].collect()
        assert len(want) == len(found) == 1200 * classes and tst.count() == 20 * classes
        assert max(abs(r["p"] - found[r["id"], r["class"]]) for r in want) < 1e-5

    binary = rows.withColumn("y", F.least("y", F.lit(1))).cache()
    compared(binary, lambda: models.gbt(5, 3, 0.1, weight=True), 2, boost.friedman("m", 5, 3, 0.1), "probability", weights=[0.6, 1.7])
    assert len(passes) <= 5 * 3 + 1
    compared(rows, lambda: models.one_vs_rest(models.gbt(3, 2, 0.3)), 3, boost.friedman("m", 3, 2, 0.3), "margin_softmax")
    assert len(passes) <= 3 * 2 + 1
    early = boost.friedman("m", 12, 3, 0.5, tolerance=0.05)
    compared(binary, lambda: models.gbt(12, 3, 0.5, validation_col="is_val", validation_tol=0.05), 2, early, "probability", validation="is_val")
    assert len(passes) < 12 * 3  # stopped
    for bad, message in ((rows.withColumn("y", F.lit(None).cast("int")), "labels"), (rows.withColumn("x", F.array(*[F.lit(float("nan"))] * 3)), "impute")):
        with pytest.raises(Exception, match=message):
            boost.fit(bad, [None], 3, [early], edges=[np.zeros(1)] * 3)
    # one class alone: a leaf of the labels' mean, then of the residuals
    b = boost.fit(rows.withColumn("y", F.lit(1)), [None], 2, [boost.friedman("m", 2, 2, 0.1)])
    assert np.allclose(b.raw(np.zeros((1, 3)), (0, None)), 1 + 0.1 * 4 / (1 + np.exp(2)))
