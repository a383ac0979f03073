"""Learners against small single-process versions: extremely randomised trees, boosting, ridge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import boost, extra_trees, ridge


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n, d = 2000, 7
    x = rng.normal(size=(n, d))
    x[:, 5] = rng.integers(0, 3, n)
    x[:, 6] = 1.0  # constant
    y = np.digitize(x[:, 0] + 0.6 * x[:, 5] + rng.normal(scale=0.5, size=n), [-0.3, 0.9])
    x[::17, 1] = np.nan
    x[5, 2], x[6, 2] = np.inf, -np.inf
    fold = rng.integers(0, 3, n)
    rows = [(i, [float(v) for v in x[i]], int(y[i]), int(fold[i]), bool(i % 10 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int, fold int, val boolean")
    return df, np.where(np.isfinite(x), x, np.nan), y, fold


# ---- extremely randomised trees ------------------------------------------------------------------

def local_tree(x, y, classes, s, m, t):
    """One tree by recursion over rows; nodes are numbered in the order in which levels are grown."""
    n_k = np.bincount(y, minlength=classes)
    weight = len(y) / ((n_k > 0).sum() * np.maximum(n_k, 1)) if s.balanced else np.ones(classes)
    d, k = x.shape[1], s.candidates or int(np.sqrt(x.shape[1]))
    nodes = [{"rows": np.arange(len(y)), "depth": 0, "tries": 0, "split": None}]
    todo = [0]
    while todo:
        nxt = []
        for v in todo:
            node = nodes[v]
            r = node["rows"]
            if node["depth"] >= s.max_depth or len(r) < s.min_split or len(set(y[r])) < 2 or node["tries"] * k >= d:
                continue
            order = np.argsort(extra_trees.draw(s.seed, m, t, np.array([v]), d, 1)[0], kind="stable")
            u = extra_trees.draw(s.seed, m, t, np.array([v]), d, 2)[0]
            best = None
            for f in order[node["tries"] * k : (node["tries"] + 1) * k]:
                col = x[r, f]
                lo, hi = np.nanmin(col) if (~np.isnan(col)).any() else np.nan, np.nanmax(col) if (~np.isnan(col)).any() else np.nan
                if not lo < hi:
                    continue
                cut = lo + (int(u[f]) >> 11) * 2.0**-53 * (hi - lo)
                cut = cut if cut < hi else lo
                score = 0.0
                for side in (r[col <= cut], r[~(col <= cut)]):
                    c = [float(a * w) for a, w in zip(np.bincount(y[side], minlength=classes), weight, strict=True)]
                    score += sum(a * a for a in c) / sum(c)
                if best is None or score > best[0]:
                    best = (score, int(f), float(cut), r[col <= cut], r[~(col <= cut)])
            if best is None:
                node["tries"] += 1
                nxt.append(v)
                continue
            node["split"] = (best[1], best[2], len(nodes))
            for rows in best[3:]:
                nodes.append({"rows": rows, "depth": node["depth"] + 1, "tries": 0, "split": None})
                nxt.append(len(nodes) - 1)
        # the level order of the forest: nodes of each tree in the order in which they became active
        todo = nxt
    return nodes


@pytest.mark.parametrize("balanced,parts", [(True, 5), (False, 1)])
def test_extra_trees_equal_a_local_version(data, balanced, parts):
    df, x, y, fold = data
    s = extra_trees.Settings(n_trees=3, max_depth=6, balanced=balanced, seed=4)
    forest = extra_trees.fit(df.repartition(parts), [0, 1, None], 3, s)
    for m, f in enumerate([0, 1, None]):
        own = fold != f if f is not None else np.ones(len(y), bool)
        for t in range(3):
            want, got = local_tree(x[own], y[own], 3, s, m, t), forest.trees[f][t]
            assert len(want) == len(got.feature)
            for v, node in enumerate(want):
                assert np.array_equal(got.counts[v], np.bincount(y[own][node["rows"]], minlength=3))
                if node["split"] is None:
                    assert got.feature[v] == -1
                else:
                    assert (got.feature[v], got.threshold[v], got.left[v]) == node["split"]


def test_extra_trees_score(data):
    df, x, y, fold = data
    s = extra_trees.Settings(n_trees=25, max_depth=8)
    forest = extra_trees.fit(df, [0, 1, 2], 3, s)
    rows = extra_trees.score(forest, df, "oof", "et").toPandas()
    assert len(rows) == 3 * len(y) and np.allclose(rows.groupby("id")["p"].sum(), 1)
    pred = rows.sort_values(["id", "class"])["p"].to_numpy().reshape(-1, 3).argmax(1)
    assert (pred == y).mean() > 0.65 > np.bincount(y).max() / len(y)
    test = extra_trees.score(forest, df.limit(5), "test", "et").toPandas()
    assert len(test) == 15 and np.allclose(test.groupby("id")["p"].sum(), 1)


def test_extra_trees_edges(spark, data):
    schema = "id long, x array<double>, y int, fold int"
    same = spark.createDataFrame([(i, [1.0, float("nan")], i % 2, i % 2) for i in range(8)], schema)
    f = extra_trees.fit(same, [None], 2, extra_trees.Settings(n_trees=2))
    assert all(len(t.feature) == 1 for t in f.trees[None])  # nothing to split on
    assert extra_trees.score(f, same, "full", "et").filter("abs(p - 0.5) > 1e-12").count() == 0
    with pytest.raises(ValueError):
        extra_trees.fit(same.limit(0), [None], 2)
    with pytest.raises(ValueError):
        extra_trees.fit(same.filter("fold = 1"), [1], 2)


# ---- boosting ------------------------------------------------------------------------------------

def local_boost(bins, y, ids, own, val, edges, absent, p, fold, classes):
    outputs = 1 if classes == 2 else classes
    raw = np.zeros((len(y), outputs))
    rounds, curve = [], []
    for number in range(p.rounds):
        g, h, loss = boost.loss_parts(raw, y)
        curve.append((loss[own & ~val].mean(), loss[own & val].mean() if (own & val).any() else None))
        use = own & ~val & boost.in_round(p, ids, number)
        columns = boost.columns_of(p, -1 if fold is None else fold, number, bins.shape[1])
        trees = []
        for k in range(outputs):
            tree, node = boost.Tree(), np.zeros(len(y), int)
            level = [0]
            for _ in range(p.max_depth):
                nxt = []
                for v in level:
                    r = np.flatnonzero(use & (node == v))
                    hist = np.zeros((bins.shape[1], absent + 1, 3), np.int64)
                    for j in range(bins.shape[1]):
                        np.add.at(hist[j], bins[r, j], np.stack([np.round(g[r, k] * boost.UNIT), np.round(h[r, k] * boost.UNIT), np.ones(len(r))], axis=1).astype(np.int64))
                    s = boost.best_split(hist, p, columns) if len(r) else None
                    if s is None:
                        continue
                    _, f, cut, missing, lv, rv = s
                    tree.feature[v], tree.cut[v], tree.missing[v], tree.left[v] = f, cut, missing, len(tree.feature)
                    tree.leaf(lv), tree.leaf(rv)
                    mine = node == v
                    b = bins[:, f]
                    node[mine] = tree.left[v] + np.where(b == absent, missing, b > cut)[mine]
                    nxt += [tree.left[v], tree.left[v] + 1]
                level = nxt
            trees.append(tree)
            raw[:, k] += np.array(tree.value)[node]
        rounds.append(trees)
    return rounds, curve, raw


def test_softmax_boosting_equals_a_local_version(spark, data):
    df, x, y, fold = data
    presets = [boost.Preset("a", 6, 3, 0.3, 0.8, 0.6), boost.Preset("b", 4, 2, 0.5, seed=7, l1=0.5)]
    b = boost.fit(df.repartition(5), [0, None], 3, presets, bins=16, validation="val", stage_every=2)
    ids = np.array([r[0] for r in df.select("id", F.xxhash64("id").alias("h")).orderBy("id").select("h").collect()], np.int64)
    bins, val = boost.binned(x, b.edges, 16), np.arange(len(y)) % 10 == 0
    for a, p in enumerate(presets):
        for f in (0, None):
            own = fold != f if f is not None else np.ones(len(y), bool)
            rounds, curve, raw = local_boost(bins, y, ids, own, val, b.edges, 16, p, f, 3)
            assert len(b.trees[a, f]) == p.rounds
            for got, want in zip(b.trees[a, f], rounds, strict=True):
                for g, w in zip(got, want, strict=True):
                    assert (g.feature, g.cut, g.left, g.missing) == (w.feature, w.cut, w.left, w.missing) and np.allclose(g.value, w.value, atol=1e-6)
            assert np.allclose(np.array(b.curves[a, f])[: p.rounds], np.array(curve), atol=1e-6)
            assert len(b.curves[a, f]) == p.rounds + 1
            assert np.allclose(b.raw(x, (a, f)), raw, atol=1e-6)
    whole = boost.fit(df, [None], 3, [boost.Preset("c", 12, 3, 0.3)], bins=16)
    train = [t for t, _ in whole.curves[0, None]]
    assert all(later < earlier for earlier, later in zip(train, train[1:], strict=False))  # each round lowers the loss
    assert np.isclose(train[0], np.log(3), atol=1e-6)
    p = boost.score(whole, df, "full").toPandas()
    assert np.allclose(p.groupby("id")["p"].sum(), 1)
    assert (p.sort_values(["id", "class"])["p"].to_numpy().reshape(-1, 3).argmax(1) == y).mean() > 0.7


def test_patience_stops_at_the_best_round(spark):
    rng = np.random.default_rng(1)
    n = 400
    x = rng.normal(size=(n, 6))
    y = (x[:, 0] + rng.normal(scale=2.0, size=n) > 0).astype(int)  # noise: the validation loss falls, then rises
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i]), 0, i % 4 == 0) for i in range(n)], "id long, x array<double>, y int, fold int, val boolean")
    p = boost.Preset("es", 200, 4, 0.3, patience=5, min_curvature=0.0)
    b = boost.fit(df, [None], 2, [p], bins=32, validation="val")
    curve = [v for _, v in b.curves[0, None]]
    best = int(np.argmin(curve))
    assert 0 < best < len(curve) - 1 and curve[-1] > curve[best] < curve[0]
    assert len(curve) - 1 - best == 5 and len(b.trees[0, None]) == best == b.best[0, None]
    raw = b.raw(x, (0, None))
    _, _, loss = boost.loss_parts(raw, y)
    assert np.isclose(loss[np.arange(n) % 4 == 0].mean(), curve[best], atol=1e-6)
    assert [r for r in boost.curve_rows(b) if r[5]] == [("es", None, best, *b.curves[0, None][best], True)]


# ---- ridge ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("classes", [2, 3])
def test_ridge_equals_a_local_version(data, classes):
    df, x, y, fold = data
    y = np.minimum(y, classes - 1)
    x = np.nan_to_num(x, nan=0.0)
    alphas = [0.1, 1.0, 300.0, 3000.0]
    clean = df.select("id", F.transform("x", lambda v: F.when(F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)).alias("x"), F.least("y", F.lit(classes - 1)).alias("y"), "fold").repartition(5)
    r = ridge.fit(clean, classes, alphas)
    for f in (0, 2, None):
        own = fold != f if f is not None else np.ones(len(y), bool)
        z, t = x[own], ridge.targets(y[own], classes)
        errors = []
        for a in alphas:
            zc, tc = z - z.mean(0), t - t.mean(0)
            beta = np.linalg.solve(zc.T @ zc + a * np.eye(z.shape[1]), zc.T @ tc)
            hat = zc @ np.linalg.solve(zc.T @ zc + a * np.eye(z.shape[1]), zc.T) + 1 / len(z)
            errors.append((((tc - zc @ beta) / (1 - np.diag(hat))[:, None]) ** 2).mean())
            assert np.allclose(r.solutions[f].weights(a), beta, atol=1e-8)
        assert np.allclose(r.errors[f], errors)
        assert r.alphas[f] == alphas[int(np.argmin(errors))]
    # a leave-one-out error is that of a fit without the row
    i, s = 7, ridge.Solution(sum(ridge.grams(clean, classes).values()), 1 if classes == 2 else classes)
    z, t = np.delete(x, i, axis=0), ridge.targets(np.delete(y, i), classes)
    beta = np.linalg.solve((z - z.mean(0)).T @ (z - z.mean(0)) + np.eye(z.shape[1]), (z - z.mean(0)).T @ (t - t.mean(0)))
    left_out = ridge.targets(y[i : i + 1], classes) - t.mean(0) - (x[i] - z.mean(0)) @ beta
    assert np.allclose(s.leave_one_out(x[i : i + 1], ridge.targets(y[i : i + 1], classes), 1.0), left_out)
    p = ridge.score(r, clean, "oof", "ridge").toPandas()
    assert len(p) == classes * len(y) and np.allclose(p.groupby("id")["p"].sum(), 1)
    with pytest.raises(ValueError):
        ridge.fit(clean.limit(0), classes, [1.0])


# ---- pyspark.ml factories ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(data):
    from pyspark.ml.functions import array_to_vector
    df, x, y, fold = data
    clean = F.transform("x", lambda v: F.when(F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v))
    return df.select("id", array_to_vector(clean).alias("features"), (F.col("y") > 0).cast("double").alias("label"), "fold").cache(), np.nan_to_num(x, nan=0.0), (y > 0).astype(float), fold


def test_logistic_is_at_the_optimum(vectors):
    from foldwise.operators import models as M
    df, x, y, _ = vectors
    n = len(y)
    m = M.logistic(C=0.5, n=n, max_iter=200).setTol(1e-12).fit(df)
    w, b = m.coefficients.toArray(), m.intercept
    err = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(x.T @ err / n + w / (0.5 * n)).max() < 1e-5 and abs(err.mean()) < 1e-5
    # L1: the gradient of a zero weight stays within the penalty, that of another equals it
    m = M.logistic(C=0.01, n=n, l1_ratio=1.0, max_iter=500).setTol(1e-12).fit(df)
    w, b = m.coefficients.toArray(), m.intercept
    g, penalty = x.T @ (1 / (1 + np.exp(-(x @ w + b))) - y) / n, 1 / (0.01 * n)
    assert (w == 0).any() and (np.abs(g[w == 0]) <= penalty + 1e-5).all() and np.allclose(g[w != 0], -np.sign(w[w != 0]) * penalty, atol=1e-4)


@pytest.mark.parametrize("name", ["random_forest", "gbt", "mlp"])
def test_ml_learners_beat_the_larger_class(vectors, name):
    from foldwise.operators import models as M
    from foldwise.plans.stack import oof_predict
    df, x, y, fold = vectors
    make = {"random_forest": lambda: M.random_forest(15, 6), "gbt": lambda: M.gbt(6, 3, 0.3), "mlp": lambda: M.mlp([x.shape[1], 6, 2], max_iter=40)}[name]
    oof, tst = oof_predict(df, df.limit(10).drop("label", "fold"), make, name, test_mode="refit")
    rows = oof.toPandas().sort_values(["id", "class"])
    assert len(rows) == 2 * len(y) and np.allclose(rows.groupby("id")["p"].sum(), 1) and tst.count() == 20
    assert ((rows["p"].to_numpy().reshape(-1, 2)[:, 1] >= 0.5) == y).mean() > max(y.mean(), 1 - y.mean()) + 0.1


# ---- logistic regression -------------------------------------------------------------------------

@pytest.mark.parametrize(("classes", "l1_ratio"), [(2, 0.0), (2, 1.0), (3, 0.0), (3, 0.5)])
def test_logistic_fits_of_all_subsets_are_at_the_optimum(spark, data, classes, l1_ratio):
    from foldwise.operators import logistic
    df, x, y, fold = data
    clean = F.transform("x", lambda v: F.when(F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v))
    rows = df.select("id", clean.alias("x"), F.least("y", F.lit(classes - 1)).alias("y"), "fold").cache()
    x, y, reg = np.nan_to_num(x, nan=0.0), np.minimum(y, classes - 1), 0.01
    many = {(f, c): logistic.Problem(c * reg, {"fold": f}, l1_ratio) for f in range(3) for c in (1, 0.1)} | {"all": logistic.Problem(reg, l1_ratio=l1_ratio)}
    m = logistic.fit(rows, classes, many)
    assert m.passes < 20
    for name, problem in many.items():
        ok = fold != problem.without.get("fold", -1)
        w = m.weights[name]
        err = m.probabilities(x[ok], name) - np.eye(classes)[y[ok]]
        err = err[:, 1:] if classes == 2 else err
        g = err.T @ x[ok] / ok.sum() + problem.reg * (1 - l1_ratio) * w[:, :-1]
        assert np.abs(err.mean(axis=0)).max() < 1e-8
        l1, at = problem.reg * l1_ratio, w[:, :-1]
        assert np.abs(np.where(at != 0, g + l1 * np.sign(at), 0)).max() < 1e-8 and (np.abs(g[at == 0]) <= l1 + 1e-8).all()
    if l1_ratio == 1.0:
        assert (m.weights["all"][:, :-1] == 0).any()
    folds = [0, 1, 2]
    null_id = rows.withColumn("id", F.when(F.col("id") != 3, F.col("id")))
    oof, tst = logistic.oof(null_id, null_id.select("id", "x"), folds, classes, reg, "lr", l1_ratio)
    assert oof.count() == tst.count() == classes * len(y) and oof.filter("id IS NULL").count() == classes
    twice = rows.select("id", "x").limit(10)
    assert logistic.oof(rows, twice.unionByName(twice), folds, classes, reg, "lr", l1_ratio)[1].count() == 10 * classes  # one row per id
    with pytest.raises(Exception, match="labels must be"):
        logistic.fit(rows.withColumn("y", F.when(F.col("id") != 7, F.col("y"))), classes, many)
    one = logistic.fit(rows.filter("y = 0"), classes, {"one": logistic.Problem(reg)})
    assert np.allclose(one.probabilities(x[:3], "one"), [[1.0] + [0.0] * (classes - 1)] * 3)


# ---- random forest -------------------------------------------------------------------------------

def test_forest_counts_and_splits_of_the_first_level(spark, data):
    from foldwise.operators import random_forest as RF
    df, x, y, fold = data
    rows = df.withColumn("h", F.xxhash64("id", "x")).cache()
    h = np.array([r[0] for r in rows.orderBy("id").select("h").collect()], np.int64).view(np.uint64)
    s = RF.Settings(6, 4, weights=[1.0, 2.0, 0.5])
    forest = RF.fit(rows, [0, 1, 2], 3, s)
    some = RF.fit(rows.repartition(5), [0, 1, 2], 3, s, group_bytes=40_000)  # many passes a level, other partitions: the same trees
    bins = RF.binned(x, forest.edges, s.max_bins)
    w = np.array(s.weights)
    for m, f in enumerate([0, 1, 2]):
        ok = fold != f
        for t, (tree, other) in enumerate(zip(forest.trees[f], some.trees[f], strict=True)):
            assert (tree.left == other.left).all() and (tree.right == other.right).all() and (tree.counts == other.counts).all()
            n = RF.copies(h, s.seed, m, t)[ok].astype(float)
            assert abs(n.mean() - 1) < 0.12 and 0.3 < (n == 0).mean() < 0.44
            leaf = tree.nodes(np.ascontiguousarray(bins[ok]).reshape(-1), np.arange(ok.sum()) * x.shape[1], 4)
            inner = np.flatnonzero((tree.left != np.arange(len(tree.left))))
            a, pred, is_leaf = tree.left[inner], (tree.counts * w).argmax(axis=1), tree.left == np.arange(len(tree.left))
            assert not (is_leaf[a] & is_leaf[a + 1] & (pred[a] == pred[a + 1])).any()
            for node in np.unique(leaf):
                assert (np.bincount(y[ok][leaf == node], weights=n[leaf == node], minlength=3) == tree.counts[node]).all()
            # the root's cut is the best of its candidates
            gini = lambda c: ((c * w) ** 2).sum() / max((c * w).sum(), 1e-300)
            count = lambda keep: np.bincount(y[ok][keep], weights=n[keep], minlength=3)
            feats = np.argsort(RF.draw(s.seed, m, t, np.zeros(1), 7, 1)[0], kind="stable")[:3]
            best = max(gini(count(bins[ok][:, j] <= c)) + gini(count(bins[ok][:, j] > c)) for j in feats for c in range(s.max_bins))
            a, b = tree.counts[1], tree.counts[2]
            assert gini(a) + gini(b) == pytest.approx(best)
    null_id = rows.withColumn("id", F.when(F.col("id") != 3, F.col("id")))
    oof, tst = RF.oof(null_id, null_id.select("id", "x"), [0, 1, 2], 3, "rf", RF.Settings(12, 6))
    p = oof.join(rows.select("id", "y"), "id").toPandas().pivot_table(index=["id", "y"], columns="class", values="p")
    assert tst.count() == 3 * len(y) and np.allclose(p.sum(axis=1), 1)
    assert (p.to_numpy().argmax(axis=1) == p.index.get_level_values("y")).mean() > 0.7


def test_forest_splits_nominal_features_by_sets(spark):
    from foldwise.operators import random_forest as RF
    rng = np.random.default_rng(3)
    c = rng.integers(0, 9, 3000)
    y = np.isin(c, [1, 4, 6]).astype(int)
    df = spark.createDataFrame([(i, [float(c[i])], int(y[i]), i % 2) for i in range(3000)], "id long, x array<double>, y int, fold int")
    forest = RF.fit(df, [0, 1], 2, RF.Settings(3, 1, nominal={0: 10}))
    assert all(len(t.left) == 3 for ts in forest.trees.values() for t in ts)
    assert (forest.probabilities(c[:, None].astype(float), 0).argmax(axis=1) == y).all()
    with pytest.raises(ValueError):
        RF.fit(df.withColumn("y", F.when(F.col("id") != 7, F.col("y"))), [0, 1], 2)


def test_extra_trees_blocks_of_rows_give_the_sums_of_all_rows():
    """batches go through the trees in blocks, each value is looked up once; missing values take no part in spans and go right."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    x, y, fold = rng.normal(size=(500, 3)), rng.integers(0, 2, 500), rng.integers(0, 2, 500)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:4, 1] = np.inf
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + 70].tolist(), pa.list_(pa.float64())), pa.array(y[i : i + 70], pa.int32()), pa.array(fold[i : i + 70], pa.int32())], ["x", "y", "fold"])
               for i in range(0, 500, 70)]
    assert [len(b[0]) for b in extra_trees._blocks(batches)] == [500]
    feature, threshold, left = np.array([0, -1, -1], np.int32), np.array([0.1, 0, 0]), np.array([1, -1, -1], np.int32)
    place, feats, nodes = np.array([-1, 0, 1], np.int32), np.array([[1, 2], [2, -1]]), np.array([1, 2])
    cuts = np.array([[0.2, -0.3], [0.0, np.nan]])

    class Plan:
        def __init__(self, value):
            self.value = {(0, 0): value}

    x = np.where(np.isfinite(x), x, np.nan)
    mine = fold != 0
    right = ~(x[:, 0] <= 0.1)
    assert (extra_trees.route(x, feature, threshold, left, 1) == 1 + right).all()
    got = {r["node"]: r for b in extra_trees._spans(Plan((feature, threshold, left, place, feats, nodes, 1)), [0], 2)(batches) for r in b.to_pylist()}
    for node, side in ((1, mine & ~right), (2, mine & right)):
        for j in range(2):
            f = feats[node - 1, j]
            want = (None, None) if f < 0 else (np.nanmin(x[side, f]), np.nanmax(x[side, f]))
            assert (got[node][f"lo{j}"], got[node][f"hi{j}"]) == want
    got = {r["node"]: r for b in extra_trees._counts(Plan((feature, threshold, left, place, feats, nodes, cuts, 1)), [0], 2, 2)(batches) for r in b.to_pylist()}
    for node, side in ((1, mine & ~right), (2, mine & right)):
        for j in range(2):
            for c in range(2):
                assert got[node][f"l{j}_{c}"] == (side & (y == c) & (x[:, feats[node - 1, j]] <= cuts[node - 1, j])).sum()


def test_boosted_trees_are_compact():
    """a tree is some bytes a node for the driver, the broadcast and the tasks, and routes rows without values as it says."""
    import pickle

    rng, absent = np.random.default_rng(5), 64
    tree, open_ = boost.Tree(), [0]
    for _ in range(10):
        for n in open_:
            tree.feature[n], tree.cut[n], tree.missing[n] = int(rng.integers(0, 4)), int(rng.integers(0, absent)), int(rng.integers(0, 2))
            tree.left[n] = tree.leaf(float(rng.normal()))
            tree.leaf(float(rng.normal()))
        open_ = [m for n in open_ for m in (tree.left[n], tree.left[n] + 1) if rng.random() < 0.9]
    steps = boost.Steps(tree.arrays(), absent)
    size = len(tree.feature)
    assert size > 500 and len(pickle.dumps(tree)) < 20 * size and len(pickle.dumps(steps)) < 64 * size
    bins = rng.integers(0, absent + 1, (300, 4)).astype(np.uint8)
    for row, got in zip(bins, steps.nodes(bins, 10).tolist(), strict=True):
        node = 0
        while tree.feature[node] >= 0:
            b = row[tree.feature[node]]
            node = tree.left[node] + (tree.missing[node] if b == absent else int(b > tree.cut[node]))
        assert node == got


def test_forest_tasks_count_every_tree_of_four_with_one_hash():
    """the kernel's counts by (node, candidate, bin, class) are those of a plain loop, for trees that share a hash, over several batches."""
    import pyarrow as pa

    from foldwise.operators import random_forest as RF

    rng, width, d = np.random.default_rng(8), 5, 3
    h, bins = rng.integers(-(2**62), 2**62, 400), rng.integers(0, 4, (400, d)).astype(np.uint8)
    y, fold = rng.integers(0, 2, 400).astype(np.int32), rng.integers(0, 2, 400).astype(np.int32)
    batches = [pa.RecordBatch.from_arrays([pa.array(h[i : i + 90]), boost.packed(bins[i : i + 90]), pa.array(y[i : i + 90]), pa.array(fold[i : i + 90])], ["h", "bins", "y", "fold"]) for i in range(0, 400, 90)]
    plan = {}
    for t in range(6):
        tree = RF.Tree(2, width)
        tree.split(np.zeros(1, int), np.array([t % d]), (np.arange(width) > 1).astype(np.uint8)[None], np.ones((1, 2)), np.full((1, 2), 2.0))
        plan[0, t] = tree, np.array([-1, 0, -1 if t == 5 else 1]), np.array([[0, 2], [1, 0]], np.int32)[: 1 if t == 5 else 2]

    class Plan:
        value = plan

    got = {r["key"]: np.frombuffer(r["v"][3:], r["v"][:3].decode()) for b in RF._counts(Plan, [1], 6, 1, width, 2, 9)(batches) for r in b.to_pylist()}
    assert len(got) == 6
    for (_, t), (_, place, feats) in plan.items():
        want = np.zeros((len(feats), 2, width, 2), int)
        times = RF.copies(h.view(np.uint64)[fold != 1], 9, 0, t)
        for row, c, n in zip(bins[fold != 1], y[fold != 1], times.tolist(), strict=True):
            at = place[1 + int(row[t % d] > 1)]
            if at >= 0:
                for j, f in enumerate(feats[at]):
                    want[at, j, row[f], c] += n
        assert (got[t].reshape(want.shape) == want).all()
