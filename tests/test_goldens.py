"""Hand-computed goldens (FIXTURES.md section 5)."""

import math

import pytest
from pyspark.sql import functions as F

from foldwise.functions.arrays import argmax, boost
from foldwise.operators import encode as E
from foldwise.operators.metrics import macro_f1
from foldwise.operators.rank import average_rank, rank_normalised
from foldwise.operators.scale import apply_center_scale, fit_robust, fit_standard
from foldwise.operators.target import fit_multiclass_target_encoder, fit_target_encoder
from foldwise.operators.weights import class_weights


def test_g1_mestimate_oof(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 0), (2, "a", 0.0, 1), (3, "b", 1.0, 0), (4, "b", 0.0, 1)],
                               "id long, c string, y double, fold int")
    te = fit_target_encoder(df, ["c"], "y", kind="mestimate", m=1.0)
    got = {r["id"]: r["c_te"] for r in te.apply_oof(df).collect()}
    assert got == pytest.approx({1: 0.25, 2: 0.75, 3: 0.25, 4: 0.75})


def test_g2_sigmoid_weight_half(spark):
    rows = [(100, "a", 0.0, 0)]  # the row to encode (fold 0)
    rows += [(i, "a", 1.0 if i < 4 else 0.0, 1) for i in range(5)]      # 5 'a' rows, mean 0.8
    rows += [(10 + i, "b", 0.0, 1) for i in range(5)]                    # fold-1 mean 4/10 = 0.4
    df = spark.createDataFrame(rows, "id long, c string, y double, fold int")
    te = fit_target_encoder(df, ["c"], "y", kind="sigmoid", min_leaf=5, smoothing=1)
    got = {r["id"]: r["c_te"] for r in te.apply_oof(df).collect()}
    assert got[100] == pytest.approx(0.6)


def test_g3_frequency_and_rarity(spark):
    tr = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, c string")
    ts = spark.createDataFrame([(5, "a"), (6, "c")], "id long, c string")
    fe = {r["id"]: r["c_FE"] for r in E.fit_frequency(tr, ["c"]).apply(ts).collect()}
    assert fe == {5: 2.0, 6: None}
    rar = {r["id"]: r["c_RAR"] for r in E.fit_relative_frequency(tr, ["c"], "_RAR", None).apply(ts).collect()}
    assert rar[5] == pytest.approx(2 / 3) and rar[6] is None


def test_g4_unseen_ordinal_label_onehot(spark):
    tr = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    ts = spark.createDataFrame([("z",)], "c string")
    assert E.fit_ordinal(tr, ["c"]).apply(ts).collect()[0]["c_OE"] == -1
    assert E.fit_label_index(tr, ["c"]).apply(ts).collect()[0]["c_LE"] == 3
    lv = E.fit_one_hot_levels(tr, ["c"])
    r = E.one_hot(ts, lv).collect()[0]
    assert [r[f"c_oh_{i}"] for i in range(3)] == [0, 0, 0]


def test_g5_scalers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    rb = fit_robust(df, ["x"])
    assert rb["x"] == pytest.approx((2.5, 3.0))
    st = fit_standard(df, ["x"])
    assert st["x"][1] == pytest.approx(3.535534, abs=1e-6)
    out = apply_center_scale(df.filter("x = 10"), st).collect()[0]["x"]
    assert out == pytest.approx(1.697056, abs=1e-6)
    assert apply_center_scale(df.filter("x = 10"), rb).collect()[0]["x"] == pytest.approx(2.5)


def test_g6_average_rank(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.4), (3, 0.4), (4, 0.9)], "id long, p double")
    r = rank_normalised(average_rank(df, "p", None, "rank"), "p", None, "rn")
    got = {x["id"]: (x["rank"], x["rn"]) for x in r.collect()}
    assert got == {1: (1.0, 0.25), 2: (2.5, 0.625), 3: (2.5, 0.625), 4: (4.0, 1.0)}


def test_g7_g8_boost_and_argmax(spark):
    df = spark.createDataFrame([([0.30, 0.30, 0.30, 0.05, 0.05], [0.2, 0.4, 0.4])], "p array<double>, q array<double>")
    r = df.select(boost("p", [1.5, 1.25, 1.0, 0.75, 0.5]).alias("b"), argmax("q").alias("a")).collect()[0]
    assert r["b"] == pytest.approx([v / 1.1875 for v in [0.45, 0.375, 0.30, 0.0375, 0.025]])
    assert r["a"] == 1
    assert df.select(argmax(boost("p", [1.5, 1.25, 1.0, 0.75, 0.5]))).collect()[0][0] == 0


def test_g9_macro_f1(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, pred int")
    assert macro_f1(df, "pred", "y").collect()[0][0] == pytest.approx(0.388889, abs=1e-6)


def test_g10_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r["y"]: r["weight"] for r in class_weights(df, "y").collect()}
    assert got == pytest.approx({0: 2 / 3, 1: 2.0})


def test_g11_multiclass_te(spark):
    rows = [(1, "a", 1, 0), (2, "a", 0, 1), (3, "a", 0, 1), (4, "a", 2, 1), (5, "b", 1, 0)]
    df = spark.createDataFrame(rows, "id long, c string, y long, fold int")
    te = fit_multiclass_target_encoder(df, ["c"], "y", 3)
    r = {x["id"]: [x[f"c_te_{i}"] for i in range(3)] for x in te.apply_oof(df).collect()}
    assert r[1] == pytest.approx([2 / 3, 0, 1 / 3])
    ts = spark.createDataFrame([(9, "zz")], "id long, c string")
    u = te.apply_test(ts).collect()[0]
    assert [u[f"c_te_{i}"] for i in range(3)] == pytest.approx([1 / 3] * 3)


def test_inverse_normal_matches_stdlib(spark):
    from statistics import NormalDist

    from foldwise.functions.normal import inv_norm_cdf
    ps = [1e-12, 1e-7, 0.001, 0.02425, 0.1, 0.3, 0.5, 0.7, 0.9, 0.97575, 0.999, 1 - 1e-7]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(inv_norm_cdf(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=1e-12, abs=1e-12)


def test_yeo_johnson_expression(spark):
    from foldwise.operators.scale import yeo_johnson
    df = spark.createDataFrame([(-2.0,), (0.0,), (3.0,)], "x double")
    for lam in [0.0, 0.5, 2.0]:
        got = [r[0] for r in df.select(yeo_johnson("x", lam)).collect()]
        exp = []
        for x in [-2.0, 0.0, 3.0]:
            if x >= 0:
                exp.append(math.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam)
            else:
                exp.append(-math.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam))
        assert got == pytest.approx(exp)


def test_ordinal_sorts_integer_codes_numerically(spark):
    tr = spark.createDataFrame([(10,), (2,), (2,), (7,)], "c int")
    got = {r["c"]: r["c_OE"] for r in E.fit_ordinal(tr, ["c"]).apply(tr).collect()}
    assert got == {2: 0, 7: 1, 10: 2}
    lv = E.fit_one_hot_levels(tr, ["c"])
    assert lv["c"] == ["2", "7", "10"]
