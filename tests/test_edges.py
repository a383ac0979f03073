"""Edge cases: ids below zero, missing and infinite numbers, constant columns, gaps in class ids, unmatched weights."""

import math

import numpy as np
import pytest

from foldwise.operators import encode as E
from foldwise.operators.bayes import naive_bayes_oof
from foldwise.operators.knn import knn_oof
from foldwise.operators.quantile import exact_quantiles
from foldwise.operators.scale import fit_yeo_johnson
from foldwise.plans.blend import fixed_blend, mean_over


def test_knn_keeps_negative_ids_of_both_parts(spark):
    rng = np.random.default_rng(0)
    x = lambda: [float(v) for v in rng.normal(size=3)]
    train = spark.createDataFrame([(i, i % 4, i % 2, x()) for i in range(-20, 20)], "id long, fold int, label long, x array<double>")
    test = spark.createDataFrame([(i, x()) for i in (-3, -1, 2, 5)], "id long, x array<double>")
    oof, tst = knn_oof(train, test, 3, 2)
    assert {r.id for r in oof.select("id").distinct().collect()} == set(range(-20, 20))
    assert {r.id for r in tst.select("id").distinct().collect()} == {-3, -1, 2, 5}


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, math.nan], [5.0] * 40, [1.0] * 30 + [2.0] * 31, [7.0], [float(v) for v in np.linspace(-3, 9, 1001)]])
def test_quantiles_equal_numpy_without_nan(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    clean = [v for v in values if not math.isnan(v)]
    assert exact_quantiles(df, ["x"], probs)["x"] == pytest.approx(list(np.quantile(clean, probs)))


def test_quantiles_of_infinities_and_nothing(spark):
    df = spark.createDataFrame([(v, None) for v in (-math.inf, 1.0, 2.0, 3.0, math.inf)], "x double, y double")
    got = exact_quantiles(df, ["x", "y"], [0.0, 0.5, 1.0])
    assert got == {"x": [-math.inf, 2.0, math.inf], "y": [None, None, None]}


def test_quantiles_bracket_again(spark, monkeypatch):
    monkeypatch.setattr("foldwise.operators.quantile.MAX_BAND", 20)
    v = np.random.default_rng(1).normal(size=3000)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    assert exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], accuracy=20)["x"] == pytest.approx(list(np.quantile(v, [0.1, 0.5, 0.9])))


def test_yeo_johnson_edges(spark):
    df = spark.createDataFrame([(3.0, None, math.exp(-i)) for i in range(50)], "c double, n double, s double")
    fit = fit_yeo_johnson(df, ["c", "n", "s"])
    assert fit["c"][0] == 1.0 and fit["n"][0] == 1.0
    assert fit["s"][0] < -3.1  # beyond the first bracket


def test_naive_bayes_class_ids(spark):
    df = spark.createDataFrame([(i, i % 2, 2 * (i % 3 // 2), float(i % 3)) for i in range(60)], "id long, fold int, y long, x double")
    oof, _, _ = naive_bayes_oof(df, None, ["x"])
    assert {r["class"] for r in oof.select("class").distinct().collect()} == {0, 2}


def test_blend_needs_a_weight_for_every_model(spark):
    pred = spark.createDataFrame([(1, "a", 0, 0.5), (1, "b", 0, 0.25)], "id long, model string, class int, p double")
    for weights in ({"a": 1.0}, {"a": 0.5, "b": 0.25, "c": 0.25}):
        with pytest.raises(ValueError):
            fixed_blend(pred, weights)
    assert fixed_blend(pred, {"a": 0.5, "b": 0.5}).first().p == pytest.approx(0.375)
    with pytest.raises(ValueError):
        mean_over(pred, "class", ["id", "class"])


def test_sparse_one_hot_has_no_level_limit(spark):
    train = spark.createDataFrame([(f"v{i:04d}",) for i in range(1500)], "c string")
    (out,), size = E.sparse_one_hot(train, [spark.createDataFrame([("v0000",), ("v1499",), ("new",), (None,)], "c string")], ["c"])
    assert size == {"c": 1500}
    assert sorted((r.c or "", r.c_hot) for r in out.collect()) == [("", None), ("new", None), ("v0000", 0), ("v1499", 1499)]


def test_fixed_crosses_apply_to_all_rows(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id long, p string, q string")
    tr, _, names = E.fixed_crosses_ordinal(rows, rows, [("p", "q")], fit_on=rows.filter("id < 3"))
    assert sorted((r.id, r[names[0]]) for r in tr.collect()) == [(1, 0), (2, 1), (3, -1)]
