"""Properties and brute-force cross-checks on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from foldwise.operators.bayes import naive_bayes_oof
from foldwise.operators.folds import hash_key, holdout_and_kfold, stratified_rank
from foldwise.operators.knn import knn_oof
from foldwise.operators.quantile import exact_quantiles
from foldwise.plans import blend as B
from foldwise.sources.tables import embeddings_base, orders_base


def test_two_level_rank_equals_global_row_number(spark):
    base = orders_base(spark, SF001)
    r = stratified_rank(base, "id", "y_bin", 42, prefix=2)
    w = Window.partitionBy("y_bin").orderBy(hash_key("id", 42), "id")
    ref = base.select("id", (F.row_number().over(w) - 1).alias("ref"))
    bad = r.join(ref, "id").filter(F.col("_rank") != F.col("ref")).count()
    assert bad == 0


def test_fold_sizes_per_class_differ_by_at_most_one(spark):
    s = holdout_and_kfold(orders_base(spark, SF001), "id", "y_bin", 0.2, 5, 42)
    sizes = s.filter("split = 'train'").groupBy("y_bin", "fold").count().groupBy("y_bin").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in sizes)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(size=997) * 10, 2).tolist() + [5.0] * 300  # heavy tie block
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["x"], probs)["x"]
    assert got == pytest.approx(np.percentile(vals, [p * 100 for p in probs]).tolist())


def test_naive_bayes_probabilities_sum_to_one(spark):
    s = holdout_and_kfold(orders_base(spark, SF001), "id", "y_bin", 0.2, 5, 42).filter("split = 'train'")
    s = s.fillna(0.0, ["c_acctbal", "li_qty"])
    oof, _, _ = naive_bayes_oof(s, None, ["o_totalprice", "c_acctbal", "li_qty"], "y_bin")
    sums = oof.groupBy("id").agg(F.sum("p").alias("s")).agg(F.min("s"), F.max("s")).collect()[0]
    assert sums[0] == pytest.approx(1.0) and sums[1] == pytest.approx(1.0)


def test_blend_with_unit_weight_is_the_model(spark):
    pred = spark.createDataFrame([(1, "a", 0, 0.3), (1, "a", 1, 0.7), (1, "b", 0, 0.9), (1, "b", 1, 0.1)],
                                 "id long, model string, class int, p double")
    got = {r["class"]: r["p"] for r in B.fixed_blend(pred, {"a": 1.0, "b": 0.0}).collect()}
    assert got == pytest.approx({0: 0.3, 1: 0.7})


def test_knn_equals_brute_force(spark):
    s = holdout_and_kfold(embeddings_base(spark, SF001, 8), "id", "label", 0.2, 5, 42)
    tr, ts = s.filter("split = 'train'"), s.filter("split = 'test'").drop("fold")
    oof, _ = knn_oof(tr, ts, 5, 10)
    got = {(r["id"], r["class"]): r["p"] for r in oof.collect()}
    rows = tr.select("id", "fold", "label", "x").collect()
    X = np.array([r["x"] for r in rows])
    for i, r in enumerate(rows[:40]):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        cand = [j for j in range(len(rows)) if rows[j]["fold"] != r["fold"]]
        cand.sort(key=lambda j: (np.floor(d[j] * 1e9 + 0.5) / 1e9, rows[j]["id"]))
        labs = [rows[j]["label"] for j in cand[:5]]
        for c in range(10):
            assert got[(r["id"], c)] == pytest.approx(labs.count(c) / 5)


def test_encoders_keep_row_count(spark):
    from foldwise.operators import encode as E
    base = orders_base(spark, SF001)
    n = base.count()
    assert E.fit_frequency(base, ["n_name", "c_mktsegment"]).apply(base).count() == n
    assert E.fit_ordinal(base, ["n_name"]).apply(base).count() == n
