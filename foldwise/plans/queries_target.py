"""Registered queries for the target-encoder family T1-T7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import encode as E
from foldwise.operators.target import fit_multiclass_target_encoder, fit_target_encoder
from foldwise.plans.prepare import orders_train_test
from foldwise.plans.registry import r6, register


def _both(tr: DataFrame, ts: DataFrame, cols) -> DataFrame:
    return (tr.select("id", F.lit("train").alias("part"), *cols)
            .unionByName(ts.select("id", F.lit("test").alias("part"), *cols)))


def multiclass_train_test(spark: SparkSession, sf: str):
    """Table C: label = sorted index of o_orderpriority (0..4), hold-out and folds stratified on it."""
    tr, ts = orders_train_test(spark, sf, "o_orderpriority")
    lab = E.fit_label_index(tr, ["o_orderpriority"], "_y")
    tr = lab.apply(tr).withColumnRenamed("o_orderpriority_y", "y")
    ts = lab.apply(ts).withColumnRenamed("o_orderpriority_y", "y")
    return tr, ts


@register("t1_sigmoid_te")
def q_t1(spark: SparkSession, sf: str) -> DataFrame:
    tr, ts = orders_train_test(spark, sf, "y_bin")
    te = fit_target_encoder(tr, ["n_name", "o_year"], "y_bin", kind="sigmoid", min_leaf=100, smoothing=20)
    return _both(te.apply_oof(tr), te.apply_test(ts), [r6("n_name_te", "n_name_te"), r6("o_year_te", "o_year_te")])


@register("t1_sigmoid_te_crosses")
def q_t7(spark: SparkSession, sf: str) -> DataFrame:
    """T1 (200, 30) over the E11 crosses of the top-4 columns by cardinality."""
    tr, ts = orders_train_test(spark, sf, "y_bin")
    tr, ts, names = E.top_cardinality_crosses(tr, ts, ["c_mktsegment", "n_name", "r_name", "o_year", "o_orderpriority"], 4)
    te = fit_target_encoder(tr, names, "y_bin", kind="sigmoid", min_leaf=200, smoothing=30)
    return _both(te.apply_oof(tr), te.apply_test(ts), [r6(n + "_te", n + "_te") for n in names])


@register("t3_mestimate_fold_mean_te")
def q_t3(spark, sf):
    tr, ts = multiclass_train_test(spark, sf)
    te = fit_target_encoder(tr, ["n_name", "c_mktsegment"], "y", kind="mestimate", m=10.0, test_mode="fold_mean", suffix="_TE")
    return _both(te.apply_oof(tr), te.apply_test(ts), [r6("n_name_TE", "n_name_TE"), r6("c_mktsegment_TE", "c_mktsegment_TE")])


@register("t4_mean_te_global_fill")
def q_t4(spark, sf):
    tr, ts = multiclass_train_test(spark, sf)
    tr = tr.withColumn("seg_nat", F.concat_ws("_", "c_mktsegment", "n_name"))
    ts = ts.withColumn("seg_nat", F.concat_ws("_", "c_mktsegment", "n_name"))
    te = fit_target_encoder(tr, ["seg_nat"], "y", kind="mean", test_mode="fold_mean", suffix="_TE")
    return _both(te.apply_oof(tr), te.apply_test(ts), [r6("seg_nat_TE", "seg_nat_TE")])


@register("t5_mean_te_catmean_fill")
def q_t5(spark, sf):
    tr, ts = multiclass_train_test(spark, sf)
    tr = tr.withColumn("seg_nat", F.concat_ws("_", "c_mktsegment", "n_name"))
    ts = ts.withColumn("seg_nat", F.concat_ws("_", "c_mktsegment", "n_name"))
    te = fit_target_encoder(tr, ["seg_nat"], "y", kind="mean_catmean", test_mode="fold_mean", suffix="_TE")
    return _both(te.apply_oof(tr), te.apply_test(ts), [r6("seg_nat_TE", "seg_nat_TE")])


@register("t6_multiclass_te")
def q_t6(spark, sf):
    tr, ts = multiclass_train_test(spark, sf)
    te = fit_multiclass_target_encoder(tr, ["n_name", "o_year"], "y", 5)
    cols = [r6(f"{c}_te_{i}", f"{c}_te_{i}") for c in ["n_name", "o_year"] for i in range(5)]
    return _both(te.apply_oof(tr), te.apply_test(ts), cols)
