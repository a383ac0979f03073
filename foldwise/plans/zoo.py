"""Model zoos of SQL-checkable scorers (naive Bayes on different feature sets) whose stored
predictions feed the blend / search / metric queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from foldwise.operators.bayes import naive_bayes_oof
from foldwise.operators.impute import apply_fill, fit_median
from foldwise.operators.target import fit_multiclass_target_encoder, fit_target_encoder
from foldwise.plans.prepare import orders_train_test
from foldwise.session import cut_lineage

NUM = ["o_totalprice", "c_acctbal", "li_qty", "li_disc"]
FILL = ["c_acctbal", "li_qty", "li_disc"]
BIN_MODELS = {
    "nb_num": NUM,
    "nb_te": ["o_orderpriority_te", "c_mktsegment_te", "n_name_te"],
    "nb_all": NUM + ["o_orderpriority_te", "c_mktsegment_te", "n_name_te"],
}
MC_MODELS = {
    "nbc_num": NUM,
    "nbc_te": [f"n_name_te_{i}" for i in range(5)] + ["li_qty"],
}
PRIORITY_LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _union(dfs):
    return reduce(DataFrame.unionByName, dfs)


def status_features(spark: SparkSession, sf: str):
    tr, ts = orders_train_test(spark, sf, "y_bin")
    med = fit_median(tr, FILL)
    tr, ts = apply_fill(tr, med), apply_fill(ts, med)
    te = fit_target_encoder(tr, ["o_orderpriority", "c_mktsegment", "n_name"], "y_bin", kind="mestimate", m=1.0, test_mode="full")
    return cut_lineage(te.apply_oof(tr)), cut_lineage(te.apply_test(ts))


def status_zoo(spark: SparkSession, sf: str):
    """Table B: (train, test, oof long, test long) for the three binary naive Bayes models."""
    tr, ts = status_features(spark, sf)
    oofs, tsts = [], []
    for name, feats in BIN_MODELS.items():
        o, t, _ = naive_bayes_oof(tr, ts, feats, "y_bin", model=name)
        oofs.append(o)
        tsts.append(t)
    return tr, ts, cut_lineage(_union(oofs)), cut_lineage(_union(tsts))


def priority_filled(spark: SparkSession, sf: str):
    """Table C with label index y (sorted priorities) and median fill."""
    from foldwise.plans.queries_target import multiclass_train_test
    tr, ts = multiclass_train_test(spark, sf)
    med = fit_median(tr, FILL)
    return apply_fill(tr, med), apply_fill(ts, med)


def priority_features(spark: SparkSession, sf: str):
    """Table C with label index y (sorted priorities), median fill and T6 encoding of n_name."""
    tr, ts = priority_filled(spark, sf)
    te = fit_multiclass_target_encoder(tr, ["n_name"], "y", 5)
    return cut_lineage(te.apply_oof(tr)), cut_lineage(te.apply_test(ts))


def priority_zoo(spark: SparkSession, sf: str):
    tr, ts = priority_features(spark, sf)
    oofs, tsts = [], []
    for name, feats in MC_MODELS.items():
        o, t, _ = naive_bayes_oof(tr, ts, feats, "y", model=name)
        oofs.append(o)
        tsts.append(t)
    return tr, ts, cut_lineage(_union(oofs)), cut_lineage(_union(tsts))
