"""Minimum slice, the binary order-status flow on table B:

hold-out + stratified folds -> median impute -> out-of-fold m-estimate target
encoding (test from full train) -> Gaussian naive Bayes OOF + fold-averaged test
-> threshold 0.5 -> accuracy of the OOF and of the hold-out predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.bayes import naive_bayes_oof
from foldwise.operators.impute import apply_fill, fit_median
from foldwise.operators.metrics import accuracy
from foldwise.operators.target import fit_target_encoder
from foldwise.plans.prepare import orders_train_test

TE_COLS = ["o_orderpriority", "c_mktsegment"]
IMPUTE_COLS = ["c_acctbal", "li_qty"]
NB_FEATS = ["o_orderpriority_te", "c_mktsegment_te", "o_totalprice", "c_acctbal", "li_qty"]


def status_features(spark: SparkSession, sf_dir: str):
    train, test = orders_train_test(spark, sf_dir, "y_bin")
    med = fit_median(train, IMPUTE_COLS)
    train, test = apply_fill(train, med), apply_fill(test, med)
    te = fit_target_encoder(train, TE_COLS, y="y_bin", kind="mestimate", m=1.0, test_mode="full")
    return te.apply_oof(train), te.apply_test(test)


def status_predictions(spark: SparkSession, sf_dir: str):
    tr, ts = status_features(spark, sf_dir)
    oof, tst, _ = naive_bayes_oof(tr, ts, NB_FEATS, y="y_bin", model="nb")
    return tr, ts, oof, tst


def status_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr, ts, oof, tst = status_predictions(spark, sf_dir)
    p1_oof = oof.filter(F.col("class") == 1).select("id", "p").join(tr.select("id", "y_bin"), "id")
    p1_tst = tst.filter(F.col("class") == 1).select("id", "p").join(ts.select("id", "y_bin"), "id")
    both = (p1_oof.withColumn("part", F.lit("oof"))
            .unionByName(p1_tst.withColumn("part", F.lit("test")))
            .withColumn("pred", (F.col("p") >= 0.5).cast("double")))
    return accuracy(both, "pred", "y_bin", by=["part"])
