"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator of SURVEY section 2.

Doubles in outputs are rounded to 6 digits so that an independent engine can be
compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.folds import holdout_and_kfold
from foldwise.operators.impute import fit_median
from foldwise.plans import flagship as FL
from foldwise.plans.prepare import SEED, orders_train_test
from foldwise.sources.tables import orders_base

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round6(c):
    """Round half up to 6 decimals with plain IEEE steps (x*1e6 + 0.5, floor, /1e6), so any engine
    doing the same steps gets the same double (``round`` differs between engines on ties)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def r6(c, alias: str):
    return round6(c).alias(alias)


@register("flagship_retention_nb")
def q_flagship(spark: SparkSession, sf: str) -> DataFrame:
    return FL.status_slice(spark, sf)


@register("w7_w5_holdout_folds")
def q_split(spark: SparkSession, sf: str) -> DataFrame:
    return holdout_and_kfold(orders_base(spark, sf), "id", "y_bin", 0.2, 5, SEED).select("id", "split", "fold")


@register("i1_median")
def q_median(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = orders_train_test(spark, sf)
    cols = ["c_acctbal", "li_qty", "li_disc"]
    med = fit_median(train, cols)
    return spark.createDataFrame([(c, float(med[c])) for c in cols], "col string, median double").select("col", r6("median", "median"))


@register("t2_mestimate_te")
def q_te_m(spark: SparkSession, sf: str) -> DataFrame:
    tr, ts = FL.status_features(spark, sf)
    cols = [r6(c, c) for c in ["o_orderpriority_te", "c_mktsegment_te"]]
    return tr.select("id", F.lit("train").alias("part"), *cols).unionByName(ts.select("id", F.lit("test").alias("part"), *cols))


@register("m10_naive_bayes_oof")
def q_nb(spark: SparkSession, sf: str) -> DataFrame:
    _, _, oof, tst = FL.status_predictions(spark, sf)
    return (oof.select("id", "fold", "class", r6("p", "p"))
            .unionByName(tst.select("id", F.lit(-1).alias("fold"), "class", r6("p", "p"))))


def _load_all():
    from foldwise.plans import queries_ensemble, queries_features, queries_knn, queries_models, queries_target  # noqa: F401


_load_all()
