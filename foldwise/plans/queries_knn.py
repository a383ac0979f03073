"""Registered kNN queries on the vector table V (embeddings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.folds import holdout_and_kfold
from foldwise.operators.knn import knn_oof, lsh_neighbours, tune_lsh
from foldwise.plans.registry import r6, register
from foldwise.session import cut_lineage
from foldwise.sources.tables import embeddings_base


def vectors_train_test(spark: SparkSession, sf: str):
    s = cut_lineage(holdout_and_kfold(embeddings_base(spark, sf), "id", "label", 0.2, 5, 42))
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split", "fold")


def _out(oof: DataFrame, tst: DataFrame) -> DataFrame:
    return (oof.select("id", "fold", "class", r6("p", "p"))
            .unionByName(tst.select("id", F.lit(-1).alias("fold"), "class", r6("p", "p"))))


@register("m11_knn_oof")
def q_knn(spark, sf):
    tr, ts = vectors_train_test(spark, sf)
    return _out(*knn_oof(tr, ts, 21, 10, "uniform"))


@register("m11_knn_distance_weighted_oof")
def q_knn_w(spark, sf):
    tr, ts = vectors_train_test(spark, sf)
    return _out(*knn_oof(tr, ts, 15, 10, "distance"))


@register("j5_lsh_neighbours")
def q_lsh(spark, sf, k=10, target=0.9):
    """J5, approximate: the k nearest vectors of every vector from random-projection buckets as wide as the wanted recall asks for; with the
    recall measured on a sample and the share of all pairs met."""
    v = cut_lineage(embeddings_base(spark, sf).select("id", "x"))
    ref, queries = v.select(F.col("id").alias("tid"), "x"), v.select(F.col("id").alias("qid"), "x")
    bucket, recall, share = tune_lsh(ref, queries, k, target)
    found, _ = lsh_neighbours(ref, queries, k, bucket=bucket)
    return found.select("qid", "tid", r6("d", "d"), F.lit(recall).alias("recall"), F.lit(share).alias("pair_share"))
