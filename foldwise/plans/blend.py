"""Blending and averaging of stored predictions.

Predictions are long tables ``(id, model, [fold|seed], class, p)``; a blend is a
join with a small weight table and one aggregation by (id, class) -- partial
aggregation keeps the shuffle at one row per (id, class) per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.arrays import argmax
from foldwise.operators.rank import rank_normalised


def weight_table(spark, weights: dict) -> DataFrame:
    return spark.createDataFrame([(m, float(w)) for m, w in weights.items()], "model string, w double")


def fixed_blend(pred: DataFrame, weights: dict, keys: list[str] = ("id", "class")) -> DataFrame:
    """K6 / K7: ``sum_m w_m * p_m`` per (id, class); the weight table has one row per model (broadcast).

    A model without a weight, or a weight without a model, is an error."""
    models = {r["model"] for r in pred.select("model").distinct().collect()}  # one row per model
    if models != set(weights):
        raise ValueError(f"models {sorted(models)} and weights {sorted(weights)} differ")
    w = F.broadcast(weight_table(pred.sparkSession, weights))
    return pred.join(w, "model").groupBy(*keys).agg(F.sum(F.col("w") * F.col("p")).alias("p"))


def mean_over(pred: DataFrame, over: str, keys: list[str]) -> DataFrame:
    """Plain mean of p over the column ``over`` (folds, seeds or models), which may not be a key."""
    if over in keys:
        raise ValueError(f"{over} is averaged over and cannot be a key")
    return pred.groupBy(*keys).agg(F.avg("p").alias("p"))


def rank_average(pred: DataFrame, models: list[str], id_col: str = "id", weights: dict | None = None) -> DataFrame:
    """K8: per model, average rank of p divided by its max; then the mean over models (binary scores), weighted if asked."""
    r = rank_normalised(pred.filter(F.col("model").isin(models)), "p", ["model"], "rn")
    if weights is None:
        return r.groupBy(id_col).agg((F.sum("rn") / F.lit(float(len(models)))).alias("score"))
    if set(weights) != set(models):
        raise ValueError(f"models {sorted(models)} and weights {sorted(weights)} differ")
    w = F.broadcast(weight_table(pred.sparkSession, weights))  # one row per model
    return r.join(w, "model").groupBy(id_col).agg((F.sum(F.col("w") * F.col("rn")) / F.lit(float(sum(weights.values())))).alias("score"))


def to_vector(pred: DataFrame, k: int, keys: list[str] = ("id",)) -> DataFrame:
    """Long (keys, class, p) -> (keys, probs array<double> in class order, absent classes 0)."""
    g = pred.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("class").cast("int"), F.col("p")))).alias("_m"))
    return g.select(*keys, F.array(*[F.coalesce(F.col("_m")[i], F.lit(0.0)) for i in range(k)]).alias("probs"))


def decide(pred_vec: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """N13 + J7: argmax (first on ties) and decode through the label list."""
    out = pred_vec.withColumn("pred", argmax("probs"))
    if labels is not None:
        out = out.withColumn("label", F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("pred") + 1))
    return out
