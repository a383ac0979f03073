"""Class weights (M22): ``n / (K * n_c)``, as a small (class, n, weight) table and as a row weight column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.session import join_dim


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """One aggregation to class counts (K rows), weights from the K-row table."""
    c = df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    n, k = c.agg(F.sum("n"), F.count(F.lit(1))).collect()[0]
    return c.withColumn("weight", F.lit(float(n or 0)) / (F.lit(float(k)) * F.col("n")))


def with_weight_column(df: DataFrame, y: str, out: str = "w") -> DataFrame:
    """Attach the balanced weight to every row (the K-row table is broadcast after its count is checked) for ``weightCol``."""
    w = class_weights(df, y).select(y, F.col("weight").alias(out))
    return join_dim(df, w, on=y, how="inner")
