"""Imputers and missing flags (I1-I6).  Fit returns plain values (one per column); apply is ``coalesce``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.quantile import exact_median


def fit_median(train: DataFrame, cols: list[str]) -> dict:
    """Exact interpolated median of the training rows (``ml.Imputer`` is not interpolated)."""
    return exact_median(train, cols)


def fit_mode(train: DataFrame, cols: list[str]) -> dict:
    """Most frequent non-null value; ties go to the smallest value.

    ONE aggregation for all columns to (col, value, count) -- partial aggregation keeps the
    shuffle at distinct values -- then per column the max by (count desc, value asc).
    Values are compared in the column's own type (numbers as numbers)."""
    out = {}
    types = dict(train.dtypes)
    same = {}
    for c in cols:
        same.setdefault(types[c], []).append(c)
    for _, group in same.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("value")) for c in group])
        counts = (train.select(F.inline(pairs)).filter(F.col("value").isNotNull())
                  .groupBy("col", "value").agg(F.count(F.lit(1)).alias("n")))
        best = counts.groupBy("col").agg(
            F.min_by(F.col("value"), F.struct((-F.col("n")).alias("nn"), F.col("value").alias("v"))).alias("m")).collect()
        out.update({r["col"]: r["m"] for r in best})
    return {c: out.get(c) for c in cols}


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    """Apply fitted fill values (``coalesce``), all columns in one projection."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns])


def fill_constant(df: DataFrame, cols: list[str], value: str = "Unknown") -> DataFrame:
    """Constant fill for categories ('NA', 'Missing', 'Unknown')."""
    return df.fillna(value, subset=cols)


def missing_flags(df: DataFrame, cols: list[str], suffix: str = "_missing") -> DataFrame:
    """I4: ``<c>_missing`` = 1 when null; make these before any imputation."""
    return df.select("*", *[F.isnull(c).cast("int").alias(c + suffix) for c in cols])


def scrub_non_finite(c: Column, fill: float) -> Column:
    """NaN / +-Inf / null -> ``fill`` (e.g. 1/K for class-probability features)."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(fill)).otherwise(c)


def null_as_text(c: Column) -> Column:
    """``astype(str)`` semantics: a null category becomes the text 'nan'."""
    return F.coalesce(c.cast("string"), F.lit("nan"))
