"""Scalar column expressions (N1-N4, N11, N15, N16, P7).  All JVM-side, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def log1p_clip(x) -> Column:
    """``log1p(max(x, 0))``."""
    v = _c(x).cast("double")
    return F.log1p(F.when(v < 0, F.lit(0.0)).otherwise(v))  # null stays null


def ratio_plus_one(num, den) -> Column:
    """``num / (den + 1)``; a zero denominator gives null instead of an ANSI error."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double") + F.lit(1.0))


def product(*xs) -> Column:
    """Product of columns."""
    out = _c(xs[0]).cast("double")
    for x in xs[1:]:
        out = out * _c(x).cast("double")
    return out


def total(*xs) -> Column:
    """Sum of columns."""
    out = _c(xs[0]).cast("double")
    for x in xs[1:]:
        out = out + _c(x).cast("double")
    return out


def sigmoid(x, clip: float | None = 20.0) -> Column:
    """Logistic function, input clipped to +-clip (None: unclipped)."""
    z = _c(x).cast("double")
    if clip is not None:  # when-based clip: a null input stays null (greatest/least skip nulls)
        z = F.when(z > clip, F.lit(clip)).when(z < -clip, F.lit(-clip)).otherwise(z)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def label_to_binary(x, positive: str) -> Column:
    """Map the positive label to 1.0, others to 0.0 (e.g. finished -> 1, open -> 0)."""
    return F.when(_c(x) == F.lit(positive), F.lit(1.0)).otherwise(F.lit(0.0))


def binary_to_label(p, positive: str, negative: str, threshold: float = 0.5) -> Column:
    """``p >= t`` -> positive label (t = 0.5 for probabilities, 0 for margins)."""
    return F.when(_c(p) >= F.lit(threshold), F.lit(positive)).otherwise(F.lit(negative))


def cross(a, b, sep: str = "_") -> Column:
    """Category cross as text; nulls become 'nan' first (as ``astype(str)``)."""
    return F.concat_ws(sep, F.coalesce(_c(a).cast("string"), F.lit("nan")), F.coalesce(_c(b).cast("string"), F.lit("nan")))
