"""Inverse standard normal CDF as a column expression (for the normal-output quantile transform, N8).

Algorithm AS 241 (Wichura, 1988, Applied Statistics 37(3)), double-precision variant
PPND16: three rational approximations (central, tail r <= 5, far tail), each a
degree-7 polynomial ratio evaluated by Horner's rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published AS 241 (PPND16) coefficients, lowest degree first.
A = [3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3, 1.3731693765509461125e+4,
     4.5921953931549871457e+4, 6.7265770927008700853e+4, 3.3430575583588128105e+4, 2.5090809287301226727e+3]
B = [1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
     2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4, 5.2264952788528545610e+3]
C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4]
D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
FF = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]


def horner(coefs: list[float], r: Column) -> Column:
    out = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = out * r + F.lit(c)
    return out


def inv_norm_cdf(p: Column) -> Column:
    """Quantile of the standard normal distribution at probability p (0 < p < 1)."""
    q = p - F.lit(0.5)
    r_c = F.lit(0.180625) - q * q
    central = q * horner(A, r_c) / horner(B, r_c)
    r0 = F.sqrt(-F.log(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    near = horner(C, r0 - F.lit(1.6)) / horner(D, r0 - F.lit(1.6))
    far = horner(E, r0 - F.lit(5.0)) / horner(FF, r0 - F.lit(5.0))
    tail = F.when(r0 <= 5.0, near).otherwise(far)
    tail = F.when(q < 0, -tail).otherwise(tail)
    return F.when(F.abs(q) <= 0.425, central).otherwise(tail)


def with_inv_norm_cdf(df, p: str, out: str):
    """Staged form of ``inv_norm_cdf`` for DataFrames: the shared pieces (q, r) are columns, so the
    generated code does not repeat them inside every polynomial."""
    d = df.withColumn("_nq", F.col(p) - F.lit(0.5))
    d = d.withColumn("_nr", F.sqrt(-F.log(F.when(F.col("_nq") < 0, F.col(p)).otherwise(F.lit(1.0) - F.col(p)))))
    q, r0 = F.col("_nq"), F.col("_nr")
    r_c = F.lit(0.180625) - q * q
    central = q * horner(A, r_c) / horner(B, r_c)
    near = horner(C, r0 - F.lit(1.6)) / horner(D, r0 - F.lit(1.6))
    far = horner(E, r0 - F.lit(5.0)) / horner(FF, r0 - F.lit(5.0))
    tail = F.when(r0 <= 5.0, near).otherwise(far)
    z = F.when(F.abs(q) <= 0.425, central).otherwise(F.when(q < 0, -tail).otherwise(tail))
    return d.withColumn(out, z).drop("_nq", "_nr")
