"""Column math functions (N2-N8, R15). All but R15 are built-in expressions, codegen'd."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def saturation(x, mu=0.1) -> Column:
    """Reach curve (1 - e^{-mu x}) / (1 + e^{-mu x})."""
    e = F.exp(-_c(mu) * _c(x))
    return (F.lit(1.0) - e) / (F.lit(1.0) + e)


def sigmoid(z) -> Column:
    """1 / (1 + e^{-z})."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def logit(p) -> Column:
    """ln(p / (1 - p)); null outside (0, 1)."""
    p = _c(p)
    return F.when((p > 0) & (p < 1), F.log(p / (F.lit(1.0) - p)))


def log_base(b, x) -> Column:
    """log_b(x) (N7); null for x <= 0."""
    return F.when(_c(x) > 0, F.log(float(b), _c(x)) if not isinstance(b, Column) else F.log(_c(x)) / F.log(b))


def is_finite(x) -> Column:
    """False for NaN and +-inf."""
    return F.coalesce(F.abs(_c(x)) < F.lit(math.inf), F.lit(False))


def normal_pdf(x, mu, sigma) -> Column:
    """1/(sigma sqrt(2 pi)) exp(-(x-mu)^2 / (2 sigma^2))."""
    x, mu, sigma = _c(x), _c(mu), _c(sigma)
    return F.exp(-((x - mu) * (x - mu)) / (F.lit(2.0) * sigma * sigma)) / (sigma * F.lit(math.sqrt(2 * math.pi)))


def binomial_pmf(n, x, p) -> Column:
    """C(n, x) p^x (1-p)^(n-x) for any n (N6); 0 outside 0..n. The coefficient is a sum of logarithms."""
    n, x, p = _c(n).cast("long"), _c(x).cast("long"), _c(p)
    k = F.least(x, n - x)
    log_choose = F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.lit(0.0),
                                           lambda acc, i: acc + F.log((n - k + i) / i))).otherwise(0.0)
    inside = F.exp(log_choose) * F.pow(p, x.cast("double")) * F.pow(F.lit(1.0) - p, (n - x).cast("double"))
    return F.when((x < 0) | (x > n), F.lit(0.0)).when(n.isNotNull() & x.isNotNull(), inside)


def power_law(x, c=1.0, a=2.0) -> Column:
    """c * x^{-a}."""
    return _c(c) * F.pow(_c(x), -_c(a))


def four_significant(x) -> Column:
    """Round to 4 significant digits (R15): the binary value, as C and Python print it.

    Java's formatter rounds the shortest decimal text instead, which differs at
    ties (1.0005 is a little less than its text says). For report tables: an
    Arrow batch at a time, not a built-in expression.
    """
    @F.pandas_udf("double")
    def printed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: float(f"{v:.3e}"), na_action="ignore")

    return printed(_c(x).cast("double"))


def dot(a, b) -> Column:
    """Dot product of two numeric arrays."""
    prod = F.zip_with(_c(a), _c(b), lambda u, v: u.cast("double") * v.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def angle(a, b) -> Column:
    """Angle in radians between two vectors (N8); null when a vector is zero."""
    cos = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos)))
