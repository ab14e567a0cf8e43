"""Tail probabilities of the t, F, chi-square and normal distributions.

They run on result tables only (one row per test). Incomplete beta and gamma use the standard
continued fractions and series; log-gamma and erfc come from the math module.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300
_STEPS = 100_000


def _stirling_rest(a: float) -> float:
    """log-gamma of ``a`` less (a - 1/2) log a - a + log(2 pi) / 2; for large ``a`` by its series, which loses no digits."""
    if a < 10.0:
        return math.lgamma(a) - (a - 0.5) * math.log(a) + a - 0.5 * math.log(2 * math.pi)
    r = 1.0 / (a * a)
    return (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / a


def _log_beta_term(a: float, b: float, x: float, y: float) -> float:
    """log of x^a y^b / B(a, b) for y = 1 - x. The large parts of the log-gammas cancel on paper, not in floats."""
    log_x = math.log1p(-y) if y < 0.5 else math.log(x)
    log_y = math.log1p(-x) if x < 0.5 else math.log(y)
    return (
        a * (log_x + math.log1p(b / a))
        + b * (log_y + math.log1p(a / b))
        - 0.5 * math.log(2 * math.pi * (1 / a + 1 / b))
        + _stirling_rest(a + b)
        - _stirling_rest(a)
        - _stirling_rest(b)
    )


def _beta_tail(a: float, b: float, x: float, y: float) -> float:
    """Incomplete beta function where x lies below the mean, by the contracted continued fraction, whose terms tend
    to those of the gamma distribution as ``a`` grows and so need no more steps."""
    f = a * (a * y - b * x + 1.0) / (a + 1.0)
    f = f if abs(f) > _TINY else _TINY
    c, d = f, 0.0
    for m in range(1, _STEPS):
        at = a + 2 * m
        numerator = (a + m - 1) / (at - 1) * ((a + b + m - 1) / (at - 1)) * m * (b - m) * x * x
        denominator = m + m * (b - m) * x / (at - 1) + (a + m) / (at + 1) * (a * y - b * x + 1.0 + m * (1.0 + y))
        d = denominator + numerator * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = denominator + numerator / c
        c = c if abs(c) > _TINY else _TINY
        f *= c * d
        if abs(c * d - 1.0) < _EPS:
            return math.exp(_log_beta_term(a, b, x, y)) / f
    raise ArithmeticError(f"incomplete beta function does not converge at a={a}, b={b}, x={x}")


def beta_inc(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta function. ``y`` is 1 - x, given where x is so near 1 that the difference would
    have no digits left."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    if a * y >= b * x:
        return _beta_tail(a, b, x, y)
    return 1.0 - _beta_tail(b, a, y, x)


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        for n in range(1, _STEPS):
            term *= x / (a + n)
            total += term
            if term < total * _EPS:
                return 1.0 - front * total
        raise ArithmeticError(f"incomplete gamma function does not converge at a={a}, x={x}")
    b = x + 1.0 - a
    c, d = 1.0 / _TINY, 1.0 / b
    out = d
    for i in range(1, _STEPS):
        step = -i * (i - a)
        b += 2.0
        d = step * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + step / c
        c = c if abs(c) > _TINY else _TINY
        out *= d * c
        if abs(d * c - 1.0) < _EPS:
            return front * out
    raise ArithmeticError(f"incomplete gamma function does not converge at a={a}, x={x}")


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))


def f_upper(f: float, df1: float, df2: float) -> float:
    if f <= 0.0:
        return 1.0
    whole = df2 + df1 * f
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / whole, df1 * f / whole)


def chi2_upper(x: float, df: float) -> float:
    return gamma_upper(df / 2.0, x / 2.0)


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _guarded(fn, *values) -> float | None:
    if any(v is None or v != v for v in values):
        return None
    return fn(*(float(v) for v in values))


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([_guarded(t_two_sided, a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def f_upper_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([_guarded(f_upper, a, b, c) for a, b, c in zip(f, df1, df2)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_upper_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([_guarded(chi2_upper, a, b) for a, b in zip(x, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_upper_p(z: pd.Series) -> pd.Series:
    return pd.Series([_guarded(normal_upper, a) for a in z], dtype="float64")


# Rational approximation of the normal quantile (Wichura 1988, PPND16), numerator and
# denominator per region, constant term first.
CENTRAL = (
    [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
    [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3],
)
MIDDLE = (
    [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9],
)
FAR = (
    [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15],
)


def _ratio(coefficients: tuple[list[float], list[float]], x: Column) -> Column:
    def horner(terms: list[float]) -> Column:
        out = F.lit(terms[-1])
        for c in reversed(terms[:-1]):
            out = out * x + F.lit(c)
        return out

    return horner(coefficients[0]) / horner(coefficients[1])


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile as a native expression; null outside (0, 1)."""
    q = p - F.lit(0.5)
    inner = F.lit(0.180625) - q * q
    tail = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    size = F.when(tail <= 5, _ratio(MIDDLE, tail - F.lit(1.6))).otherwise(_ratio(FAR, tail - F.lit(5.0)))
    return F.when(
        (p > 0) & (p < 1),
        F.when(F.abs(q) <= F.lit(0.425), q * _ratio(CENTRAL, inner)).otherwise(F.signum(q) * size),
    )
