"""Shapiro-Wilk W per feature over all values, and normal quantile-quantile data."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import melt
from tarmac.functions.special import normal_quantile, normal_upper
from tarmac.operators.hypothesis import ALPHA
from tarmac.operators.quantiles import GROUP_ROWS
from tarmac.operators.ranks import value_positions
from tarmac.operators.sampling import sample_n

_BLOCK = 50_000

# Polynomial coefficients of the published W approximation (Royston 1995),
# constant term first.
_A_LAST = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
_A_NEXT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
_SMALL_GAMMA = [-2.273, 0.459]
_SMALL_MEAN = [0.544, -0.39978, 0.025054, -6.714e-4]
_SMALL_LOG_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
_LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
_LARGE_LOG_SD = [-0.4803, -0.082676, 0.0030302]


def _poly(coefficients: Sequence[float], x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


def _w_and_p(
    n: int, size: float, tops: Sequence[float], cross: float, ends: Sequence[float], spread: float
) -> tuple[float | None, float | None]:
    """W and its p-value from sums over the ordered values.

    :param size: sum of the squared normal scores. :param tops: the largest and second largest score.
    :param cross: sum of score times value. :param ends: first, second, second last and last value.
    :param spread: sum of squared deviations from the mean.
    """
    if n < 3 or ends[0] == ends[3]:
        return None, None
    if n == 3:
        weighted = math.sqrt(0.5) * (ends[3] - ends[0])
    else:
        u = 1.0 / math.sqrt(n)
        last = tops[0] / math.sqrt(size) + _poly(_A_LAST, u)
        edge = [(last, tops[0], ends[3] - ends[0])]
        if n > 5:
            edge.append((tops[1] / math.sqrt(size) + _poly(_A_NEXT, u), tops[1], ends[2] - ends[1]))
        rest = size - 2 * sum(m * m for _, m, _ in edge)
        scale = math.sqrt(rest / (1 - 2 * sum(a * a for a, _, _ in edge)))
        middle = cross - sum(m * gap for _, m, gap in edge)
        weighted = middle / scale + sum(a * gap for a, _, gap in edge)
    w = min(1.0, weighted * weighted / spread)
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, max(0.0, p)
    if w >= 1.0:
        return w, 1.0
    y = math.log(1 - w)
    if n <= 11:
        gamma = _poly(_SMALL_GAMMA, n)
        if y >= gamma:
            return w, 0.0
        y, mean, sd = -math.log(gamma - y), _poly(_SMALL_MEAN, n), math.exp(_poly(_SMALL_LOG_SD, n))
    else:
        log_n = math.log(n)
        mean, sd = _poly(_LARGE_MEAN, log_n), math.exp(_poly(_LARGE_LOG_SD, log_n))
    return w, normal_upper((y - mean) / sd)


def shapiro_wilk(values: np.ndarray) -> tuple[float | None, float | None]:
    """W and its p-value of a few values held in memory; None for a constant or too short sample."""
    x = np.sort(np.asarray(values, dtype="float64"))
    n = len(x)
    if n < 3:
        return None, None
    inverse = NormalDist().inv_cdf
    m = np.array([inverse((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    centred = x - x.mean()
    ends = [x[0], x[1], x[-2], x[-1]]
    return _w_and_p(n, float(m @ m), [m[-1], m[-2]], float(m @ centred), ends, float(centred @ centred))


def normality(
    df: DataFrame,
    columns: Sequence[str],
    key_cols: Sequence[str] = (),
    sample_size: int | None = None,
    seed: int = 42,
    alpha: float = ALPHA,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """W test per feature on all known values, or on ``sample_size`` random ones if a size is given.

    Positions and normal scores are distributed; what meets is a row of sums per feature. The published p-value
    approximation was fitted for up to 5,000 values and is carried on beyond that.
    """
    long = melt(df, columns, key_cols)
    if sample_size is not None:
        long = sample_n(long, sample_size, key_cols, seed, by=["feature"])
    points = _positions(long.select("feature", "value"), group_rows)
    score = normal_quantile((F.col("position") - F.lit(0.375)) / (F.col("n") + F.lit(0.25)))
    scored = points.withColumn("m", score).withColumn("centred", F.col("value") - F.col("mean"))
    at = {"first": F.lit(1), "second": F.lit(2), "before_last": F.col("n") - 1, "last": F.col("n")}
    sums = scored.groupBy("feature").agg(
        F.max("n").alias("n"),
        F.sum(F.col("m") * F.col("m")).alias("squares"),
        F.max(F.when(F.col("position") == F.col("n"), F.col("m"))).alias("top"),
        F.max(F.when(F.col("position") == F.col("n") - 1, F.col("m"))).alias("next"),
        F.sum(F.col("m") * F.col("centred")).alias("cross"),
        F.sum(F.col("centred") * F.col("centred")).alias("spread"),
        *[F.max(F.when(F.col("position") == place, F.col("value"))).alias(name) for name, place in at.items()],
    )

    def test(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [
                _w_and_p(r.n, r.squares, [r.top, r.next], r.cross, [r.first, r.second, r.before_last, r.last], r.spread)
                for r in part.itertuples()
            ]
            yield pd.DataFrame(
                {
                    "feature": part["feature"],
                    "n": part["n"],
                    "statistic": pd.Series([w for w, _ in found], dtype="float64"),
                    "p_value": pd.Series([p for _, p in found], dtype="float64"),
                }
            )

    rows = sums.mapInPandas(test, "feature string, n long, statistic double, p_value double")
    unknown = F.col("p_value").isNull() | F.isnan("p_value")
    rows = rows.withColumns({c: F.when(~unknown, F.col(c)) for c in ("statistic", "p_value")})
    normal = F.col("p_value") > F.lit(alpha)
    unknown = F.col("p_value").isNull()
    return rows.withColumn("is_normal", F.when(~unknown, normal)).withColumn(
        "decision",
        F.when(unknown, F.lit("not testable"))
        .when(normal, F.lit("compatible with a normal distribution"))
        .otherwise(F.lit("not normally distributed")),
    )


# --- quantile-quantile data -------------------------------------------------------------------


def plotting_position(position: Column, n: Column) -> Column:
    """Medians of the uniform order statistics (Filliben's estimate)."""
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    inner = (position - F.lit(0.3175)) / (n + F.lit(0.365))
    return F.when(position == n, top).when(position == 1, F.lit(1.0) - top).otherwise(inner)


def _positions(long: DataFrame, group_rows: int) -> DataFrame:
    """``(feature, position, value, n, mean)`` of every value. Runs of equal values are cut into blocks, so that a
    hot value is shared by many tasks."""
    positions = value_positions(long, group_rows=group_rows)
    mean = F.sum(F.col("value") * F.col("total")) / F.sum("total")
    sizes = positions.groupBy("feature").agg(F.sum("total").alias("n"), mean.alias("mean"))
    return (
        positions.join(sizes, "feature")
        .withColumn(
            "first",
            F.explode(
                F.sequence(
                    F.col("before") + 1, F.col("before") + F.col("total"), F.lit(_BLOCK).cast("long")
                )
            ),
        )
        .withColumn("last", F.least(F.col("first") + _BLOCK - 1, F.col("before") + F.col("total")))
        .select("feature", "value", "n", "mean", "first", "last")
        .repartition("feature", "first")
        .select("feature", "value", "n", "mean", F.explode(F.sequence("first", "last")).alias("position"))
    )


def qq_points(df: DataFrame, columns: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(feature, position, theoretical, value)`` of every known value."""
    return (
        _positions(melt(df, columns), group_rows)
        .select(
            "feature",
            "position",
            normal_quantile(plotting_position(F.col("position"), F.col("n"))).alias("theoretical"),
            "value",
        )
    )


def qq_fit(df: DataFrame, columns: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Least-squares line of value on theoretical quantile, and its correlation, per feature."""
    points = qq_points(df, columns, group_rows)
    return points.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("value", "theoretical").alias("slope"),
        F.regr_intercept("value", "theoretical").alias("intercept"),
        F.try_divide(
            F.covar_pop("value", "theoretical"), F.stddev_pop("value") * F.stddev_pop("theoretical")
        ).alias("r"),
    )
