"""Density by kernel expansions against the sum of all kernels."""

import math

import numpy as np
import pytest

from tarmac.operators import chartdata


def direct(values, at, h):
    z = (at[:, None] - values[None, :]) / h
    return np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))


def values(kind):
    rng = np.random.default_rng(9)
    if kind == "normal":
        return rng.normal(5, 2, 3000)
    if kind == "heavy tails":
        return np.concatenate([rng.standard_cauchy(2000) * 10, [-1e6, 1e6]])
    if kind == "one value":  # a third of all rows are the same value
        return np.concatenate([np.full(1000, 3.25), rng.uniform(0, 10, 2000)])
    return np.repeat([0.0, 1.0, 1000.0], [1, 1, 1])


@pytest.mark.parametrize("ridge", [False, True])
@pytest.mark.parametrize("kind", ["normal", "heavy tails", "one value", "few"])
def test_equals_the_sum_of_kernels(spark, kind, ridge):
    x = values(kind)
    rows = [(float(v),) for v in x] + [(None,)] * 5
    df = spark.createDataFrame(rows, "x double").repartition(5)
    for tolerance in (1e-13, 1e-4):
        got = chartdata.kde(df, ["x"], ridge=ridge, tolerance=tolerance).orderBy("grid_point").toPandas()
        h = len(x) ** -0.2 * x.std(ddof=1)
        assert len(got) == 200 and got["bandwidth"].to_numpy() == pytest.approx(h)
        margin = 3 * h if ridge else 0
        assert got["x"].to_numpy() == pytest.approx(np.linspace(x.min() - margin, x.max() + margin, 200))
        most = tolerance / (h * math.sqrt(2 * math.pi))
        assert np.abs(got["density"].to_numpy() - direct(x, got["x"].to_numpy(), h)).max() <= most + 1e-15 / h
        assert (got["density"] >= 0).all()


def test_groups_and_constant_columns(spark):
    rows = [(g, float(i * (1 + g)), 7.0) for g in range(3) for i in range(50)] + [(None, 1.0, 7.0), (5, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    got = chartdata.kde(df, ["x", "y"], by="g").toPandas()
    assert set(zip(got["g"], got["feature"])) == {(0, "x"), (1, "x"), (2, "x")} and len(got) == 600
    x = np.arange(50) * 2.0
    one = got[got["g"] == 1].sort_values("grid_point")
    assert one["density"].to_numpy() == pytest.approx(direct(x, one["x"].to_numpy(), 50**-0.2 * x.std(ddof=1)))


def test_rows_between_tasks_do_not_grow_with_distinct_values(spark):
    from pyspark.sql import functions as F

    cells = {}
    for n in (2000, 64_000):
        df = spark.createDataFrame([(float(v),) for v in np.random.default_rng(1).uniform(0, 1, n)], "value double")
        shape = {"low": 0.0, "high": 1.0, "bandwidth": 0.05}
        long = df.select(F.lit("x").alias("feature"), "value", *[F.lit(v).alias(c) for c, v in shape.items()])
        cells[n] = chartdata._cell_sums(long, ["feature"], None, 5).count()
    assert cells == {2000: 20, 64_000: 20}


def test_terms_keep_the_bound():
    for tolerance in (1e-3, 1e-8, 1e-13):
        terms = chartdata.expansion_terms(tolerance)
        t, s = np.meshgrid(np.linspace(-0.5, 0.5, 41) / math.sqrt(2), np.linspace(-7, 7, 141))
        now, before, total = np.ones_like(s), np.zeros_like(s), np.zeros_like(s)
        for m in range(terms):
            total += t**m / math.factorial(m) * now
            now, before = 2 * s * now - 2 * m * before, now
        assert np.abs(total * np.exp(-s * s) - np.exp(-((s - t) ** 2))).max() <= tolerance + 1e-15
