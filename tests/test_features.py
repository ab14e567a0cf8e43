import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarmac.functions.expr import cut
from tarmac.operators import chartdata, encode, features, profile, reduce, scale


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 500.0, 500.01, 1500.0, 10000.0, 10001.0)], "d double")
    got = [r[0] for r in df.select(cut(F.col("d"), *features.DISTANCE_BINS)).collect()]
    assert got == [None, "Short", "Medium", "Medium", "Long", None]
    with pytest.raises(ValueError):
        cut(F.col("d"), [0, 1], ["a", "b"])


def test_clock_periods(spark):
    clocks = [0, 559, 600, 1159, 1200, 1759, 1800, 2400]
    df = spark.createDataFrame([(datetime.date(2023, 7, 1), c) for c in clocks], "FL_DATE date, CRS_DEP_TIME int")
    got = {r.CRS_DEP_TIME: (r.DEP_HOUR, r.TIME_PERIOD) for r in features.temporal_features(df).collect()}
    assert got == {
        0: (0, "Night"), 559: (5, "Night"), 600: (6, "Morning"), 1159: (11, "Morning"),
        1200: (12, "Afternoon"), 1759: (17, "Afternoon"), 1800: (18, "Night"), 2400: (24, "Night"),
    }
    row = features.temporal_features(df).first()  # a Saturday in July
    assert (row.DAY_OF_WEEK, row.IS_WEEKEND, row.IS_HOLIDAY_SEASON, row.QUARTER) == (5, 1, 1, 3)


def test_null_route_and_zero_duration(spark):
    df = spark.createDataFrame(
        [("A", "B", 100.0, 50.0), ("A", "B", 90.0, 0.0), (None, "B", 10.0, 5.0)],
        "ORIGIN string, DEST string, DISTANCE double, CRS_ELAPSED_TIME double",
    )
    got = {r.DISTANCE: r for r in features.route_features(df).collect()}
    assert got[100.0].ROUTE_FREQUENCY == 2 and got[100.0].PLANNED_SPEED_MPM == 2.0
    assert got[90.0].PLANNED_SPEED_MPM is None
    assert got[10.0].ROUTE is None and got[10.0].ROUTE_FREQUENCY is None


def test_one_hot_missing_unseen_and_limit(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    fitted = encode.fit_one_hot(train, ["c"])
    assert fitted == {"c": ["a", "b", "nan"]}
    new = spark.createDataFrame([("z",), ("a",)], "c string")
    rows = [tuple(r) for r in encode.apply_one_hot(new, fitted).collect()]
    assert rows == [(0, 0, 0), (1, 0, 0)]
    with pytest.raises(ValueError):
        encode.fit_one_hot(train, ["c"], max_categories=2)


def test_label_codes_small_and_by_ranges(spark):
    words = [f"w{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(w,) for w in reversed(words)] + [(None,)], "c string").repartition(4)
    for limit in (encode.DICTIONARY_ROWS, 25):
        codes = {r["value"]: r["code"] for r in encode.fit_labels(df, "c", limit).collect()}
        assert codes == {w: i for i, w in enumerate(words)}
    assert encode.label_encode(df, ["c"]).where("c is null").count() == 1
    assert encode.category_codes(df, "c", "k").agg(F.min("k")).first()[0] == -1


def test_scaling_constant_null_and_reuse(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    z, params = scale.scale(df, "standard", ["x", "c"])
    assert [tuple(r) for r in z.collect()] == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]
    mm, _ = scale.scale(df, "minmax", ["x", "c"])
    assert [tuple(r) for r in mm.collect()] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]
    new = spark.createDataFrame([(5.0, 6.0)], "x double, c double")
    assert tuple(scale.apply_scaler(new, params).first()) == (3.0, 1.0)
    with pytest.raises(ValueError):
        scale.scale(df, "log")


def test_scaler_keeps_targets(spark):
    df = spark.createDataFrame([(1.0, 9.0, 2), (2.0, 8.0, 1)], "x double, ARR_DELAY double, DELAY_CLASS int")
    out, _ = scale.scale(df)
    assert {r.ARR_DELAY for r in out.collect()} == {8.0, 9.0}


def test_describe_uses_sample_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")
    row = profile.describe(df, ["x"]).first()
    assert row["count"] == 4 and row["q25"] == 1.75
    assert row["std"] == pytest.approx(np.std([1, 2, 4, 9], ddof=1))


def test_constant_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.0, 5.0)], "a double, b double, c double")
    got = {(r.x, r.y): r for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "c"].r is None and got["b", "a"].n == 3
    assert got["a", "b"].r == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 8])[0, 1])


def test_wide_correlation_with_gaps_and_constants(spark, monkeypatch):
    monkeypatch.setattr(profile, "HELD_BYTES", 1)
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 43)) + 1e6
    x[:, 5] = 2 * x[:, 4] + 1
    x[draw.random(x.shape) < 0.1] = np.nan
    x[:, 42] = 7.25
    names = [f"c{i}" for i in range(43)]
    frame = pd.DataFrame(x, columns=names).astype(object).where(lambda f: f.notna(), None)
    frame["g"] = [str(i % 3) for i in range(300)]
    schema = ", ".join([f"{c} double" for c in names] + ["g string"])
    df = spark.createDataFrame(frame, schema).repartition(4)
    for by, part in [(None, frame)] + [("g", frame[frame.g == g]) for g in ("0", "1")]:
        got = profile.corr_pairs(df, names, by).toPandas()
        if by:
            got = got[got.g == part.g.iloc[0]]
        assert len(got) == 43 * 44 // 2
        numbers = part[names].astype(float)
        want, known = numbers.corr(), numbers.notna().astype(int)
        both = known.T @ known
        for r in got.itertuples():
            assert r.n == both.loc[r.x, r.y]
            if "c42" in (r.x, r.y):
                assert r.r is None or np.isnan(r.r)
            else:
                assert abs(r.r - want.loc[r.x, r.y]) < 1e-7


def test_component_count_does_not_depend_on_width(spark):
    draw = np.random.default_rng(4)
    for width in (5, 44):
        x = np.column_stack([draw.normal(size=(200, width)), np.full(200, 3.0)])
        names = [f"c{i}" for i in range(width + 1)]
        df = spark.createDataFrame(pd.DataFrame(x, columns=names))
        shares = [r.ratio for r in reduce.pca_variance(df, names).collect()]
        assert sum(s > 1e-9 for s in shares) == width


def test_histogram_last_bin_holds_the_maximum(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)], "x double")
    got = {r.bin: r.n for r in chartdata.histogram(df, ["x"], 5).collect()}
    assert got == {0: 2, 1: 1, 2: 0, 3: 0, 4: 1}
    flat = chartdata.histogram(df.withColumn("x", F.lit(3.0)), ["x"], 4)
    assert sum(r.n for r in flat.collect()) == 4


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=500)], "x double")
    for bins in (None, 4096):
        points = chartdata.kde(df, ["x"], ridge=True, bins=bins).orderBy("grid_point").toPandas()
        area = np.trapezoid(points["density"], points["x"])
        assert area == pytest.approx(1.0, abs=0.01)


def test_bootstrap_band_surrounds_the_line(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 10, 400)
    rows = [(i, float(a), float(2 * a + 1 + e)) for i, (a, e) in enumerate(zip(x, rng.normal(size=400)))]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    one = chartdata.linear_fit_ci(df, "x", "y", ["id"], 300, 20).orderBy("grid_point").toPandas()
    two = chartdata.linear_fit_ci(df.repartition(7), "x", "y", ["id"], 300, 20).orderBy("grid_point").toPandas()
    assert ((one["low"] < one["fit"]) & (one["fit"] < one["high"])).all()
    assert np.allclose(one, two)
    width = (one["high"] - one["low"])
    assert 0.1 < width.min() < 0.3 < width.max() < 0.6  # about four standard errors


def test_pca_against_eigenvectors(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4))
    rows = [(i, *map(float, r)) for i, r in enumerate(data)] + [(999, 1.0, None, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double")
    got = reduce.pca(df, list("abcd"), ["id"]).orderBy("id").toPandas()
    z = (data - data.mean(0)) / data.std(0)
    values, axes = np.linalg.eigh(np.cov(z.T))
    axes = axes[:, ::-1][:, :2]
    assert len(got) == 120
    for j in range(2):
        want = z @ axes[:, j]
        assert np.allclose(np.abs(got[f"pc{j + 1}"]), np.abs(want))
    ratios = reduce.pca_variance(df, list("abcd")).orderBy("component").toPandas()
    assert np.allclose(ratios["ratio"], values[::-1] / values.sum())
    assert ratios["selected"].sum() == int((np.cumsum(ratios["ratio"]) < 0.8).sum()) + 1
    with pytest.raises(ValueError):
        reduce.pca(df, list("abcd"), ["id"], k=1)


def test_one_hot_vectors_of_any_width(spark):
    rows = [(i, f"v{i % 1500:04d}", None if i % 7 == 0 else "ab"[i % 2]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, wide string, narrow string")
    with pytest.raises(ValueError, match=r"\['wide'\]"):
        encode.fit_one_hot(df, ["narrow", "wide"])
    fitted = encode.fit_one_hot_vectors(df, ["wide", "narrow"])
    got = {r.id: r for r in encode.apply_one_hot_vectors(df, fitted).collect()}
    for i, wide, narrow in rows:
        assert got[i].wide_vector.size == 1500 and got[i].wide_vector.indices.tolist() == [int(wide[1:])]
        assert got[i].narrow_vector.indices.tolist() == [{"a": 0, "b": 1, None: 2}[narrow]]
    unseen = spark.createDataFrame([(1, "new", "a")], df.schema)
    assert encode.apply_one_hot_vectors(unseen, fitted).first().wide_vector.indices.tolist() == []
