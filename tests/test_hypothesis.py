import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.functions import special
from tarmac.functions.columns import melt
from tarmac.operators import hypothesis as h
from tarmac.operators import normality
from tarmac.operators.ranks import rank_sums


def groups(spark, **values):
    rows = [(g, float(v) if v is not None else None) for g, vs in values.items() for v in vs]
    return spark.createDataFrame(rows, "g string, x double")


def test_tail_probabilities_against_a_second_library(spark):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    for df in (1.0, 2.5, 7.0, 40.0, 5000.0):
        t = jvm.TDistribution(df)
        for x in (0.0, 0.3, 1.9, 6.0):
            assert special.t_two_sided(x, df) == pytest.approx(2 * (1 - t.cumulativeProbability(x)), abs=1e-10)
        c = jvm.ChiSquaredDistribution(df)
        for x in (0.1, 3.0, df, 3 * df):
            assert special.chi2_upper(x, df) == pytest.approx(1 - c.cumulativeProbability(x), abs=1e-10)
        for d2 in (3.0, 50.0, 20000.0):
            f = jvm.FDistribution(df, d2)
            for x in (0.2, 1.0, 4.0):
                assert special.f_upper(x, df, d2) == pytest.approx(1 - f.cumulativeProbability(x), abs=1e-9)


def test_far_tails_do_not_vanish():
    assert special.chi2_upper(200.0, 2) == pytest.approx(math.exp(-100), rel=1e-9)
    assert special.normal_upper(10.0) == pytest.approx(7.619853024160527e-24, rel=1e-9)


def test_normal_quantile(spark):
    ps = [1e-300, 1e-12, 0.001, 0.075, 0.3, 0.5, 0.8, 0.999, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = {r.p: r.q for r in df.select("p", special.normal_quantile(F.col("p")).alias("q")).collect()}
    for p in ps:
        assert got[p] == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)


def test_welch_known_answer(spark):
    # published example of two samples with unequal spread
    a = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
    b = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 30.5, 24.4]
    row = h.t_test(groups(spark, a=a, b=b), "x", "g", "a", "b").first()
    na, nb = np.array(a), np.array(b)
    va, vb = na.var(ddof=1) / 15, nb.var(ddof=1) / 15
    assert row.statistic == pytest.approx((na.mean() - nb.mean()) / math.sqrt(va + vb))
    assert row.df == pytest.approx((va + vb) ** 2 / (va**2 / 14 + vb**2 / 14))
    swapped = h.t_test(groups(spark, a=a, b=b), "x", "g", "b", "a").first()
    assert swapped.statistic == pytest.approx(-row.statistic) and swapped.p_value == pytest.approx(row.p_value)


def test_kruskal_with_ties_known_answer(spark):
    # 12 / (N (N + 1)) sum R^2/n - 3 (N + 1) by hand: ranks 1, 2.5, 2.5, 4 | 5, 6.5, 6.5, 8
    row = h.kruskal_wallis(groups(spark, a=[1, 2, 2, 3], b=[4, 5, 5, 6]), "g", ["x"]).first()
    raw = 12 / 72 * (10**2 / 4 + 26**2 / 4) - 27
    assert row.statistic == pytest.approx(raw / (1 - 12 / (8**3 - 8)))
    assert row.p_value == pytest.approx(special.chi2_upper(row.statistic, 1))


def test_mann_whitney_sides(spark):
    df = groups(spark, a=[1, 2, 3, 4, 5, 6], b=[4, 5, 6, 7, 8, 9])
    two = h.mann_whitney(df, "x", "g", "a", "b").first()
    less = h.mann_whitney(df, "x", "g", "a", "b", "less").first()
    more = h.mann_whitney(df, "x", "g", "a", "b", "greater").first()
    assert two.statistic == 4.5
    assert two.p_value == pytest.approx(2 * less.p_value) and more.p_value > 0.95
    with pytest.raises(ValueError):
        h.mann_whitney(df, "x", "g", "a", "b", "both")


def test_rank_sums_by_ranges_equal_plain(spark):
    rng = np.random.default_rng(1)
    rows = [("abc"[i % 3], float(v)) for i, v in enumerate(rng.normal(size=2000))]
    rows += [("a", 0.25)] * 900 + [("b", -0.0), ("c", 0.0)]
    df = spark.createDataFrame(rows, "label string, x double").repartition(5)
    long = melt(df, ["x"], ["label"])
    plain = sorted(map(tuple, rank_sums(long).collect()))
    tight = sorted(map(tuple, rank_sums(long, group_rows=50).collect()))
    assert len(plain) == 3
    for p, t in zip(plain, tight):
        assert p[:2] == t[:2] and p[2:] == pytest.approx(t[2:])


def test_rank_test_ignores_monotone_transform(spark):
    df = groups(spark, a=[1, 5, 9, 2], b=[3, 8, 7, 7], c=[4, 4, 6, 0])
    one = h.kruskal_wallis(df, "g", ["x"]).first().statistic
    two = h.kruskal_wallis(df.withColumn("x", F.exp("x")), "g", ["x"]).first().statistic
    assert one == pytest.approx(two)


def test_constant_empty_and_missing_groups(spark):
    rows = [("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 1.0, None), (None, 4.0, 9.0)]
    df = spark.createDataFrame(rows, "g string, flat double, one_group double")
    for test in (h.anova, h.kruskal_wallis, h.levene):
        got = {r.feature: r for r in test(df, "g").collect()}
        assert set(got) == {"flat"}  # fewer than two groups: no row
        assert got["flat"].statistic is None and got["flat"].decision == h.NOT_TESTABLE
    pairs = h.pairwise_t(df, "g").collect()
    assert [(r.feature, r.decision) for r in pairs] == [("flat", h.NOT_TESTABLE)]


def test_anova_known_answer(spark):
    a, b, c = [6, 8, 4, 5, 3, 4], [8, 12, 9, 11, 6, 8], [13, 9, 11, 8, 7, 12]
    row = h.anova(groups(spark, a=a, b=b, c=c), "g").first()
    assert (row.df1, row.df2) == (2.0, 15.0)
    assert row.statistic == pytest.approx(9.3, abs=0.05)  # textbook value 9.3
    assert row.p_value == pytest.approx(0.0024, abs=2e-4)


def test_friedman_known_answer(spark):
    rows = [(1.0, 2.0, 3.0), (2.0, 1.0, 3.0), (1.0, 2.0, 3.0), (1.0, 3.0, 2.0)]
    row = h.friedman(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).first()
    sums = [5, 8, 11]
    assert row.statistic == pytest.approx(12 / (4 * 3 * 4) * sum(s * s for s in sums) - 3 * 4 * 4)
    with pytest.raises(ValueError):
        h.friedman(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b"])


def test_wilcoxon_drops_zero_differences(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (3.0, 1.0), (5.0, 6.0), (9.0, 5.0), (None, 2.0)], "a double, b double"
    )
    row = h.wilcoxon_signed_rank(df, "a", "b").first()
    assert row.statistic == 1.0 and row.method == "asymptotic"


def test_named_tests_guard_their_columns(spark):
    df = groups(spark, a=[1], b=[2])
    with pytest.raises(ValueError):
        h.airline_delay_test(df)
    missing = h.time_of_day_test(df)
    assert missing.count() == 0 and "p_value" in missing.columns
    one = groups(spark, a=[1, 2, 3])
    assert h.time_of_day_test(one, "g", "x").count() == 0


def test_shapiro_published_example():
    # weights of eleven men, the example of the original paper: W = 0.79, p about 0.01
    w, p = normality.shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]))
    assert w == pytest.approx(0.79, abs=0.005) and p == pytest.approx(0.0067, abs=0.001)
    assert normality.shapiro_wilk(np.array([1.0, 1.0, 1.0])) == (None, None)
    assert normality.shapiro_wilk(np.array([1.0, 2.0])) == (None, None)
    w, p = normality.shapiro_wilk(np.array([1.0, 2.0, 3.0]))
    assert w == pytest.approx(1.0) and p == pytest.approx(1.0)


def test_qq_points_cut_a_hot_value_into_blocks(spark):
    df = spark.createDataFrame([(1.0,)] * 60_000 + [(float(i),) for i in range(2, 200)], "x double")
    points = normality.qq_points(df, ["x"])
    n = 60_000 + 198
    assert points.count() == n and points.select("position").distinct().count() == n
    top = points.orderBy(F.desc("position")).first()
    assert top.theoretical == pytest.approx(NormalDist().inv_cdf(0.5 ** (1 / n)))


def test_battery_tables(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "uvw"[i % 3], float(x), float(i % 3) + float(x)) for i, x in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "id long, cls string, a double, b double")
    report = h.run_battery(df, "cls", ["id"], ["a", "b"])
    assert list(report) == ["normality", "levene", "anova", "kruskal_wallis", "t_tests"]
    stacked = h.battery_summary(report)
    assert stacked.count() == 2 * 4 + 2 * 3
    assert stacked.where("test = 'anova' and feature = 'b'").first().decision == "group means are unequal"
    assert "t_tests" not in h.run_battery(df.where("cls = 'u'"), "cls", ["id"], ["a"])
    assert {r.feature for r in h.run_battery(df, "cls", ["id"])["anova"].collect()} == {"a", "b"}


def test_normality_uses_all_rows_unless_a_size_is_given(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.gamma(9.0, size=9000), 2)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, x double").repartition(5)
    row = normality.normality(df, ["x"], ["id"]).first()
    w, p = normality.shapiro_wilk(x)
    assert row.n == 9000 and row.statistic == pytest.approx(w, abs=1e-9) and row.p_value == pytest.approx(p, abs=1e-9)
    assert normality.normality(df, ["x"], ["id"], sample_size=6000).first().n == 6000
    for n in (2, 3, 4, 5, 7, 11, 12):
        few = normality.normality(df.where(f"id < {n}"), ["x"], ["id"]).first()
        w, p = normality.shapiro_wilk(x[:n])
        assert few.statistic is None if w is None else few.statistic == pytest.approx(w, abs=1e-9)
