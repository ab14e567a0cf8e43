"""Parametric and rank-based tests of every numeric feature against a label, in one job per test.

The table is reduced to moments per (label, feature) or to rank sums per (feature, label); a statistic
is arithmetic on that handful of rows, and only there does a p-value function run. A feature whose
statistic is undefined keeps its row with null statistic and the decision ``not testable``; a feature
with fewer than two groups gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import as_double, melt, numeric_columns, require_columns, wide_to_long
from tarmac.functions.special import (
    chi2_upper_p,
    f_upper_p,
    normal_upper_p,
    t_two_sided_p,
)
from tarmac.operators.quantiles import column_quantiles
from tarmac.operators.ranks import rank_sums
from tarmac.session import materialize, parameter_table

ALPHA = 0.05
NOT_TESTABLE = "not testable"


def feature_list(
    df: DataFrame, label: str, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> list[str]:
    require_columns(df, [label])
    if columns is not None:
        require_columns(df, columns)
        return list(columns)
    return numeric_columns(df, exclude=[label, *keys])


def decide(df: DataFrame, reject: str, keep: str = "nothing shown", alpha: float = ALPHA) -> DataFrame:
    """Significance flag and verdict from ``p_value``."""
    significant = F.col("p_value") < F.lit(alpha)
    return df.withColumn("significant", significant).withColumn(
        "decision",
        F.when(F.col("p_value").isNull() | F.isnan("p_value"), F.lit(NOT_TESTABLE))
        .when(significant, F.lit(reject))
        .otherwise(F.lit(keep)),
    )


# --- moments ----------------------------------------------------------------------------------


def group_moments(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``(label, feature, n, mean, var)`` of every non-empty group, all features in one aggregate."""
    work = as_double(df.where(F.col(label).isNotNull()), columns, [label])
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.avg(c).alias(f"m{i}"),
            F.var_samp(c).alias(f"v{i}"),
        ]
    return wide_to_long(
        work.groupBy(F.col(label).cast("string").alias("label")).agg(*aggregates),
        ["label"],
        {
            c: {"n": F.col(f"n{i}"), "mean": F.col(f"m{i}"), "var": F.col(f"v{i}")}
            for i, c in enumerate(columns)
        },
    ).where(F.col("n") > 0)


def _t_columns(equal_var: bool) -> tuple[Column, Column]:
    """t and its degrees of freedom from na, ma, va, nb, mb, vb."""
    na, nb = F.col("na").cast("double"), F.col("nb").cast("double")
    va, vb = F.col("va"), F.col("vb")
    gap = F.col("ma") - F.col("mb")
    if equal_var:
        df = na + nb - 2
        pooled = F.try_divide(
            F.coalesce((na - 1) * va, F.lit(0.0)) + F.coalesce((nb - 1) * vb, F.lit(0.0)), df
        )
        return F.try_divide(gap, F.sqrt(pooled * (1 / na + 1 / nb))), df
    qa, qb = va / na, vb / nb
    df = F.try_divide((qa + qb) * (qa + qb), qa * qa / (na - 1) + qb * qb / (nb - 1))
    return F.try_divide(gap, F.sqrt(qa + qb)), df


def _enough_for_t(equal_var: bool) -> Column:
    if equal_var:
        return F.col("na") + F.col("nb") > 2
    return (F.col("na") > 1) & (F.col("nb") > 1)


def pairwise_t(
    df: DataFrame,
    label: str,
    columns: Sequence[str] | None = None,
    equal_var: bool = False,
    alpha: float = ALPHA,
    moments: DataFrame | None = None,
) -> DataFrame:
    """t test between every pair of labels (A before B) for every feature; Welch by default.

    ``moments`` passes on a fixed ``group_moments`` table of the same data.
    """
    if moments is None:
        moments = parameter_table(group_moments(df, feature_list(df, label, columns), label))
    a = moments.select(
        "feature", F.col("label").alias("group_a"), F.col("n").alias("na"),
        F.col("mean").alias("ma"), F.col("var").alias("va"),
    )
    b = moments.select(
        "feature", F.col("label").alias("group_b"), F.col("n").alias("nb"),
        F.col("mean").alias("mb"), F.col("var").alias("vb"),
    )
    ok = _enough_for_t(equal_var)
    pairs = a.join(b, "feature").where(F.col("group_a") < F.col("group_b"))
    # groups of one row have no variance; their terms must not be divided
    pairs = pairs.withColumn("ok", ok)
    safe = pairs.where("ok")
    t, dof = _t_columns(equal_var)
    tested = safe.select("feature", "group_a", "group_b", t.alias("statistic"), dof.alias("df"))
    skipped = pairs.where(~F.col("ok")).select(
        "feature",
        "group_a",
        "group_b",
        F.lit(None).cast("double").alias("statistic"),
        F.lit(None).cast("double").alias("df"),
    )
    rows = tested.unionByName(skipped).withColumn("p_value", t_two_sided_p("statistic", "df"))
    out = decide(rows, "reject", "keep", alpha)
    verdict = F.when(F.col("decision") == NOT_TESTABLE, F.lit(NOT_TESTABLE)).when(
        F.col("significant"),
        F.concat(F.lit("unequal means: "), "group_a", F.lit(", "), "group_b"),
    ).otherwise(
        F.concat(F.lit("no unequal means shown: "), "group_a", F.lit(", "), "group_b")
    )
    return out.withColumn("decision", verdict)


def t_test(
    df: DataFrame, value: str, label: str, group_a: object, group_b: object, equal_var: bool = False
) -> DataFrame:
    """Two independent samples, the sign following mean(A) - mean(B)."""
    labels = F.col(label)
    chosen = df.where(labels.isin(group_a, group_b)).withColumn(
        "__side", F.when(labels == F.lit(group_a), F.lit("a")).otherwise(F.lit("b"))
    )
    out = pairwise_t(chosen, "__side", [value], equal_var)
    return out.select("feature", "statistic", "df", "p_value", "significant")


def _anova_rows(moments: DataFrame) -> DataFrame:
    """F statistic per feature from group moments."""
    per_feature = Window.partitionBy("feature")
    n = F.col("n").cast("double")
    with_grand = moments.withColumn(
        "grand", F.sum(n * F.col("mean")).over(per_feature) / F.sum(n).over(per_feature)
    )
    gap = F.col("mean") - F.col("grand")
    sums = with_grand.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(n).alias("total"),
        F.sum(n * gap * gap).alias("between"),
        F.sum(F.coalesce((n - 1) * F.col("var"), F.lit(0.0))).alias("within"),
    )
    df1 = (F.col("k") - 1).cast("double")
    df2 = F.col("total") - F.col("k")
    msw = F.when(F.col("within") > 0, F.try_divide(F.col("within"), df2))
    return sums.where(F.col("k") > 1).select(
        "feature",
        F.try_divide(F.col("between") / df1, msw).alias("statistic"),
        df1.alias("df1"),
        df2.alias("df2"),
    )


def anova(
    df: DataFrame,
    label: str,
    columns: Sequence[str] | None = None,
    alpha: float = ALPHA,
    moments: DataFrame | None = None,
) -> DataFrame:
    """One-way analysis of variance per feature; ``moments`` as in ``pairwise_t``."""
    if moments is None:
        moments = parameter_table(group_moments(df, feature_list(df, label, columns), label))
    return _finish_f(_anova_rows(moments), "group means are unequal", alpha)


def _finish_f(rows: DataFrame, reject: str, alpha: float) -> DataFrame:
    return decide(rows.withColumn("p_value", f_upper_p("statistic", "df1", "df2")), reject, alpha=alpha)


def levene(
    df: DataFrame, label: str, columns: Sequence[str] | None = None, alpha: float = ALPHA
) -> DataFrame:
    """Equality of variances: analysis of variance of the distances to the group medians."""
    columns = feature_list(df, label, columns)
    known = df.where(F.col(label).isNotNull())
    medians = column_quantiles(known, columns, [0.5], [label])
    centre = F.col("quantiles")[0]
    wide = parameter_table(
        medians.groupBy(F.col(label).alias("__label")).agg(
            *[F.max(F.when(F.col("feature") == c, centre)).alias(f"__m{i}") for i, c in enumerate(columns)]
        )
    )
    distances = as_double(known, columns, [label]).join(wide, F.col(label) == F.col("__label"))
    distances = distances.select(
        label, *[F.abs(F.col(c) - F.col(f"__m{i}")).alias(c) for i, c in enumerate(columns)]
    )
    moments = parameter_table(group_moments(distances, columns, label))
    return _finish_f(_anova_rows(moments), "group variances are unequal", alpha)


def paired_t(df: DataFrame, first: str, second: str, alpha: float = ALPHA) -> DataFrame:
    """t test of the row-wise difference; rows missing either value are left out."""
    gap = F.col(first).cast("double") - F.col(second).cast("double")
    sums = df.agg(
        F.count(gap).alias("n"), F.avg(gap).alias("mean"), F.stddev_samp(gap).alias("sd")
    )
    n = F.col("n").cast("double")
    rows = sums.select(
        F.try_divide(F.col("mean"), F.col("sd") / F.sqrt(F.greatest(n, F.lit(1.0)))).alias("statistic"),
        (n - 1).alias("df"),
    ).withColumn("p_value", t_two_sided_p("statistic", "df"))
    return decide(rows, "group means are unequal", alpha=alpha)


# --- ranks ------------------------------------------------------------------------------------


def _labelled(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    known = df.where(F.col(label).isNotNull()).withColumn("__label", F.col(label).cast("string"))
    return melt(known, columns, ["__label"]).withColumnRenamed("__label", "label")


def kruskal_wallis(
    df: DataFrame, label: str, columns: Sequence[str] | None = None, alpha: float = ALPHA
) -> DataFrame:
    """Rank-based comparison of all groups of a label, tie-corrected."""
    sums = rank_sums(_labelled(df, feature_list(df, label, columns), label))
    per = sums.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("s"),
        F.max("n_total").cast("double").alias("n"),
        F.max("tie_sum").alias("tie_sum"),
    )
    n = F.col("n")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    correction = 1 - F.col("tie_sum") / (n * n * n - n)
    rows = (
        per.where(F.col("k") > 1)
        .select(
            "feature",
            F.try_divide(raw, F.when(correction > 0, correction)).alias("statistic"),
            (F.col("k") - 1).cast("double").alias("df"),
        )
        .withColumn("p_value", chi2_upper_p("statistic", "df"))
    )
    return decide(rows, "groups come from unequal distributions", alpha=alpha)


_SIDES = ("two-sided", "less", "greater")


def mann_whitney(
    df: DataFrame,
    value: str,
    label: str,
    group_a: object,
    group_b: object,
    alternative: str = "two-sided",
    alpha: float = ALPHA,
) -> DataFrame:
    """U of sample A against sample B with the tie-corrected normal approximation."""
    if alternative not in _SIDES:
        raise ValueError(f"alternative must be one of {_SIDES}")
    labels = F.col(label)
    sides = df.where(labels.isin(group_a, group_b)).withColumn(
        "label", F.when(labels == F.lit(group_a), F.lit("a")).otherwise(F.lit("b"))
    )
    sums = rank_sums(melt(sides, [value], ["label"]))
    per = sums.groupBy("feature").agg(
        F.max(F.when(F.col("label") == "a", F.col("n"))).cast("double").alias("na"),
        F.max(F.when(F.col("label") == "b", F.col("n"))).cast("double").alias("nb"),
        F.max(F.when(F.col("label") == "a", F.col("rank_sum"))).alias("ra"),
        F.max("tie_sum").alias("tie_sum"),
    )
    na, nb = F.col("na"), F.col("nb")
    n = na + nb
    u = F.col("ra") - na * (na + 1) / 2
    spread = F.sqrt(na * nb / 12 * (n + 1 - F.col("tie_sum") / (n * (n - 1))))
    rows = per.where(na.isNotNull() & nb.isNotNull()).select(
        "feature", u.alias("statistic"), (u - na * nb / 2).alias("gap"), spread.alias("sd")
    )
    if alternative == "two-sided":
        top = F.abs("gap") - 0.5
    elif alternative == "greater":
        top = F.col("gap") - 0.5
    else:
        top = -F.col("gap") - 0.5
    rows = rows.withColumn("z", F.try_divide(top, F.col("sd")))
    p = normal_upper_p("z")
    p = F.least(F.lit(1.0), 2 * p) if alternative == "two-sided" else p
    rows = rows.select("feature", "statistic", "z", p.alias("p_value"), F.lit("asymptotic").alias("method"))
    return decide(rows, "groups come from unequal distributions", alpha=alpha)


def rank_sum(df, value, label, group_a, group_b, alternative="two-sided", alpha=ALPHA) -> DataFrame:
    """Another name of the Mann-Whitney test."""
    return mann_whitney(df, value, label, group_a, group_b, alternative, alpha)


def wilcoxon_signed_rank(
    df: DataFrame, first: str, second: str, alternative: str = "two-sided", alpha: float = ALPHA
) -> DataFrame:
    """Signed ranks of the non-zero row-wise differences, tie-corrected normal approximation."""
    if alternative not in _SIDES:
        raise ValueError(f"alternative must be one of {_SIDES}")
    gap = F.col(first).cast("double") - F.col(second).cast("double")
    signed = (
        df.select(gap.alias("d"))
        .where(F.col("d").isNotNull() & (F.col("d") != 0))
        .select(
            F.lit("difference").alias("feature"),
            F.abs("d").alias("value"),
            F.when(F.col("d") > 0, F.lit("plus")).otherwise(F.lit("minus")).alias("label"),
        )
    )
    per = rank_sums(signed).groupBy("feature").agg(
        F.coalesce(F.max(F.when(F.col("label") == "plus", F.col("rank_sum"))), F.lit(0.0)).alias("plus"),
        F.coalesce(F.max(F.when(F.col("label") == "minus", F.col("rank_sum"))), F.lit(0.0)).alias("minus"),
        F.max("n_total").cast("double").alias("n"),
        F.max("tie_sum").alias("tie_sum"),
    )
    n = F.col("n")
    mean = n * (n + 1) / 4
    spread = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("tie_sum") / 48)
    z = F.try_divide(F.col("plus") - mean, spread)
    if alternative == "two-sided":
        statistic, p = F.least("plus", "minus"), 2 * normal_upper_p(F.abs(F.col("z")))
    elif alternative == "greater":
        statistic, p = F.col("plus"), normal_upper_p(F.col("z"))
    else:
        statistic, p = F.col("plus"), normal_upper_p(-F.col("z"))
    rows = per.select(statistic.alias("statistic"), z.alias("z")).select(
        "statistic", "z", p.alias("p_value"), F.lit("asymptotic").alias("method")
    )
    return decide(rows, "differences are not centred on zero", alpha=alpha)


def friedman(df: DataFrame, columns: Sequence[str], alpha: float = ALPHA) -> DataFrame:
    """Related samples held in the columns of a row: ranks are taken inside each row, no shuffle."""
    if len(columns) < 3:
        raise ValueError("the test needs at least three related columns")
    work = as_double(df, columns).na.drop()
    k = len(columns)
    cols = [F.col(c) for c in columns]

    def count_of(conditions: list[Column]) -> Column:
        total = F.lit(0)
        for condition in conditions:
            total = total + F.when(condition, 1).otherwise(0)
        return total

    aggregates, ties = [F.count(F.lit(1)).cast("double").alias("n")], F.lit(0)
    for i, c in enumerate(cols):
        equal = count_of([c == other for other in cols])
        below = count_of([other < c for other in cols])
        aggregates.append(F.sum(below + (equal + 1) / F.lit(2.0)).alias(f"r{i}"))
        # t^3 - t of a tie of t columns, shared equally by its members
        ties = ties + (equal * equal - 1)
    aggregates.append(F.sum(ties.cast("double")).alias("tie_sum"))
    sums = work.agg(*aggregates)
    squares = sum((F.col(f"r{i}") * F.col(f"r{i}") for i in range(k)), F.lit(0.0))
    n = F.col("n")
    raw = F.try_divide(F.lit(12.0) * squares, n * k * (k + 1)) - 3 * n * (k + 1)
    correction = 1 - F.try_divide(F.col("tie_sum"), n * k * (k * k - 1))
    rows = sums.select(
        F.try_divide(raw, F.when(correction > 0, correction)).alias("statistic"),
        F.lit(float(k - 1)).alias("df"),
    ).withColumn("p_value", chi2_upper_p("statistic", "df"))
    return decide(rows, "groups come from unequal distributions", alpha=alpha)


# --- named tests and the battery --------------------------------------------------------------


def _named(result: DataFrame, hypothesis: str, reject: str, keep: str) -> DataFrame:
    verdict = (
        F.when(F.col("decision") == NOT_TESTABLE, F.lit(NOT_TESTABLE))
        .when(F.col("significant"), F.lit(reject))
        .otherwise(F.lit(keep))
    )
    return result.select(
        F.lit("Kruskal-Wallis").alias("test"),
        F.lit(hypothesis).alias("hypothesis"),
        "statistic",
        "df",
        "p_value",
        "significant",
        verdict.alias("decision"),
    )


def airline_delay_test(
    df: DataFrame, airline: str = "AIRLINE", delay: str = "ARR_DELAY", alpha: float = ALPHA
) -> DataFrame:
    """Do some airlines run systematically later than others?"""
    require_columns(df, [airline, delay])
    return _named(
        kruskal_wallis(df, airline, [delay], alpha),
        "delay by airline",
        "delay depends on the airline",
        "no dependence of delay on the airline shown",
    )


def time_of_day_test(
    df: DataFrame, period: str = "TIME_PERIOD", delay: str = "DEP_DELAY", alpha: float = ALPHA
) -> DataFrame:
    """Does the time of day affect delays? No rows when a column is absent."""
    if period not in df.columns or delay not in df.columns:
        df = df.sparkSession.createDataFrame([], f"`{period}` string, `{delay}` double")
    return _named(
        kruskal_wallis(df, period, [delay], alpha),
        "delay by time of day",
        "delay depends on the time of day",
        "no dependence of delay on the time of day shown",
    )


def run_battery(
    df: DataFrame,
    label: str,
    key_cols: Sequence[str],
    columns: Sequence[str] | None = None,
    include_pairwise: bool = True,
    sample_size: int | None = None,
    alpha: float = ALPHA,
) -> dict[str, DataFrame]:
    """Normality, equal variances, means, distributions and pairwise means of every feature.

    The columns in use are written once, since each test reads them several times, and the tests of
    means share one table of moments.
    """
    from tarmac.operators.normality import normality

    columns = feature_list(df, label, columns, key_cols)
    df = materialize(df.select(*dict.fromkeys([*key_cols, label, *columns])))
    moments = parameter_table(group_moments(df, columns, label))
    report = {
        "normality": normality(df, columns, key_cols, sample_size, alpha=alpha),
        "levene": levene(df, label, columns, alpha),
        "anova": anova(df, label, columns, alpha, moments),
        "kruskal_wallis": kruskal_wallis(df, label, columns, alpha),
    }
    if include_pairwise and moments.select("label").distinct().count() > 1:
        report["t_tests"] = pairwise_t(df, label, columns, alpha=alpha, moments=moments)
    return report


def battery_summary(report: dict[str, DataFrame]) -> DataFrame:
    """All tables of a battery stacked: ``(test, feature, groups, statistic, p_value, decision)``."""
    out = None
    for name, table in report.items():
        groups = (
            F.concat_ws(" / ", "group_a", "group_b") if "group_a" in table.columns else F.lit("all")
        )
        part = table.select(
            F.lit(name).alias("test"),
            "feature",
            groups.alias("groups"),
            "statistic",
            "p_value",
            "decision",
        )
        out = part if out is None else out.unionByName(part)
    return out
