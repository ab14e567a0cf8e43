"""Hypothesis tests. Their SQL computes statistics from row-level ranks and plain moments, and p-values
by numerical integration of the densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.contract.tables import (
    EVENTS,
    FLIGHTS,
    LABELLED,
    PRICES,
    events,
    flights,
    labelled_flights,
    long_sql,
    prices,
    rounded_table,
    sql_chi2_p,
    sql_f_p,
    sql_normal_quantile,
    sql_normal_upper,
    sql_t_p,
    sr,
    table,
)
from tarmac.operators import hypothesis, normality
from tarmac.operators.features import temporal_features
from tarmac.plans.flights import valid_flights

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _decided(reject: str, keep: str = "nothing shown") -> str:
    return (
        f"p_value < 0.05 AS significant, CASE WHEN p_value IS NULL THEN 'not testable' "
        f"WHEN p_value < 0.05 THEN '{reject}' ELSE '{keep}' END AS decision"
    )


_COLS = ["value", "wave", "flat"]
_SRC = EVENTS + ",\nsrc AS (SELECT event_id, event_type, value, wave, 3::DOUBLE AS flat FROM ev)"
_LONG = _SRC + f",\nlong AS ({long_sql('src', _COLS, 'event_type AS label')})"


def _input(spark, d):
    return events(spark, d).select("event_id", "event_type", "value", "wave", F.lit(3.0).alias("flat"))


# --- t tests ----------------------------------------------------------------------------------

_MOMENTS = """mo AS (SELECT feature, label, count(*)::DOUBLE AS n, avg(value) AS m, var_samp(value) AS v
  FROM long GROUP BY feature, label)"""


def _t_sql(equal_var: bool, where: str) -> str:
    if equal_var:
        t = "(a.m - b.m) / sqrt(nullif(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1 / a.n + 1 / b.n), 0))"
        dof = "a.n + b.n - 2"
    else:
        t = "(a.m - b.m) / sqrt(nullif(a.v / a.n + b.v / b.n, 0))"
        dof = (
            "pow(a.v / a.n + b.v / b.n, 2) / nullif(pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1), 0)"
        )
    return f"""tt AS (SELECT a.feature, a.label AS group_a, b.label AS group_b, {t} AS t, {dof} AS dof
  FROM mo a JOIN mo b ON a.feature = b.feature AND a.label < b.label {where}),
tp AS (SELECT *, CASE WHEN t IS NOT NULL THEN {sql_t_p('tt.t', 'tt.dof')} END AS p_value FROM tt)"""


def _pairwise_sql(long: str) -> str:
    return f"""WITH {long}, {_MOMENTS}, {_t_sql(False, '')}
SELECT feature, group_a, group_b, {sr('t')} AS statistic, {sr('dof', 4)} AS df, {sr('p_value')} AS p_value,
  p_value < 0.05 AS significant, CASE WHEN p_value IS NULL THEN 'not testable'
  WHEN p_value < 0.05 THEN 'unequal means: ' || group_a || ', ' || group_b
  ELSE 'no unequal means shown: ' || group_a || ', ' || group_b END AS decision FROM tp"""


@query("pairwise_t", _pairwise_sql(_LONG))
def _(spark, d):
    out = hypothesis.pairwise_t(_input(spark, d), "event_type", _COLS)
    return rounded_table(out.withColumn("df", F.round("df", 4)))


def _one_t(equal_var: bool) -> str:
    return f"""WITH {PRICES}, long AS (SELECT 'price' AS feature, l_returnflag AS label, price AS value FROM pr
  WHERE price IS NOT NULL AND l_returnflag IN ('A', 'R')), {_MOMENTS}, {_t_sql(equal_var, '')}
SELECT feature, {sr('t')} AS statistic, {sr('dof', 4)} AS df, {sr('p_value')} AS p_value,
  p_value < 0.05 AS significant FROM tp"""


@query("t_test_welch", _one_t(False))
def _(spark, d):
    out = hypothesis.t_test(prices(spark, d), "price", "l_returnflag", "A", "R")
    return rounded_table(out.withColumn("df", F.round("df", 4)))


@query("t_test_student", _one_t(True))
def _(spark, d):
    out = hypothesis.t_test(prices(spark, d), "price", "l_returnflag", "A", "R", equal_var=True)
    return rounded_table(out.withColumn("df", F.round("df", 4)))


@query(
    "paired_t",
    f"""WITH g AS (SELECT l_discount * 0.8::DOUBLE - l_tax AS x FROM lineitem),
s AS (SELECT avg(x) / (stddev_samp(x) / sqrt(count(x))) AS t, count(x)::DOUBLE - 1 AS dof FROM g),
p AS (SELECT *, {sql_t_p('s.t', 's.dof')} AS p_value FROM s)
SELECT {sr('t')} AS statistic, dof AS df, {sr('p_value')} AS p_value, {_decided('group means are unequal')} FROM p""",
)
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("scaled", F.col("l_discount") * F.lit(0.8))
    return rounded_table(hypothesis.paired_t(li, "scaled", "l_tax"))


# --- F tests ----------------------------------------------------------------------------------


def _f_sql(source: str, reject: str) -> str:
    return f"""gm AS (SELECT feature, avg(value) AS g, count(*)::DOUBLE AS total FROM {source} GROUP BY feature),
gr AS (SELECT feature, label, count(*)::DOUBLE AS n, avg(value) AS m, var_samp(value) AS v FROM {source} GROUP BY feature, label),
fs AS (SELECT feature, count(*)::DOUBLE - 1 AS df1, any_value(total) - count(*) AS df2,
  sum(n * (m - g) * (m - g)) AS ssb, sum(coalesce((n - 1) * v, 0)) AS ssw
  FROM gr JOIN gm USING (feature) GROUP BY feature HAVING count(*) > 1),
fv AS (SELECT feature, df1, df2, (ssb / df1) / nullif(ssw / df2, 0) AS f FROM fs),
fp AS (SELECT *, CASE WHEN f IS NOT NULL THEN {sql_f_p('fv.f', 'fv.df1', 'fv.df2')} END AS p_value FROM fv)
SELECT feature, {sr('f')} AS statistic, df1, df2, {sr('p_value')} AS p_value, {_decided(reject)} FROM fp"""


def _anova_sql(long: str) -> str:
    return f"WITH {long}, {_f_sql('long', 'group means are unequal')}"


@query("anova", _anova_sql(_LONG))
def _(spark, d):
    return rounded_table(hypothesis.anova(_input(spark, d), "event_type", _COLS))


_LEVENE = """md AS (SELECT feature, label, quantile_cont(value, 0.5) AS c FROM long GROUP BY feature, label),
dv AS (SELECT feature, label, abs(value - c) AS value FROM long JOIN md USING (feature, label))"""


def _levene_sql(long: str) -> str:
    return f"WITH {long}, {_LEVENE}, {_f_sql('dv', 'group variances are unequal')}"


@query("levene", _levene_sql(_LONG))
def _(spark, d):
    return rounded_table(hypothesis.levene(_input(spark, d), "event_type", _COLS))


# --- rank tests -------------------------------------------------------------------------------


def _rank_sql(source: str) -> str:
    """Row-level average ranks: the textbook way, on purpose unlike the value counts of the operator."""
    return f"""rk AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS r,
  count(*) OVER (PARTITION BY feature, value)::DOUBLE AS t FROM {source}
  WINDOW w AS (PARTITION BY feature ORDER BY value)),
rs AS (SELECT feature, label, count(*)::DOUBLE AS n, sum(r) AS r, sum(t * t - 1) AS tie FROM rk GROUP BY feature, label)"""


def _kruskal_sql(source: str) -> str:
    return f"""{_rank_sql(source)},
ks AS (SELECT feature, count(*)::DOUBLE - 1 AS dof, sum(n) AS n, sum(r * r / n) AS s, sum(tie) AS tie FROM rs
  GROUP BY feature HAVING count(*) > 1),
kh AS (SELECT feature, dof, (12 / (n * (n + 1)) * s - 3 * (n + 1)) / nullif(1 - tie / (n * n * n - n), 0) AS h FROM ks),
kp AS (SELECT *, CASE WHEN h IS NOT NULL THEN {sql_chi2_p('kh.h', 'kh.dof')} END AS p_value FROM kh)"""


def _kruskal_table_sql(long: str) -> str:
    return f"""WITH {long}, {_kruskal_sql('long')} SELECT feature, {sr('h')} AS statistic, dof AS df,
  {sr('p_value')} AS p_value, {_decided('groups come from unequal distributions')} FROM kp"""


@query("kruskal_wallis", _kruskal_table_sql(_LONG))
def _(spark, d):
    return rounded_table(hypothesis.kruskal_wallis(_input(spark, d), "event_type", _COLS))


def _mw_sql(alternative: str) -> str:
    z = {
        "two-sided": "(abs(u - mu) - 0.5) / nullif(sd, 0)",
        "greater": "(u - mu - 0.5) / nullif(sd, 0)",
        "less": "(mu - u - 0.5) / nullif(sd, 0)",
    }[alternative]
    p = sql_normal_upper("mz.z")
    p = f"least(1, 2 * {p})" if alternative == "two-sided" else p
    return f"""WITH {_LONG}, two AS (SELECT * FROM long WHERE feature = 'value' AND label IN ('click', 'view')),
{_rank_sql('two')},
ab AS (SELECT a.feature, a.n AS na, b.n AS nb, a.r - a.n * (a.n + 1) / 2 AS u, a.tie + b.tie AS tie
  FROM rs a JOIN rs b ON a.feature = b.feature AND a.label = 'click' AND b.label = 'view'),
sd AS (SELECT feature, u, na * nb / 2 AS mu,
  sqrt(na * nb / 12 * (na + nb + 1 - tie / ((na + nb) * (na + nb - 1)))) AS sd FROM ab),
mz AS (SELECT feature, u, {z} AS z FROM sd),
mp AS (SELECT *, {p} AS p_value FROM mz)
SELECT feature, {sr('u')} AS statistic, {sr('z')} AS z, {sr('p_value')} AS p_value, 'asymptotic' AS method,
  {_decided('groups come from unequal distributions')} FROM mp"""


def _register_mann_whitney(name: str, alternative: str) -> None:
    @query(name, _mw_sql(alternative))
    def _(spark, d):
        out = hypothesis.mann_whitney(_input(spark, d), "value", "event_type", "click", "view", alternative)
        return rounded_table(out)


_register_mann_whitney("mann_whitney", "two-sided")
_register_mann_whitney("mann_whitney_greater", "greater")
_register_mann_whitney("rank_sum_less", "less")


@query(
    "wilcoxon_signed_rank",
    f"""WITH g AS (SELECT l_discount * 100 - l_tax * 125 AS x FROM lineitem),
long AS (SELECT 'd' AS feature, abs(x) AS value, CASE WHEN x > 0 THEN 'p' ELSE 'm' END AS label FROM g WHERE x <> 0),
{_rank_sql('long')},
wn AS (SELECT sum(r) FILTER (label = 'p') AS plus, sum(r) FILTER (label = 'm') AS minus, sum(n) AS n, sum(tie) AS tie FROM rs),
wz AS (SELECT least(plus, minus) AS w, (plus - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie / 48) AS z FROM wn),
wp AS (SELECT *, 2 * {sql_normal_upper('abs(wz.z)')} AS p_value FROM wz)
SELECT {sr('w')} AS statistic, {sr('z')} AS z, {sr('p_value')} AS p_value, 'asymptotic' AS method,
  {_decided('differences are not centred on zero')} FROM wp""",
)
def _(spark, d):
    li = table(spark, d, "lineitem").select(
        (F.col("l_discount") * 100).alias("a"), (F.col("l_tax") * 125).alias("b")
    )
    return rounded_table(hypothesis.wilcoxon_signed_rank(li, "a", "b"))


_TRIPLE = ["l_quantity / 50", "l_discount * 10", "l_tax * 12.5::DOUBLE"]


def _friedman_sql() -> str:
    names = ["a", "b", "c"]
    ranks, ties = [], []
    for x in names:
        below = " + ".join(f"({y} < {x})::INTEGER" for y in names)
        equal = " + ".join(f"({y} = {x})::INTEGER" for y in names)
        ranks.append(f"sum({below} + ({equal} + 1) / 2.0::DOUBLE) AS r{x}")
        ties.append(f"(({equal}) * ({equal}) - 1)")
    return f"""WITH t AS (SELECT {', '.join(f'{e} AS {n}' for e, n in zip(_TRIPLE, names))} FROM lineitem),
s AS (SELECT count(*)::DOUBLE AS n, {', '.join(ranks)}, sum({' + '.join(ties)})::DOUBLE AS tie FROM t),
f AS (SELECT (12 * (ra * ra + rb * rb + rc * rc) / (n * 3 * 4) - 3 * n * 4) / (1 - tie / (n * 3 * 8)) AS q, 2::DOUBLE AS dof FROM s),
p AS (SELECT *, exp(-q / 2) AS p_value FROM f)
SELECT {sr('q', 4)} AS statistic, dof AS df, {sr('p_value')} AS p_value, {_decided('groups come from unequal distributions')} FROM p"""


@query("friedman", _friedman_sql())
def _(spark, d):
    li = table(spark, d, "lineitem").select(
        (F.col("l_quantity") / 50).alias("a"),
        (F.col("l_discount") * 10).alias("b"),
        (F.col("l_tax") * 12.5).alias("c"),
    )
    out = hypothesis.friedman(li, ["a", "b", "c"])
    return rounded_table(out.withColumn("statistic", F.round("statistic", 4)))


# --- named tests, normality, battery ----------------------------------------------------------


def _named_sql(source: str, hypothesis_text: str, reject: str, keep: str) -> str:
    return f"""{_kruskal_sql(source)} SELECT 'Kruskal-Wallis' AS test, '{hypothesis_text}' AS hypothesis,
  {sr('h')} AS statistic, dof AS df, {sr('p_value')} AS p_value, {_decided(reject, keep)} FROM kp"""


@query(
    "airline_delay_test",
    f"WITH {LABELLED}, lf AS (SELECT 'ARR_DELAY' AS feature, AIRLINE AS label, ARR_DELAY AS value FROM labelled), "
    + _named_sql(
        "lf",
        "delay by airline",
        "delay depends on the airline",
        "no dependence of delay on the airline shown",
    ),
)
def _(spark, d):
    return rounded_table(hypothesis.airline_delay_test(labelled_flights(spark, d)))


@query(
    "time_of_day_test",
    f"""WITH {FLIGHTS}, lf AS (SELECT 'DEP_DELAY' AS feature, DEP_DELAY AS value,
  CASE WHEN CRS_DEP_TIME // 100 BETWEEN 6 AND 11 THEN 'Morning'
       WHEN CRS_DEP_TIME // 100 BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Night' END AS label FROM flights), """
    + _named_sql(
        "lf",
        "delay by time of day",
        "delay depends on the time of day",
        "no dependence of delay on the time of day shown",
    ),
)
def _(spark, d):
    return rounded_table(hypothesis.time_of_day_test(temporal_features(flights(spark, d))))


def _shapiro_sql(source: str, columns: list[str], relation: str, key: str) -> str:
    return f"""WITH {source}, long AS ({long_sql(relation, columns, key)}),
o AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS i,
    count(*) OVER (PARTITION BY feature) AS n FROM long),
u AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM o),
m AS (SELECT feature, value, i, n, {sql_normal_quantile('p')} AS m, 1 / sqrt(n) AS x FROM u),
e AS (SELECT feature, any_value(n) AS n, sum(m * m) AS s, max(m) FILTER (i = n) AS ml, max(m) FILTER (i = n - 1) AS mk,
    any_value(x) AS x FROM m GROUP BY feature),
a AS (SELECT *, ml / sqrt(s) + 0.221157 * x - 0.147981 * pow(x, 2) - 2.07119 * pow(x, 3) + 4.434685 * pow(x, 4)
      - 2.706056 * pow(x, 5) AS al,
    mk / sqrt(s) + 0.042981 * x - 0.293762 * pow(x, 2) - 1.752461 * pow(x, 3) + 5.682633 * pow(x, 4)
      - 3.582633 * pow(x, 5) AS ak FROM e),
c AS (SELECT *, sqrt((s - 2 * ml * ml - 2 * mk * mk) / (1 - 2 * al * al - 2 * ak * ak)) AS sc FROM a),
w AS (SELECT m.feature, any_value(c.n) AS n, pow(sum(value * CASE WHEN i = c.n THEN al WHEN i = c.n - 1 THEN ak
    WHEN i = 1 THEN -al WHEN i = 2 THEN -ak ELSE m / sc END), 2) / nullif(var_pop(value) * any_value(c.n), 0) AS w
    FROM m JOIN c ON m.feature = c.feature GROUP BY m.feature),
z AS (SELECT feature, n, w, (ln(1 - w) - (-1.5861 - 0.31082 * ln(n) - 0.083751 * pow(ln(n), 2) + 0.0038915 * pow(ln(n), 3)))
    / exp(-0.4803 - 0.082676 * ln(n) + 0.0030302 * pow(ln(n), 2)) AS z FROM w),
q AS (SELECT *, CASE WHEN w IS NOT NULL THEN {sql_normal_upper('z.z')} END AS p_value FROM z)
SELECT feature, n, {sr('w')} AS statistic, {sr('p_value')} AS p_value, p_value > 0.05 AS is_normal,
  CASE WHEN p_value IS NULL THEN 'not testable' WHEN p_value > 0.05 THEN 'compatible with a normal distribution' ELSE 'not normally distributed' END AS decision FROM q"""


@query(
    "shapiro",
    _shapiro_sql(
        EVENTS + ", src AS (SELECT event_id, value, wave, ln(value) AS log_value FROM ev)",
        ["value", "wave", "log_value"],
        "src",
        "event_id",
    ),
)
def _(spark, d):
    ev = events(spark, d).withColumn("log_value", F.log(F.col("value")))
    return rounded_table(normality.normality(ev, ["value", "wave", "log_value"], ["event_id"]))


def _stack(test: str, table_sql: str, groups: str = "'all'") -> str:
    return f"SELECT '{test}' AS test, feature, {groups} AS groups, statistic, p_value, decision FROM ({table_sql})"


@query(
    "battery_summary",
    "\nUNION ALL\n".join(
        [_stack("normality", _shapiro_sql(_SRC, _COLS, "src", "event_id"))]
        + [_stack(t, ORACLE[t]) for t in ("levene", "anova", "kruskal_wallis")]
        + [_stack("t_tests", ORACLE["pairwise_t"], "group_a || ' / ' || group_b")]
    ),
)
def _(spark, d):
    report = hypothesis.run_battery(_input(spark, d), "event_type", ["event_id"], _COLS)
    return rounded_table(hypothesis.battery_summary(report))


_DELAY = ["ARR_DELAY", "CRS_DEP_TIME", "CRS_ELAPSED_TIME", "DISTANCE", "DOT_CODE", "FL_NUMBER"]
_DELAY_LONG = f"{LABELLED}, long AS ({long_sql('labelled', _DELAY, 'DELAY_CLASS AS label')})"


@query(
    "battery_by_delay_class",
    "\nUNION ALL\n".join(
        [
            _stack("normality", _shapiro_sql(LABELLED, _DELAY, "labelled", "FLIGHT_ID")),
            _stack("levene", _levene_sql(_DELAY_LONG)),
            _stack("anova", _anova_sql(_DELAY_LONG)),
            _stack("kruskal_wallis", _kruskal_table_sql(_DELAY_LONG)),
            _stack("t_tests", _pairwise_sql(_DELAY_LONG), "group_a || ' / ' || group_b"),
        ]
    ),
)
def _(spark, d):
    from tarmac.operators.clean import classify_delay

    labelled = classify_delay(valid_flights(flights(spark, d)), "ARR_DELAY")
    report = hypothesis.run_battery(labelled, "DELAY_CLASS", ["FLIGHT_ID"])
    return rounded_table(hypothesis.battery_summary(report))
