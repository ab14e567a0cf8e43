"""Descriptive statistics, correlations, data quality and chart data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tarmac.contract.tables import (
    EVENTS,
    LABELLED,
    PRICES,
    events,
    flights,
    labelled_flights,
    long_sql,
    prices,
    rounded_table,
    sql_normal_quantile,
    sr,
    table,
    union_all,
)
from tarmac.operators import chartdata, normality, profile
from tarmac.plans import flights as plan

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


_COLS = ["l_quantity", "price", "l_discount", "l_tax"]


def _describe_sql(keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return (
        f"SELECT {lead}feature, count(*) AS count, {sr('avg(value)', 4)} AS mean, "
        f"{sr('stddev_samp(value)', 4)} AS std, {sr('min(value)', 4)} AS min, "
        f"{sr('quantile_cont(value, 0.25)', 4)} AS q25, {sr('quantile_cont(value, 0.5)', 4)} AS q50, "
        f"{sr('quantile_cont(value, 0.75)', 4)} AS q75, {sr('max(value)', 4)} AS max "
        f"FROM long GROUP BY {lead}feature"
    )


@query(
    "delay_profile",
    f"WITH {LABELLED}, long AS ({long_sql('labelled', ['ARR_DELAY', 'DISTANCE', 'CRS_ELAPSED_TIME'], 'DELAY_CLASS')}) "
    + _describe_sql("DELAY_CLASS"),
)
def _(spark, d):
    return rounded_table(plan.delay_profile(flights(spark, d)), 4)


@query("describe_overall", f"WITH {PRICES}, long AS ({long_sql('pr', _COLS)}) " + _describe_sql())
def _(spark, d):
    return rounded_table(profile.describe(prices(spark, d), _COLS), 4)


@query(
    "describe_by_group",
    f"WITH {PRICES}, long AS ({long_sql('pr', _COLS, 'l_returnflag')}) " + _describe_sql("l_returnflag"),
)
def _(spark, d):
    return rounded_table(profile.describe(prices(spark, d), _COLS, by="l_returnflag"), 4)


@query(
    "range_overall",
    f"WITH {PRICES}, long AS ({long_sql('pr', _COLS)}) "
    f"SELECT feature, {sr('max(value) - min(value)')} AS value_range FROM long GROUP BY feature",
)
def _(spark, d):
    return rounded_table(profile.value_range(prices(spark, d), _COLS))


@query(
    "range_by_group",
    f"WITH {PRICES}, long AS ({long_sql('pr', _COLS, 'l_returnflag')}) "
    f"SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'overall' ELSE 'group' END AS level, l_returnflag, feature, "
    f"{sr('max(value) - min(value)')} AS value_range FROM long "
    "GROUP BY GROUPING SETS ((feature), (l_returnflag, feature))",
)
def _(spark, d):
    return rounded_table(profile.value_range(prices(spark, d), _COLS, by="l_returnflag"))


_CORR = ["value", "wave", "grade", "flat"]
_CORR_SRC = EVENTS + ",\nsrc AS (SELECT event_type, value, wave, grade::DOUBLE AS grade, 3::DOUBLE AS flat FROM ev)"


def _corr_input(spark, d):
    return events(spark, d).select(
        "event_type", "value", "wave", F.col("grade").cast("double").alias("grade"), F.lit(3.0).alias("flat")
    )


def _corr_cell(x: str, y: str, keep: str) -> str:
    lead = f"{keep}, " if keep else ""
    group = f" GROUP BY {keep}" if keep else ""
    return (
        f"SELECT {lead}'{x}' AS x, '{y}' AS y, "
        + sr(
            f"CASE WHEN min({x}) FILTER ({y} IS NOT NULL) = max({x}) FILTER ({y} IS NOT NULL) "
            f"OR min({y}) FILTER ({x} IS NOT NULL) = max({y}) FILTER ({x} IS NOT NULL) THEN NULL "
            f"ELSE corr({y}, {x}) END"
        )
        + f" AS r, count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM src{group}"
        + (" HAVING count(*) > 2" if keep else "")
    )


def _corr_sql(keep: str = "") -> str:
    return union_all([_corr_cell(x, y, keep) for x in _CORR for y in _CORR])


@query("corr_matrix", f"WITH {_CORR_SRC}\n{_corr_sql()}")
def _(spark, d):
    return rounded_table(profile.corr_matrix(_corr_input(spark, d), _CORR))


@query("corr_by_group", f"WITH {_CORR_SRC}\n{_corr_sql('event_type')}")
def _(spark, d):
    return rounded_table(profile.corr_matrix(_corr_input(spark, d), _CORR, by="event_type"))


_WIDE = 45


def _wide(spark, d):
    """The first dimensions of the embeddings with gaps in every third column, and a constant."""
    value = F.col("embedding").cast("array<double>")
    cells = [
        F.when((F.col("vec_id") + i) % 11 != 0, value[i]).alias(f"x{i}") if i % 3 == 0 else value[i].alias(f"x{i}")
        for i in range(_WIDE)
    ]
    return table(spark, d, "embeddings").select(*cells, F.lit(3.25).alias(f"x{_WIDE}"))


@query(
    "corr_matrix_wide",
    f"""WITH ce AS (SELECT vec_id, i, CASE WHEN i = {_WIDE} THEN 3.25 WHEN i % 3 = 0 AND (vec_id + i) % 11 = 0 THEN NULL
  ELSE embedding[i + 1]::DOUBLE END AS v FROM embeddings, (SELECT unnest(range({_WIDE + 1})) AS i)),
pa AS (SELECT a.i, b.i AS j, a.v, b.v AS w FROM ce a JOIN ce b ON a.vec_id = b.vec_id AND a.v IS NOT NULL AND b.v IS NOT NULL)
SELECT 'x' || i AS x, 'x' || j AS y, CASE WHEN min(v) < max(v) AND min(w) < max(w) THEN {sr('corr(v, w)')} END AS r, count(*) AS n
FROM pa GROUP BY i, j""",
)
def _(spark, d):
    wide = _wide(spark, d)
    return rounded_table(profile.corr_matrix(wide, wide.columns))


_PAIRS = [(x, y) for i, x in enumerate(_CORR) for y in _CORR[i + 1 :]]
_TOP = f"top AS (SELECT * FROM ({union_all([_corr_cell(x, y, '') for x, y in _PAIRS])}) WHERE r IS NOT NULL ORDER BY abs(r) DESC, x, y LIMIT {{n}})"


@query("top_correlations", f"WITH {_CORR_SRC}, {_TOP.format(n=2)} SELECT x, y, r, n FROM top")
def _(spark, d):
    return rounded_table(profile.top_correlations(_corr_input(spark, d), _CORR, 2))


@query(
    "top_corr_matrix",
    f"WITH {_CORR_SRC}, {_TOP.format(n=1)}, names AS (SELECT x AS c FROM top UNION SELECT y FROM top), "
    f"m AS ({_corr_sql()}) SELECT x, y, r, n FROM m WHERE x IN (FROM names) AND y IN (FROM names)",
)
def _(spark, d):
    return rounded_table(profile.top_corr_matrix(_corr_input(spark, d), _CORR, 1))


@query(
    "missing_counts",
    f"WITH {EVENTS}\n"
    + union_all(
        [
            f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing FROM ev"
            for c in ["event_id", "value", "wave", "grade"]
        ]
    ),
)
def _(spark, d):
    return profile.missing_counts(events(spark, d), ["event_id", "value", "wave", "grade"])


@query(
    "duplicate_count",
    "SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem)))"
    "::BIGINT AS duplicate_rows FROM lineitem",
)
def _(spark, d):
    return profile.duplicate_count(
        table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag")
    )


@query(
    "iqr_outliers",
    f"""WITH {EVENTS}, long AS ({long_sql('ev', ['value', 'wave', 'grade'])}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM long GROUP BY feature)
SELECT feature, count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS outliers
FROM long JOIN q USING (feature) GROUP BY feature""",
)
def _(spark, d):
    return profile.iqr_outlier_counts(events(spark, d), ["value", "wave", "grade"])


# --- charts -----------------------------------------------------------------------------------


def _histogram_sql(source: str, columns: list[str], bins: int, keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    long = long_sql(source, columns, keep)
    groups = f"gr AS (SELECT DISTINCT {keep} FROM {source})," if keep else ""
    cross = ", gr" if keep else ""
    return f"""long AS ({long}), {groups}
ex AS (SELECT feature, min(value) AS lo, (max(value) - min(value)) / {bins} AS w FROM long GROUP BY feature),
ct AS (SELECT {lead}feature, least(floor((value - lo) / w), {bins - 1})::INTEGER AS bin, count(*) AS n
       FROM long JOIN ex USING (feature) GROUP BY ALL),
fr AS (SELECT {lead}feature, lo, w, i::INTEGER AS bin FROM ex, range({bins}) t(i){cross})
SELECT {lead}feature, bin, {sr('lo + bin * w')} AS bin_from, {sr('lo + (bin + 1) * w')} AS bin_to,
  coalesce(n, 0)::BIGINT AS n FROM fr LEFT JOIN ct USING ({lead}feature, bin)"""


@query("histogram", f"WITH {PRICES}, {_histogram_sql('pr', ['l_quantity', 'price', 'l_tax'], 30)}")
def _(spark, d):
    return rounded_table(chartdata.histogram(prices(spark, d), ["l_quantity", "price", "l_tax"], 30))


@query(
    "histogram_by_group",
    f"WITH {PRICES}, {_histogram_sql('pr', ['l_quantity', 'price'], 30, 'l_returnflag')}",
)
def _(spark, d):
    return rounded_table(
        chartdata.histogram(prices(spark, d), ["l_quantity", "price"], 30, by="l_returnflag")
    )


@query("target_histogram", f"WITH {LABELLED}, {_histogram_sql('labelled', ['ARR_DELAY'], 50)}")
def _(spark, d):
    return rounded_table(chartdata.histogram(labelled_flights(spark, d), ["ARR_DELAY"], 50))


def _box_sql(keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return f"""q AS (SELECT {lead}feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM long GROUP BY {lead}feature),
f AS (SELECT *, value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside
      FROM long JOIN q USING ({lead}feature))
SELECT {lead}feature, {sr('q1')} AS q1, {sr('median')} AS median, {sr('q3')} AS q3,
  {sr('min(value) FILTER (inside)')} AS whisker_low, {sr('max(value) FILTER (inside)')} AS whisker_high,
  count(*) FILTER (NOT inside) AS fliers FROM f GROUP BY {lead}feature, f.q1, f.median, f.q3"""


@query("box_stats", f"WITH {EVENTS}, long AS ({long_sql('ev', ['value', 'wave'])}), {_box_sql()}")
def _(spark, d):
    return rounded_table(chartdata.box_stats(events(spark, d), ["value", "wave"]))


@query(
    "box_stats_by_group",
    f"WITH {EVENTS}, long AS ({long_sql('ev', ['value', 'wave'], 'event_type')}), {_box_sql('event_type')}",
)
def _(spark, d):
    return rounded_table(chartdata.box_stats(events(spark, d), ["value", "wave"], by="event_type"))


@query(
    "strip_sample",
    f"""WITH {EVENTS} SELECT event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id || '|42'), event_id) AS rn
  FROM ev WHERE value IS NOT NULL) WHERE rn <= 200""",
)
def _(spark, d):
    return chartdata.strip_sample(events(spark, d), "value", "event_type", 200, ["event_id"])


@query(
    "pair_sample",
    f"""WITH {EVENTS} SELECT event_id, value, wave, grade FROM (
  SELECT *, row_number() OVER (ORDER BY md5(event_id || '|42'), event_id) AS rn FROM ev) WHERE rn <= 1000""",
)
def _(spark, d):
    return chartdata.pair_sample(events(spark, d), ["value", "wave", "grade"], 1000, ["event_id"])


def _kde_sql(low: str, high: str, keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return f"""s AS (SELECT {lead}feature, count(*) AS n, min(value) AS lo, max(value) AS hi,
  pow(count(*), -0.2) * stddev_samp(value) AS h FROM long GROUP BY {lead}feature),
g AS (SELECT *, i::INTEGER AS grid_point, {low} + i * (({high}) - ({low})) / 199.0 AS x FROM s, range(200) t(i))
SELECT {lead}feature, grid_point, {sr('x')} AS x,
  {sr('sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (n * h * sqrt(2 * pi()))', 8)} AS density,
  {sr('h')} AS bandwidth FROM long JOIN g USING ({lead}feature) GROUP BY {lead}feature, grid_point, x, n, h"""


@query("kde", f"WITH {EVENTS}, long AS ({long_sql('ev', ['value', 'wave'])}), {_kde_sql('lo', 'hi')}")
def _(spark, d):
    return _kde_table(chartdata.kde(events(spark, d), ["value", "wave"]))


def _kde_table(df):
    digits = {"x": 6, "bandwidth": 6, "density": 8}
    return df.select(
        *[
            (F.round(c, digits[c]) + F.lit(0.0)).alias(c) if c in digits else F.col(c)
            for c in df.columns
        ]
    )


@query(
    "density_ridges",
    f"WITH {EVENTS}, long AS ({long_sql('ev', ['value'], 'event_type')}), "
    + _kde_sql("(lo - 3 * h)", "(hi + 3 * h)", "event_type"),
)
def _(spark, d):
    return _kde_table(chartdata.kde(events(spark, d), ["value"], by="event_type", ridge=True))


@query(
    "kde_binned",
    f"""WITH {PRICES}, raw AS (SELECT 'price' AS feature, price AS value FROM pr WHERE price IS NOT NULL),
s AS (SELECT feature, count(*) AS n, min(value) AS lo, max(value) AS hi,
  pow(count(*), -0.2) * stddev_samp(value) AS h FROM raw GROUP BY feature),
b AS (SELECT feature, lo + (least(floor((value - lo) / ((hi - lo) / 1024)), 1023) + 0.5) * ((hi - lo) / 1024) AS mid,
  count(*) AS w FROM raw JOIN s USING (feature) GROUP BY ALL),
g AS (SELECT *, i::INTEGER AS grid_point, lo + i * (hi - lo) / 199.0 AS x FROM s, range(200) t(i))
SELECT feature, grid_point, {sr('x')} AS x,
  {sr('sum(w * exp(-0.5 * ((x - mid) / h) * ((x - mid) / h))) / (n * h * sqrt(2 * pi()))', 8)} AS density,
  {sr('h')} AS bandwidth FROM b JOIN g USING (feature) GROUP BY feature, grid_point, x, n, h""",
)
def _(spark, d):
    return _kde_table(chartdata.kde(prices(spark, d), ["price"], bins=1024))


@query(
    "linear_fit",
    f"""WITH {PRICES} SELECT regr_count(price, l_quantity)::BIGINT AS n, {sr('regr_slope(price, l_quantity)', 4)} AS slope,
  {sr('regr_intercept(price, l_quantity)', 4)} AS intercept, {sr('regr_r2(price, l_quantity)')} AS r2 FROM pr""",
)
def _(spark, d):
    fit = chartdata.linear_fit(prices(spark, d), "l_quantity", "price")
    return fit.select(
        "n",
        *[(F.round(c, g) + F.lit(0.0)).alias(c) for c, g in (("slope", 4), ("intercept", 4), ("r2", 6))],
    )


# replicate weights as the operator draws them: a 64-bit finaliser of digest and replicate, then steps of Poisson(1)
_CI = f"""WITH {EVENTS}, m AS (SELECT 18446744073709551616::UHUGEINT AS m),
p AS (SELECT wave::DOUBLE AS x, value::DOUBLE AS y, ('0x' || substr(md5(event_id || '|42'), 1, 15))::UBIGINT AS d
  FROM ev WHERE wave IS NOT NULL AND value IS NOT NULL),
c AS (SELECT avg(x) AS cx, avg(y) AS cy, min(x) AS l, max(x) AS h, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM p),
st AS (SELECT list(q ORDER BY k) AS st FROM (SELECT k, sum(exp(-1::DOUBLE) / factorial(k::INTEGER)::DOUBLE) OVER (ORDER BY k) AS q FROM range(19) t(k))),
r0 AS (SELECT x - cx AS a, y - cy AS b, k, ((d::UHUGEINT + k::UHUGEINT * 11400714819323198485::UHUGEINT) % m)::UBIGINT AS z
  FROM p, c, m, range(1, 201) t(k)),
r1 AS (SELECT a, b, k, ((xor(z, z >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % m)::UBIGINT AS z FROM r0, m),
r2 AS (SELECT a, b, k, ((xor(z, z >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT) % m)::UBIGINT AS z FROM r1, m),
r3 AS (SELECT a, b, k, (xor(z, z >> 31) >> 11)::DOUBLE / 9007199254740992.0::DOUBLE AS u FROM r2),
w AS (SELECT a, b, k, len(list_filter(st, lambda q: q <= u))::DOUBLE AS w FROM r3, st),
su AS (SELECT k, sum(w) AS sw, sum(w * a) AS sx, sum(w * b) AS sy, sum(w * a * a) AS sxx, sum(w * a * b) AS sxy FROM w GROUP BY k),
li AS (SELECT (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS g, sw, sx, sy FROM su),
gr AS (SELECT j::INTEGER AS grid_point, l + j * ((h - l) / 99) AS x, cx, cy, s, i AS fi FROM c, range(100) t(j)),
ba AS (SELECT grid_point, x, s, fi, quantile_cont(cy + (sy - g * sx) / sw + g * (x - cx), 0.025::DOUBLE) AS low,
  quantile_cont(cy + (sy - g * sx) / sw + g * (x - cx), 0.975::DOUBLE) AS high FROM li, gr GROUP BY ALL)
SELECT grid_point, {sr('x')} AS x, {sr('fi + s * x')} AS fit, {sr('low')} AS low, {sr('high')} AS high FROM ba"""


@query("linear_fit_ci", _CI)
def _(spark, d):
    return rounded_table(chartdata.linear_fit_ci(events(spark, d), "wave", "value", ["event_id"], replicates=200))


_QQ = f"""WITH {EVENTS}, long AS ({long_sql('ev', ['value', 'wave'])}),
o AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS position,
        count(*) OVER (PARTITION BY feature) AS n FROM long),
u AS (SELECT *, CASE WHEN position = n THEN pow(0.5, 1.0 / n) WHEN position = 1 THEN 1 - pow(0.5, 1.0 / n)
        ELSE (position - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM o),
t AS (SELECT feature, position, value, {sql_normal_quantile('p')} AS theoretical FROM u)"""


@query("qq_points", f"{_QQ} SELECT feature, position, {sr('theoretical')} AS theoretical, {sr('value')} AS value FROM t")
def _(spark, d):
    return rounded_table(normality.qq_points(events(spark, d), ["value", "wave"]))


@query(
    "qq_fit",
    f"""{_QQ} SELECT feature, count(*) AS n, {sr('regr_slope(value, theoretical)')} AS slope,
  {sr('regr_intercept(value, theoretical)')} AS intercept, {sr('corr(value, theoretical)')} AS r FROM t GROUP BY feature""",
)
def _(spark, d):
    return rounded_table(normality.qq_fit(events(spark, d), ["value", "wave"]))


# --- the whole report -------------------------------------------------------------------------

_REPORTED = ["value", "wave", "grade"]
_STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def _tidy_describe_sql(source: str, report: str, group: str) -> str:
    return union_all([f"SELECT '{report}' AS report, {group} AS part, feature, '{s}' AS item, {s}::DOUBLE AS number FROM {source}" for s in _STATS])


_REPORT = f"""WITH {EVENTS}, src AS (SELECT * FROM ev), long AS ({long_sql('ev', _REPORTED, 'event_type')}),
de AS ({_describe_sql()}), dg AS ({_describe_sql('event_type')}),
co AS ({union_all([_corr_cell(x, y, '') for x in _REPORTED for y in _REPORTED])}),
cg AS ({union_all([_corr_cell(x, y, 'event_type') for x in _REPORTED for y in _REPORTED])}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM long GROUP BY feature)
{_tidy_describe_sql('de', 'describe_overall', 'NULL')} UNION ALL {_tidy_describe_sql('dg', 'describe_by_group', 'event_type')} UNION ALL
SELECT 'range', event_type, feature, 'value_range', {sr('max(value) - min(value)', 4)} FROM long GROUP BY GROUPING SETS ((feature), (event_type, feature)) UNION ALL
SELECT 'corr_overall', NULL, x, y, r FROM co UNION ALL SELECT 'corr_by_group', event_type, x, y, r FROM cg WHERE event_type IS NOT NULL UNION ALL
{union_all([f"SELECT 'missing', NULL, '{c}', 'missing', count(*) FILTER ({c} IS NULL) FROM ev" for c in _REPORTED])} UNION ALL
SELECT 'outliers', NULL, feature, 'outliers', count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a))
  FROM long JOIN q USING (feature) GROUP BY feature UNION ALL
SELECT 'duplicates', NULL, NULL, 'duplicate_rows', (SELECT count(*) FROM ev) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ev))"""


@query("analytical_report", _REPORT)
def _(spark, d):
    def rows(report, df, feature, items, group=None, digits=4):
        none = F.lit(None).cast("string")
        pairs = F.inline(F.array(*[F.struct(i.alias("item"), F.col(n).cast("double").alias("number")) for i, n in items]))
        part = F.col(group) if group in df.columns else none
        made = df.select(F.lit(report).alias("report"), part.alias("part"), (F.col(feature) if feature else none).alias("feature"), pairs)
        return rounded_table(made, digits)

    given = profile.analytical_report(events(spark, d), _REPORTED, "event_type")
    stats = [(F.lit(s), s) for s in _STATS]
    parts = [
        rows("describe_overall", given["describe_overall"], "feature", stats),
        rows("describe_by_group", given["describe_by_group"], "feature", stats, "event_type"),
        rows("range", given["range"], "feature", [(F.lit("value_range"), "value_range")], "event_type"),
        rows("corr_overall", given["corr_overall"], "x", [(F.col("y"), "r")], digits=6),
        rows("corr_by_group", given["corr_by_group"], "x", [(F.col("y"), "r")], "event_type", digits=6),
        rows("missing", given["missing"], "feature", [(F.lit("missing"), "missing")]),
        rows("outliers", given["outliers"], "feature", [(F.lit("outliers"), "outliers")]),
        rows("duplicates", given["duplicates"], None, [(F.lit("duplicate_rows"), "duplicate_rows")]),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
