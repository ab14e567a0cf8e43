"""Sources, cleaning, imputation, features, encoding and scaling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarmac.contract.tables import (
    EVENTS,
    FLIGHTS,
    LABELLED,
    events,
    flights,
    labelled_flights,
    rounded_table,
    sr,
    table,
    union_all,
)
from tarmac.operators import clean, encode, features, sampling, scale
from tarmac.plans import flights as plan
from tarmac.session import ensure_checkpoint_dir
from tarmac.sources import flights as roles
from tarmac.sources import tables as io

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query(
    "scan_limit",
    "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 100",
)
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return io.first_rows(ev, 100, ["event_id"])


_TYPES = {
    "event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double",
    "wave": "double", "grade": "bigint",
}


@query(
    "dataset_info",
    f"WITH {EVENTS}\n"
    + union_all(
        [
            f'SELECT \'{c}\' AS "column", \'{t}\' AS data_type, count({c}) AS non_null, count(*) AS n_rows FROM ev'
            for c, t in _TYPES.items()
        ]
    ),
)
def _(spark, d):
    from tarmac.operators.profile import dataset_info

    return dataset_info(events(spark, d))


@query("checkpoint_roundtrip", f"WITH {EVENTS} SELECT event_id, event_type, value, grade FROM ev")
def _(spark, d):
    folder = _scratch(spark)
    kept = events(spark, d).select("event_id", "event_type", "value", "grade")
    io.save_checkpoint(kept, folder, {"columns": kept.columns})
    return io.load_checkpoint(spark, folder)[0]


@query("csv_roundtrip", f"WITH {EVENTS} SELECT event_id, event_type, value, grade FROM ev")
def _(spark, d):
    folder = _scratch(spark)
    kept = events(spark, d).select("event_id", "event_type", "value", "grade")
    io.write_csv(kept, folder)
    return io.read_csv(spark, folder, kept.schema)


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip-{uuid.uuid4().hex}"


# --- rows and columns -------------------------------------------------------------------------


@query(
    "drop_flagged",
    f"WITH {FLIGHTS} SELECT FLIGHT_ID, CANCELLED, DIVERTED, DEP_DELAY FROM flights "
    "WHERE CANCELLED = 0 AND DIVERTED = 0",
)
def _(spark, d):
    kept = clean.drop_flagged(flights(spark, d), roles.STATUS_FLAGS)
    return kept.select("FLIGHT_ID", "CANCELLED", "DIVERTED", "DEP_DELAY")


@query(
    "drop_leakage",
    f"WITH {FLIGHTS} SELECT FLIGHT_ID, FL_DATE, AIRLINE, AIRLINE_CODE, ORIGIN, DEST, CRS_DEP_TIME, "
    "CRS_ELAPSED_TIME, DISTANCE, ARR_DELAY FROM flights",
)
def _(spark, d):
    return (
        flights(spark, d)
        .transform(clean.drop_columns, roles.LEAKAGE_COLUMNS)
        .transform(clean.drop_columns, roles.REDUNDANT_COLUMNS)
    )


@query(
    "drop_null_target",
    f"WITH {FLIGHTS} SELECT FLIGHT_ID, ARR_DELAY FROM flights WHERE ARR_DELAY IS NOT NULL",
)
def _(spark, d):
    return clean.drop_null(flights(spark, d), ["ARR_DELAY"]).select("FLIGHT_ID", "ARR_DELAY")


@query(
    "feature_matrix",
    f"WITH {EVENTS} SELECT event_type, event_id::DOUBLE AS event_id, user_id::DOUBLE AS user_id, "
    "coalesce(value, 0::DOUBLE) AS value, wave, coalesce(grade::DOUBLE, 0::DOUBLE) AS grade FROM ev",
)
def _(spark, d):
    return clean.feature_matrix(events(spark, d), "event_type")


@query(
    "split_xy",
    f"WITH {EVENTS} SELECT event_id, user_id, event_type, wave, grade FROM ev",
)
def _(spark, d):
    return clean.split_xy(events(spark, d), "value")[0]


@query(
    "remove_duplicates",
    "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    return clean.remove_duplicates(
        li.select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    )


@query(
    "clip_delay",
    f"WITH {FLIGHTS} SELECT FLIGHT_ID, CASE WHEN ARR_DELAY < 0 THEN 0::DOUBLE ELSE ARR_DELAY END AS ARR_DELAY "
    "FROM flights",
)
def _(spark, d):
    return clean.clip_delay(flights(spark, d), "ARR_DELAY").select("FLIGHT_ID", "ARR_DELAY")


@query(
    "clipped_count",
    f"WITH {FLIGHTS} SELECT count(*) AS clipped_rows FROM flights WHERE ARR_DELAY < 0",
)
def _(spark, d):
    return clean.clipped_count(flights(spark, d), "ARR_DELAY")


@query(
    "classify_delay",
    f"""WITH {FLIGHTS} SELECT FLIGHT_ID, ARR_DELAY,
    CASE WHEN ARR_DELAY IS NULL THEN 'Unknown' WHEN ARR_DELAY < 15 THEN 'On-time'
         WHEN ARR_DELAY <= 30 THEN 'Short delay' ELSE 'Long delay' END AS DELAY_CLASS FROM flights""",
)
def _(spark, d):
    return clean.classify_delay(flights(spark, d), "ARR_DELAY").select(
        "FLIGHT_ID", "ARR_DELAY", "DELAY_CLASS"
    )


# --- imputation -------------------------------------------------------------------------------

_FILLED = ["value", "grade"]


@query(
    "fill_mean",
    f"""WITH {EVENTS} SELECT event_id, {sr("coalesce(value, (SELECT avg(value) FROM ev))")} AS value,
    {sr("coalesce(grade::DOUBLE, (SELECT avg(grade) FROM ev))")} AS grade FROM ev""",
)
def _(spark, d):
    out = clean.fill_missing(events(spark, d).select("event_id", *_FILLED), "mean")
    return rounded_table(out)


@query(
    "fill_median",
    f"""WITH {EVENTS} SELECT event_id,
    {sr("coalesce(value, (SELECT quantile_cont(value, 0.5) FROM ev))")} AS value,
    {sr("coalesce(grade::DOUBLE, (SELECT quantile_cont(grade::DOUBLE, 0.5) FROM ev))")} AS grade FROM ev""",
)
def _(spark, d):
    out = clean.fill_missing(events(spark, d).select("event_id", *_FILLED), "median")
    return rounded_table(out)


def _mode_sql(column: str) -> str:
    return (
        f"(SELECT {column} FROM ev WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


@query(
    "fill_mode",
    f"""WITH {EVENTS} SELECT event_id, coalesce(value, {_mode_sql("value")}) AS value,
    coalesce(grade, {_mode_sql("grade")}) AS grade FROM ev""",
)
def _(spark, d):
    return clean.fill_missing(events(spark, d).select("event_id", *_FILLED), "mode")


@query(
    "fill_constant",
    f"WITH {EVENTS} SELECT event_id, coalesce(value, -1::DOUBLE) AS value, coalesce(grade, -1) AS grade FROM ev",
)
def _(spark, d):
    return clean.fill_missing(events(spark, d).select("event_id", *_FILLED), "constant", -1)


@query(
    "missing_drop",
    f"WITH {EVENTS} SELECT * FROM ev WHERE value IS NOT NULL AND grade IS NOT NULL",
)
def _(spark, d):
    return clean.handle_missing(events(spark, d), "drop")


@query(
    "missing_fill",
    f"WITH {EVENTS} SELECT * REPLACE (coalesce(value, 0::DOUBLE) AS value, coalesce(grade, 0) AS grade) FROM ev",
)
def _(spark, d):
    return clean.handle_missing(events(spark, d), "fill", 0)


def _iqr_sql(source: str, column: str, name: str) -> str:
    return f"""{name}_q AS (SELECT quantile_cont({column}::DOUBLE, 0.25) AS a, quantile_cont({column}::DOUBLE, 0.75) AS b FROM {source}),
{name}_in AS (SELECT avg({column}) AS m FROM {source}, {name}_q
  WHERE {column} >= a - 1.5 * (b - a) AND {column} <= b + 1.5 * (b - a))"""


def _iqr_value(column: str, name: str) -> str:
    return (
        f"CASE WHEN {column} >= (SELECT a - 1.5 * (b - a) FROM {name}_q) "
        f"AND {column} <= (SELECT b + 1.5 * (b - a) FROM {name}_q) THEN {column} "
        f"ELSE (SELECT m FROM {name}_in) END"
    )


@query(
    "iqr_replace",
    f"WITH {EVENTS}, {_iqr_sql('ev', 'value', 'v')}\n"
    f"SELECT event_id, {sr(_iqr_value('value', 'v'))} AS value, grade FROM ev",
)
def _(spark, d):
    out = clean.replace_outliers_iqr(events(spark, d), ["value"])
    return rounded_table(out.select("event_id", "value", "grade"))


@query(
    "impute_mean_all",
    f"WITH {EVENTS}, {_iqr_sql('ev', 'value', 'v')}\n"
    f"SELECT event_id, user_id, event_type, {sr(_iqr_value('value', 'v'))} AS value, {sr('wave')} AS wave, "
    f"{sr('coalesce(grade::DOUBLE, (SELECT avg(grade) FROM ev))')} AS grade FROM ev",
)
def _(spark, d):
    out = clean.treat_outliers_and_missing(events(spark, d), ["value"])
    return rounded_table(out)


# --- features ---------------------------------------------------------------------------------

_TEMPORAL = """month(FL_DATE)::INTEGER AS MONTH, (isodow(FL_DATE) - 1)::INTEGER AS DAY_OF_WEEK,
  dayofyear(FL_DATE)::INTEGER AS DAY_OF_YEAR, quarter(FL_DATE)::INTEGER AS QUARTER,
  CASE WHEN isodow(FL_DATE) >= 6 THEN 1 ELSE 0 END AS IS_WEEKEND,
  CASE WHEN month(FL_DATE) IN (7, 8, 12) THEN 1 ELSE 0 END AS IS_HOLIDAY_SEASON,
  (CRS_DEP_TIME // 100)::INTEGER AS DEP_HOUR,
  CASE WHEN CRS_DEP_TIME // 100 BETWEEN 6 AND 11 THEN 1 ELSE 0 END AS MORNING_FLIGHT,
  CASE WHEN CRS_DEP_TIME // 100 BETWEEN 12 AND 17 THEN 1 ELSE 0 END AS AFTERNOON_FLIGHT,
  CASE WHEN CRS_DEP_TIME // 100 BETWEEN 6 AND 17 THEN 0 ELSE 1 END AS NIGHT_FLIGHT,
  CASE WHEN CRS_DEP_TIME // 100 BETWEEN 6 AND 11 THEN 'Morning'
       WHEN CRS_DEP_TIME // 100 BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Night' END AS TIME_PERIOD"""

_SPEED = "DISTANCE / CRS_ELAPSED_TIME"


def _bin_sql(value: str, a: int, b: int, c: int, labels: tuple[str, str, str], name: str) -> str:
    return (
        f"CASE WHEN {value} > 0 AND {value} <= {a} THEN '{labels[0]}' "
        f"WHEN {value} > {a} AND {value} <= {b} THEN '{labels[1]}' "
        f"WHEN {value} > {b} AND {value} <= {c} THEN '{labels[2]}' END AS {name}"
    )


_BINS = ", ".join(
    [
        _bin_sql("DISTANCE", 500, 1500, 10000, ("Short", "Medium", "Long"), "DISTANCE_CAT"),
        _bin_sql("CRS_ELAPSED_TIME", 120, 360, 1200, ("Short", "Medium", "Long"), "DURATION_CAT"),
        _bin_sql(f"({_SPEED})", 5, 8, 15, ("Slow", "Normal", "Fast"), "SPEED_CAT"),
    ]
)
_ROUTES = """freq AS (SELECT ORIGIN || '_' || DEST AS ROUTE, count(*) AS ROUTE_FREQUENCY
  FROM {src} WHERE ORIGIN IS NOT NULL GROUP BY 1)"""
# row-wise arithmetic is the same in both engines to the last bit, so it is compared unrounded
_INTERACT = """DISTANCE * CRS_ELAPSED_TIME AS DISTANCE_x_ELAPSED_TIME, DISTANCE * DISTANCE AS DISTANCE_POW2,
  CRS_ELAPSED_TIME * CRS_ELAPSED_TIME AS ELAPSED_TIME_POW2"""


@query("temporal_features", f"WITH {FLIGHTS} SELECT FLIGHT_ID, {_TEMPORAL} FROM flights")
def _(spark, d):
    out = features.temporal_features(flights(spark, d))
    return out.select("FLIGHT_ID", *features.feature_columns_added()[:11])


@query(
    "route_features",
    f"WITH {FLIGHTS}, {_ROUTES.format(src='flights')} SELECT FLIGHT_ID, ORIGIN || '_' || DEST AS ROUTE, "
    f"ROUTE_FREQUENCY, {_SPEED} AS PLANNED_SPEED_MPM "
    "FROM flights LEFT JOIN freq ON ORIGIN || '_' || DEST = freq.ROUTE",
)
def _(spark, d):
    out = features.route_features(flights(spark, d))
    return out.select("FLIGHT_ID", "ROUTE", "ROUTE_FREQUENCY", "PLANNED_SPEED_MPM")


@query(
    "route_frequency",
    f"WITH {FLIGHTS}, rt AS (SELECT FLIGHT_ID, ORIGIN || '_' || DEST AS ROUTE FROM flights) "
    "SELECT FLIGHT_ID, ROUTE, CASE WHEN ROUTE IS NOT NULL THEN count(*) OVER (PARTITION BY ROUTE) END "
    "AS ROUTE_FREQUENCY FROM rt",
)
def _(spark, d):
    routed = flights(spark, d).select(
        "FLIGHT_ID", F.concat("ORIGIN", F.lit("_"), "DEST").alias("ROUTE")
    )
    return features.group_frequency(routed, "ROUTE", "ROUTE_FREQUENCY")


@query("bin_features", f"WITH {FLIGHTS} SELECT FLIGHT_ID, {_BINS} FROM flights")
def _(spark, d):
    speed = F.try_divide(F.col("DISTANCE"), F.col("CRS_ELAPSED_TIME"))
    out = features.bin_features(flights(spark, d).withColumn("PLANNED_SPEED_MPM", speed))
    return out.select("FLIGHT_ID", "DISTANCE_CAT", "DURATION_CAT", "SPEED_CAT")


@query("interaction_features", f"WITH {FLIGHTS} SELECT FLIGHT_ID, {_INTERACT} FROM flights")
def _(spark, d):
    out = features.interaction_features(flights(spark, d))
    return out.select("FLIGHT_ID", *features.feature_columns_added()[-3:])


@query(
    "generate_features",
    f"""WITH {LABELLED}, {_ROUTES.format(src='labelled')}
SELECT FLIGHT_ID, ARR_DELAY, DELAY_CLASS, {_TEMPORAL}, ORIGIN || '_' || DEST AS ROUTE, ROUTE_FREQUENCY,
  {_SPEED} AS PLANNED_SPEED_MPM, {_BINS}, {_INTERACT}
FROM labelled LEFT JOIN freq ON ORIGIN || '_' || DEST = freq.ROUTE""",
)
def _(spark, d):
    out = features.generate_features(labelled_flights(spark, d))
    return out.select("FLIGHT_ID", "ARR_DELAY", "DELAY_CLASS", *features.feature_columns_added())


# --- encoding and scaling ---------------------------------------------------------------------

_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "one_hot",
    "SELECT o_orderkey, "
    + ", ".join(
        f"(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END)::TINYINT AS \"o_orderpriority_{p}\""
        for p in _PRIORITIES
    )
    + ", (CASE WHEN o_orderkey % 9 <> 0 AND o_orderstatus = 'F' THEN 1 ELSE 0 END)::TINYINT AS status_F"
    + ", (CASE WHEN o_orderkey % 9 <> 0 AND o_orderstatus = 'O' THEN 1 ELSE 0 END)::TINYINT AS status_O"
    + ", (CASE WHEN o_orderkey % 9 <> 0 AND o_orderstatus = 'P' THEN 1 ELSE 0 END)::TINYINT AS status_P"
    + ", (CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END)::TINYINT AS status_nan FROM orders",
)
def _(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")).alias("status"),
    )
    return encode.one_hot(o, ["o_orderpriority", "status"])


@query(
    "label_encode",
    f"""WITH {FLIGHTS}, rt AS (SELECT FLIGHT_ID, ORIGIN || '_' || DEST AS ROUTE, AIRLINE FROM flights),
codes AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code
          FROM (SELECT DISTINCT ROUTE AS v FROM rt WHERE ROUTE IS NOT NULL)),
air AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code FROM (SELECT DISTINCT AIRLINE AS v FROM rt))
SELECT FLIGHT_ID, codes.code AS ROUTE, air.code AS AIRLINE
FROM rt LEFT JOIN codes ON rt.ROUTE = codes.v LEFT JOIN air ON rt.AIRLINE = air.v""",
)
def _(spark, d):
    routed = flights(spark, d).select(
        "FLIGHT_ID", F.concat("ORIGIN", F.lit("_"), "DEST").alias("ROUTE"), "AIRLINE"
    )
    return encode.label_encode(routed, ["ROUTE", "AIRLINE"])


@query(
    "label_encode_ordered",
    f"""WITH {LABELLED} SELECT FLIGHT_ID, CASE DELAY_CLASS WHEN 'On-time' THEN 0 WHEN 'Short delay' THEN 1
    WHEN 'Long delay' THEN 2 END AS DELAY_CLASS FROM labelled""",
)
def _(spark, d):
    df = labelled_flights(spark, d).select("FLIGHT_ID", "DELAY_CLASS")
    ordered = encode.labels_in_order(df, ["On-time", "Short delay", "Long delay"])
    return encode.apply_labels(df, "DELAY_CLASS", ordered)


@query(
    "category_codes",
    f"""WITH {FLIGHTS}, codes AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code
  FROM (SELECT DISTINCT ORIGIN AS v FROM flights WHERE ORIGIN IS NOT NULL))
SELECT FLIGHT_ID, ORIGIN, coalesce(code, -1) AS label FROM flights LEFT JOIN codes ON ORIGIN = v""",
)
def _(spark, d):
    return encode.category_codes(flights(spark, d).select("FLIGHT_ID", "ORIGIN"), "ORIGIN", "label")


_SCALED = ["value", "wave", "grade", "flat"]
_FLAT = EVENTS + ",\nsc AS (SELECT event_id, value, wave, grade::DOUBLE AS grade, 3::DOUBLE AS flat FROM ev)"


def _z_sql(c: str, where: str = "") -> str:
    return sr(
        f"CASE WHEN (SELECT stddev_pop({c}) FROM sc {where}) = 0 THEN {c} - (SELECT avg({c}) FROM sc {where}) "
        f"ELSE ({c} - (SELECT avg({c}) FROM sc {where})) / (SELECT stddev_pop({c}) FROM sc {where}) END"
    )


def _mm_sql(c: str) -> str:
    return sr(
        f"CASE WHEN (SELECT max({c}) - min({c}) FROM sc) = 0 THEN {c} - (SELECT min({c}) FROM sc) "
        f"ELSE ({c} - (SELECT min({c}) FROM sc)) / (SELECT max({c}) - min({c}) FROM sc) END"
    )


def _scale_input(spark, d):
    return events(spark, d).select(
        "event_id", "value", "wave", F.col("grade").cast("double").alias("grade"), F.lit(3.0).alias("flat")
    )


@query(
    "standard_scale",
    f"WITH {_FLAT} SELECT event_id, " + ", ".join(f"{_z_sql(c)} AS {c}" for c in _SCALED) + " FROM sc",
)
def _(spark, d):
    return rounded_table(scale.scale(_scale_input(spark, d), "standard", _SCALED)[0])


@query(
    "minmax_scale",
    f"WITH {_FLAT} SELECT event_id, " + ", ".join(f"{_mm_sql(c)} AS {c}" for c in _SCALED) + " FROM sc",
)
def _(spark, d):
    return rounded_table(scale.scale(_scale_input(spark, d), "minmax", _SCALED)[0])


@query(
    "scale_both",
    f"WITH {_FLAT} SELECT event_id, "
    + ", ".join(f"{_z_sql(c)} AS {c}_z, {_mm_sql(c)} AS {c}_mm" for c in _SCALED)
    + " FROM sc",
)
def _(spark, d):
    z, mm, _ = scale.scale_both(_scale_input(spark, d), _SCALED)
    z = z.select("event_id", *[F.col(c).alias(f"{c}_z") for c in _SCALED])
    mm = mm.select("event_id", *[F.col(c).alias(f"{c}_mm") for c in _SCALED])
    return rounded_table(z.join(mm, "event_id"))


@query(
    "scale_parameters",
    f"WITH {_FLAT}\n"
    + union_all(
        [
            f"SELECT '{c}' AS feature, {sr(f'avg({c})')} AS mean, {sr(f'stddev_pop({c})')} AS sd, "
            f"{sr(f'min({c})')} AS min, {sr(f'max({c})')} AS max FROM sc"
            for c in _SCALED
        ]
    ),
)
def _(spark, d):
    return rounded_table(scale.fit_scaler(_scale_input(spark, d), _SCALED))


@query(
    "scale_apply_test_split",
    f"""WITH {EVENTS}, rk AS (SELECT event_id, value, wave,
      row_number() OVER (ORDER BY md5(event_id || '|42'), event_id) AS rn, count(*) OVER () AS n FROM ev),
sc AS (SELECT event_id, value, wave, rn <= ceil(n * 0.2::DOUBLE) AS is_test FROM rk)
SELECT event_id, {_z_sql("value", "WHERE NOT is_test")} AS value, {_z_sql("wave", "WHERE NOT is_test")} AS wave
FROM sc WHERE is_test""",
)
def _(spark, d):
    ev = events(spark, d).select("event_id", "value", "wave")
    parts = sampling.train_test_split(ev, ["event_id"])
    params = scale.fit_scaler(parts.where(F.col("split") == "train"), ["value", "wave"])
    test = parts.where(F.col("split") == "test").drop("split")
    return rounded_table(scale.apply_scaler(test, params))


# --- whole cleaning flow ----------------------------------------------------------------------

_KEEP = """SELECT * FROM flights WHERE CANCELLED = 0 AND DIVERTED = 0 AND ARR_DELAY IS NOT NULL"""
_BALANCED = f"""fl AS (SELECT * REPLACE (greatest(ARR_DELAY, 0) AS ARR_DELAY) FROM ({_KEEP})),
rk AS (SELECT *, ARR_DELAY > 0 AS late, row_number() OVER (PARTITION BY ARR_DELAY > 0
         ORDER BY md5(FLIGHT_ID || '|42'), FLIGHT_ID) AS rn FROM fl),
small AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM rk GROUP BY late)),
bal AS (SELECT * FROM rk WHERE rn <= (SELECT n FROM small)),
{_iqr_sql("bal", "DISTANCE", "dist")},
{_iqr_sql("bal", "CRS_ELAPSED_TIME", "ela")}"""


@query(
    "load_and_clean",
    f"""WITH {FLIGHTS}, {_BALANCED}
SELECT FLIGHT_ID, FL_DATE, AIRLINE, AIRLINE_CODE, ORIGIN, DEST, CRS_DEP_TIME,
  {sr(_iqr_value("CRS_ELAPSED_TIME", "ela"), 4)} AS CRS_ELAPSED_TIME,
  {sr(_iqr_value("DISTANCE", "dist"), 4)} AS DISTANCE, ARR_DELAY FROM bal""",
)
def _(spark, d):
    cleaned, _ = plan.load_and_clean(flights(spark, d), "FLIGHT_ID", balance_method="undersample")
    return rounded_table(cleaned, 4)


@query(
    "clean_summary",
    f"""WITH {FLIGHTS}, {_BALANCED}, counts AS (SELECT (SELECT count(*) FROM flights) AS rows_in,
  (SELECT count(*) FROM bal) AS rows_out)
SELECT rows_in, rows_out, rows_in - rows_out AS rows_removed,
  {sr("100::DOUBLE * (rows_in - rows_out) / rows_in", 4)} AS reduction_pct FROM counts""",
)
def _(spark, d):
    _, summary = plan.load_and_clean(flights(spark, d), "FLIGHT_ID", balance_method="undersample")
    return rounded_table(summary, 4)
