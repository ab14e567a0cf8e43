"""Access to the given tables, the flight-shaped view over them, and SQL fragments.

The view is defined twice, with integer arithmetic only, so that both engines build the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.expr import rounded
from tarmac.functions.special import CENTRAL, FAR, MIDDLE
from tarmac.sources.tables import read_parquet, spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet", nan_is_missing=False)


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a few missing values and two derived numbers."""
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.when(F.col("event_id") % 19 != 0, F.col("value")).alias("value"),
        (F.col("event_id") * 7 % 101).cast("double").alias("wave"),
        F.when(F.col("event_id") % 23 != 0, F.col("user_id") % 5).cast("long").alias("grade"),
    )


EVENTS = """ev AS (
  SELECT event_id, user_id, event_type,
         CASE WHEN event_id % 19 <> 0 THEN value END AS value,
         (event_id * 7 % 101)::DOUBLE AS wave,
         CASE WHEN event_id % 23 <> 0 THEN user_id % 5 END::BIGINT AS grade
  FROM events)"""


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with missing prices for every 17th part."""
    li = table(spark, folder, "lineitem")
    return li.select(
        "l_returnflag",
        "l_quantity",
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_extendedprice")).alias("price"),
        "l_discount",
        "l_tax",
    )


PRICES = """pr AS (
  SELECT l_returnflag, l_quantity,
         CASE WHEN l_partkey % 17 <> 0 THEN l_extendedprice END AS price,
         l_discount, l_tax
  FROM lineitem)"""


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """Line items seen as flight records; FLIGHT_ID is a text key built from whole numbers."""
    li = spread(table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"])
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    key, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    days = F.datediff(F.to_date("l_shipdate"), F.to_date(F.lit("1995-01-01")))
    delay = ((days * 7 + line * 11 + part) % 97 - 40).cast("double")
    cancelled, diverted = key % 50 == 0, key % 71 == 0
    return joined.select(
        F.concat_ws(
            "-", key, line, part, "l_suppkey", F.col("l_quantity").cast("int"),
            F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5)),
        ).alias("FLIGHT_ID"),
        F.to_date("l_shipdate").alias("FL_DATE"),
        F.col("o_orderpriority").alias("AIRLINE"),
        F.substring("o_orderpriority", 1, 1).alias("AIRLINE_CODE"),
        F.concat(F.lit("D"), F.col("o_orderstatus")).alias("AIRLINE_DOT"),
        (part % 100).cast("int").alias("DOT_CODE"),
        (key % 5000).cast("int").alias("FL_NUMBER"),
        F.when(key % 41 != 0, F.concat(F.lit("N"), F.col("c_nationkey"))).alias("ORIGIN"),
        F.concat(F.lit("City "), F.col("c_nationkey")).alias("ORIGIN_CITY"),
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("DEST"),
        F.concat(F.lit("City "), F.col("s_nationkey")).alias("DEST_CITY"),
        ((part % 24) * 100 + key % 60).cast("int").alias("CRS_DEP_TIME"),
        F.when(part % 29 != 0, 30 + 6 * F.col("l_quantity")).cast("double").alias("CRS_ELAPSED_TIME"),
        (F.when(part % 97 == 0, 10.0).otherwise(1.0) * F.col("l_extendedprice") / 20).alias("DISTANCE"),
        F.when((part % 37 != 0) & ~cancelled & ~diverted, delay).alias("ARR_DELAY"),
        (delay + F.col("l_suppkey") % 13 - 6).cast("double").alias("DEP_DELAY"),
        F.when(cancelled, 1.0).otherwise(0.0).alias("CANCELLED"),
        F.when(cancelled, F.lit("B")).alias("CANCELLATION_CODE"),
        F.when(key % 83 == 0, F.lit(None)).when(diverted, 1.0).otherwise(0.0).alias("DIVERTED"),
        (F.col("l_suppkey") % 30).cast("double").alias("TAXI_OUT"),
        (30 + 5 * F.col("l_quantity")).cast("double").alias("AIR_TIME"),
    )


FLIGHTS = """base AS (
  SELECT *, ((date_diff('day', DATE '1995-01-01', l_shipdate::DATE) * 7 + l_linenumber * 11 + l_partkey)
             % 97 - 40)::DOUBLE AS delay
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
flights AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INTEGER,
                   floor(l_extendedprice * 100 + 0.5::DOUBLE)::BIGINT) AS FLIGHT_ID,
         l_shipdate::DATE AS FL_DATE,
         o_orderpriority AS AIRLINE,
         substr(o_orderpriority, 1, 1) AS AIRLINE_CODE,
         'D' || o_orderstatus AS AIRLINE_DOT,
         (l_partkey % 100)::INTEGER AS DOT_CODE,
         (l_orderkey % 5000)::INTEGER AS FL_NUMBER,
         CASE WHEN l_orderkey % 41 <> 0 THEN 'N' || c_nationkey END AS ORIGIN,
         'City ' || c_nationkey AS ORIGIN_CITY,
         'N' || s_nationkey AS DEST,
         'City ' || s_nationkey AS DEST_CITY,
         ((l_partkey % 24) * 100 + l_orderkey % 60)::INTEGER AS CRS_DEP_TIME,
         CASE WHEN l_partkey % 29 <> 0 THEN (30 + 6 * l_quantity)::DOUBLE END AS CRS_ELAPSED_TIME,
         CASE WHEN l_partkey % 97 = 0 THEN 10::DOUBLE ELSE 1::DOUBLE END * l_extendedprice / 20 AS DISTANCE,
         CASE WHEN l_partkey % 37 <> 0 AND l_orderkey % 50 <> 0 AND l_orderkey % 71 <> 0
              THEN delay END AS ARR_DELAY,
         (delay + l_suppkey % 13 - 6)::DOUBLE AS DEP_DELAY,
         CASE WHEN l_orderkey % 50 = 0 THEN 1::DOUBLE ELSE 0::DOUBLE END AS CANCELLED,
         CASE WHEN l_orderkey % 50 = 0 THEN 'B' END AS CANCELLATION_CODE,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 71 = 0 THEN 1::DOUBLE
              ELSE 0::DOUBLE END AS DIVERTED,
         (l_suppkey % 30)::DOUBLE AS TAXI_OUT,
         (30 + 5 * l_quantity)::DOUBLE AS AIR_TIME
  FROM base)"""

#: Flights that flew and have a known delay, clipped at 0 and classed.
LABELLED = (
    FLIGHTS
    + """,
labelled AS (
  SELECT * REPLACE (greatest(ARR_DELAY, 0) AS ARR_DELAY),
         CASE WHEN ARR_DELAY < 15 THEN 'On-time' WHEN ARR_DELAY <= 30 THEN 'Short delay'
              WHEN ARR_DELAY > 30 THEN 'Long delay' ELSE 'Unknown' END AS DELAY_CLASS
  FROM flights
  WHERE CANCELLED = 0 AND DIVERTED = 0 AND ARR_DELAY IS NOT NULL)"""
)


def labelled_flights(spark: SparkSession, folder: str) -> DataFrame:
    from tarmac.operators.clean import classify_delay, clip_delay, drop_flagged, drop_null

    return (
        flights(spark, folder)
        .transform(drop_flagged, ["CANCELLED", "DIVERTED"])
        .transform(drop_null, ["ARR_DELAY"])
        .transform(clip_delay, "ARR_DELAY")
        .transform(classify_delay, "ARR_DELAY")
    )


def r(name: str, digits: int = 6) -> Column:
    return rounded(F.col(name), digits).alias(name)


def rounded_table(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double rounded, so that summation order cannot show."""
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[r(c, digits) if c in doubles else F.col(c) for c in df.columns])


def sr(expression: str, digits: int = 6) -> str:
    """SQL for a rounded double without a negative zero."""
    return f"(round(({expression})::DOUBLE, {digits}) + 0::DOUBLE)"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def long_sql(source: str, columns: list[str], keep: str = "") -> str:
    """``(keep, feature, value)`` rows of the known values."""
    lead = f"{keep}, " if keep else ""
    return union_all(
        [
            f"SELECT {lead}'{c}' AS feature, {c}::DOUBLE AS value FROM {source} WHERE {c} IS NOT NULL"
            for c in columns
        ]
    )


# --- tail probabilities by Simpson's rule, an independent route to the same p-values ------------

_SIMPSON = "(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"


def _integral(upper: str, integrand: str) -> str:
    """Integral of ``integrand`` (in u) from 0 to ``upper``."""
    return (
        f"(SELECT sum({_SIMPSON} * ({integrand})) * ({upper}) / 12000.0 "
        f"FROM (SELECT i, i * ({upper}) / 4000.0 AS u FROM range(4001) t(i)))"
    )


def sql_chi2_p(h: str, df: str) -> str:
    body = f"2 * pow(u, {df} - 1) * exp(-u * u / 2)"
    return f"(1 - {_integral(f'sqrt({h})', body)} / (pow(2, {df} / 2.0) * exp(lgamma({df} / 2.0))))"


def sql_t_p(t: str, df: str) -> str:
    body = f"pow(cos(u), {df} - 1)"
    c = f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt(pi())"
    return f"(1 - 2 * {c} * {_integral(f'atan(abs({t}) / sqrt({df}))', body)})"


def sql_f_p(f: str, df1: str, df2: str) -> str:
    body = f"2 * pow(sin(u), {df1} - 1) * pow(cos(u), {df2} - 1)"
    c = f"exp(lgamma(({df1} + {df2}) / 2.0) - lgamma({df1} / 2.0) - lgamma({df2} / 2.0))"
    # the density is negligible beyond the second bound, which keeps the steps fine for a huge F
    upper = f"least(atan(sqrt({df1} * {f} / {df2})), sqrt(({df1} + 400) / {df2}))"
    return f"(1 - {c} * {_integral(upper, body)})"


def sql_normal_upper(z: str) -> str:
    body = "exp(-u * u / 2)"
    return (
        f"(CASE WHEN {z} >= 0 THEN 0.5 - {_integral(f'least({z}, 40)', body)} / sqrt(2 * pi()) "
        f"ELSE 0.5 + {_integral(f'least(-({z}), 40)', body)} / sqrt(2 * pi()) END)"
    )


def _ratio_sql(coefficients: tuple[list[float], list[float]], x: str) -> str:
    def horner(terms: list[float]) -> str:
        out = f"({terms[-1]!r}::DOUBLE)"
        for c in reversed(terms[:-1]):
            out = f"({out} * {x} + {c!r}::DOUBLE)"
        return out

    return f"{horner(coefficients[0])} / {horner(coefficients[1])}"


def sql_normal_quantile(p: str) -> str:
    """Standard normal quantile; ``p`` should be a plain column, as it is repeated."""
    tail = f"sqrt(-ln(least({p}, 1 - {p})))"
    return (
        f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {_ratio_sql(CENTRAL, f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))')} "
        f"ELSE sign({p} - 0.5) * CASE WHEN {tail} <= 5 THEN {_ratio_sql(MIDDLE, f'({tail} - 1.6)')} "
        f"ELSE {_ratio_sql(FAR, f'({tail} - 5.0)')} END END"
    )
