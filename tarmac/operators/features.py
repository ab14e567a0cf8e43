"""Calendar, route, bin and interaction features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import require_columns
from tarmac.functions.expr import cut, flag

# Months, hours and bin edges of the derived features.
HOLIDAY_MONTHS = [7, 8, 12]
MORNING = (6, 11)
AFTERNOON = (12, 17)
NIGHT_FROM, NIGHT_UNTIL = 18, 6
DISTANCE_BINS = ([0, 500, 1500, 10000], ["Short", "Medium", "Long"])
DURATION_BINS = ([0, 120, 360, 1200], ["Short", "Medium", "Long"])
SPEED_BINS = ([0, 5, 8, 15], ["Slow", "Normal", "Fast"])


def temporal_features(df: DataFrame, date: str = "FL_DATE", clock: str = "CRS_DEP_TIME") -> DataFrame:
    """Calendar parts, flags and departure period; the clock is an HHMM number."""
    require_columns(df, [date, clock])
    day = F.to_date(F.col(date))
    weekday = F.weekday(day)  # Monday is 0
    hour = F.floor(F.col(clock) / 100).cast("int")
    morning, afternoon = hour.between(*MORNING), hour.between(*AFTERNOON)
    night = (hour >= NIGHT_FROM) | (hour < NIGHT_UNTIL)
    return df.withColumns(
        {
            "MONTH": F.month(day),
            "DAY_OF_WEEK": weekday,
            "DAY_OF_YEAR": F.dayofyear(day),
            "QUARTER": F.quarter(day),
            "IS_WEEKEND": flag(weekday >= 5),
            "IS_HOLIDAY_SEASON": flag(F.month(day).isin(HOLIDAY_MONTHS)),
            "DEP_HOUR": hour,
            "MORNING_FLIGHT": flag(morning),
            "AFTERNOON_FLIGHT": flag(afternoon),
            "NIGHT_FLIGHT": flag(night),
            "TIME_PERIOD": F.when(morning, F.lit("Morning"))
            .when(afternoon, F.lit("Afternoon"))
            .when(night, F.lit("Night"))
            .otherwise(F.lit("Other")),
        }
    )


def group_frequency(df: DataFrame, column: str, output: str) -> DataFrame:
    """Add the number of rows that share the value; null has no frequency.

    Counted first and joined back, so a hot value is combined before the shuffle and the wide rows
    are not moved when the counts are small enough to broadcast.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("__value"))
        .agg(F.count(F.lit(1)).alias(output))
    )
    joined = df.join(counts, F.col(column) == F.col("__value"), "left")
    return joined.drop("__value")


def route_features(df: DataFrame, origin: str = "ORIGIN", dest: str = "DEST") -> DataFrame:
    """ROUTE, how often it is flown, and the planned speed."""
    require_columns(df, [origin, dest, "DISTANCE", "CRS_ELAPSED_TIME"])
    routed = df.withColumn("ROUTE", F.concat(F.col(origin), F.lit("_"), F.col(dest))).withColumn(
        "PLANNED_SPEED_MPM",
        F.try_divide(F.col("DISTANCE").cast("double"), F.col("CRS_ELAPSED_TIME").cast("double")),
    )
    return group_frequency(routed, "ROUTE", "ROUTE_FREQUENCY")


def bin_features(df: DataFrame) -> DataFrame:
    """Right-closed distance, duration and speed bins."""
    require_columns(df, ["DISTANCE", "CRS_ELAPSED_TIME", "PLANNED_SPEED_MPM"])
    return df.withColumns(
        {
            "DISTANCE_CAT": cut(F.col("DISTANCE"), *DISTANCE_BINS),
            "DURATION_CAT": cut(F.col("CRS_ELAPSED_TIME"), *DURATION_BINS),
            "SPEED_CAT": cut(F.col("PLANNED_SPEED_MPM"), *SPEED_BINS),
        }
    )


def interaction_features(df: DataFrame) -> DataFrame:
    """Product and squares of distance and planned duration."""
    require_columns(df, ["DISTANCE", "CRS_ELAPSED_TIME"])
    distance = F.col("DISTANCE").cast("double")
    elapsed = F.col("CRS_ELAPSED_TIME").cast("double")
    return df.withColumns(
        {
            "DISTANCE_x_ELAPSED_TIME": distance * elapsed,
            "DISTANCE_POW2": distance * distance,
            "ELAPSED_TIME_POW2": elapsed * elapsed,
        }
    )


def generate_features(df: DataFrame) -> DataFrame:
    """All derived features; the date itself is dropped."""
    return (
        df.transform(temporal_features)
        .transform(route_features)
        .transform(bin_features)
        .transform(interaction_features)
        .drop("FL_DATE")
    )


def feature_columns_added() -> Sequence[str]:
    return [
        "MONTH",
        "DAY_OF_WEEK",
        "DAY_OF_YEAR",
        "QUARTER",
        "IS_WEEKEND",
        "IS_HOLIDAY_SEASON",
        "DEP_HOUR",
        "MORNING_FLIGHT",
        "AFTERNOON_FLIGHT",
        "NIGHT_FLIGHT",
        "TIME_PERIOD",
        "ROUTE",
        "ROUTE_FREQUENCY",
        "PLANNED_SPEED_MPM",
        "DISTANCE_CAT",
        "DURATION_CAT",
        "SPEED_CAT",
        "DISTANCE_x_ELAPSED_TIME",
        "DISTANCE_POW2",
        "ELAPSED_TIME_POW2",
    ]
