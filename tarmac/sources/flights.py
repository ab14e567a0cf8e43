"""Column roles and schema of a flight-record table."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names a flight-record file carries, by role.
TARGET = "ARR_DELAY"
DELAY_CLASS = "DELAY_CLASS"
STATUS_FLAGS = ["CANCELLED", "DIVERTED"]
STATUS_COLUMNS = ["CANCELLED", "CANCELLATION_CODE", "DIVERTED"]
LEAKAGE_COLUMNS = [
    "DEP_DELAY",
    "DELAY_DUE_CARRIER",
    "DELAY_DUE_WEATHER",
    "DELAY_DUE_NAS",
    "DELAY_DUE_SECURITY",
    "DELAY_DUE_LATE_AIRCRAFT",
    "ARR_TIME",
    "DEP_TIME",
    "WHEELS_OFF",
    "WHEELS_ON",
    "TAXI_OUT",
    "TAXI_IN",
    "ELAPSED_TIME",
    "AIR_TIME",
    "CANCELLED",
    "CANCELLATION_CODE",
    "DIVERTED",
]
REDUNDANT_COLUMNS = ["FL_NUMBER", "ORIGIN_CITY", "DEST_CITY", "AIRLINE_DOT", "DOT_CODE"]
OUTLIER_COLUMNS = ["DISTANCE", "CRS_ELAPSED_TIME"]
NOMINAL_COLUMNS = ["AIRLINE", "AIRLINE_CODE", "TIME_PERIOD"]
CODED_COLUMNS = ["DISTANCE_CAT", "DURATION_CAT", "SPEED_CAT", "DELAY_CLASS", "ROUTE"]

FLIGHT_DDL = (
    "FL_DATE date, AIRLINE string, AIRLINE_DOT string, AIRLINE_CODE string, DOT_CODE int, "
    "FL_NUMBER int, ORIGIN string, ORIGIN_CITY string, DEST string, DEST_CITY string, "
    "CRS_DEP_TIME int, CRS_ELAPSED_TIME double, DISTANCE double, ARR_DELAY double, "
    "DEP_DELAY double, DELAY_DUE_CARRIER double, DELAY_DUE_WEATHER double, DELAY_DUE_NAS double, "
    "DELAY_DUE_SECURITY double, DELAY_DUE_LATE_AIRCRAFT double, ARR_TIME double, "
    "DEP_TIME double, WHEELS_OFF double, WHEELS_ON double, TAXI_OUT double, TAXI_IN double, "
    "ELAPSED_TIME double, AIR_TIME double, CANCELLED double, CANCELLATION_CODE string, "
    "DIVERTED double"
)


def flight_schema() -> T.StructType:
    """Schema of a raw flight-record file; needs an active session."""
    return T.StructType.fromDDL(FLIGHT_DDL)
