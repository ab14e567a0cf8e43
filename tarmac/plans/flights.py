"""The flight-delay flow: clean, label, profile, derive features, encode, scale, test and compare."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import numeric_columns, present
from tarmac.operators import clean, encode, hypothesis, models, profile, scale
from tarmac.operators.balance import balance
from tarmac.operators.features import generate_features, temporal_features
from tarmac.operators.reduce import pca, projection_points
from tarmac.operators.sampling import unique_key
from tarmac.session import materialize
from tarmac.sources.flights import (
    CODED_COLUMNS,
    DELAY_CLASS,
    LEAKAGE_COLUMNS,
    NOMINAL_COLUMNS,
    OUTLIER_COLUMNS,
    REDUNDANT_COLUMNS,
    STATUS_FLAGS,
    TARGET,
)


def valid_flights(df: DataFrame) -> DataFrame:
    """Flights that flew and have a known delay, without leakage columns, early arrivals at 0."""
    return (
        df.transform(clean.drop_flagged, STATUS_FLAGS)
        .transform(clean.drop_columns, LEAKAGE_COLUMNS)
        .transform(clean.drop_null, [TARGET])
        .transform(clean.clip_delay, TARGET)
    )


def load_and_clean(
    df: DataFrame, key: str, balance_method: str = "smote", seed: int = 42, copy_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cleaned table and a one-row account of the rows removed. ``copy_col`` as in ``oversample``.

    Balancing comes before outlier treatment, except that synthetic rows need complete numbers and so
    are made after it. The valid rows are written once, as every later step reads them again.
    """
    valid = materialize(valid_flights(df))
    if balance_method == "smote":
        treated = clean.treat_outliers_and_missing(valid, OUTLIER_COLUMNS)
        balanced = balance(treated, TARGET, key, balance_method, seed, copy_col)
    else:
        balanced = balance(valid, TARGET, key, balance_method, seed, copy_col)
        balanced = clean.treat_outliers_and_missing(balanced, OUTLIER_COLUMNS)
    cleaned = clean.drop_columns(balanced, REDUNDANT_COLUMNS)
    before = df.agg(F.count(F.lit(1)).alias("rows_in")).withColumn("one", F.lit(1))
    after = cleaned.agg(F.count(F.lit(1)).alias("rows_out")).withColumn("one", F.lit(1))
    removed = F.col("rows_in") - F.col("rows_out")
    summary = before.join(after, "one").select(
        "rows_in",
        "rows_out",
        removed.alias("rows_removed"),
        F.try_divide(removed * F.lit(100.0), F.col("rows_in")).alias("reduction_pct"),
    )
    return cleaned, summary


def delay_profile(df: DataFrame) -> DataFrame:
    """Descriptive statistics of delay, distance and duration per delay class."""
    labelled = clean.classify_delay(valid_flights(df), TARGET)
    return profile.describe(labelled, ["ARR_DELAY", "DISTANCE", "CRS_ELAPSED_TIME"], by=DELAY_CLASS)


def explore(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """Analytical report and principal components of a labelled table."""
    columns = numeric_columns(df, exclude=[key])
    report = profile.analytical_report(df, columns, DELAY_CLASS)
    features = [c for c in columns if c != TARGET]
    report["pca"] = pca(df, features, [key])
    report["projection"] = projection_points(df, features, [key], TARGET)
    return report


def engineer(
    df: DataFrame, scale_method: str = "standard", key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Features, one-hot and label codes, scaled numbers; also the fitted scaling parameters. The key is not scaled."""
    featured = generate_features(df)
    encoded = encode.one_hot(featured, present(featured, NOMINAL_COLUMNS))
    encoded = encode.label_encode(encoded, present(encoded, CODED_COLUMNS))
    exclude = [*scale.DEFAULT_EXCLUDE, *([key] if key else [])]
    return scale.scale(encoded, scale_method, exclude=exclude)


def named_tests(raw: DataFrame) -> dict[str, DataFrame]:
    """The two stated questions, asked of flights before leakage columns go and categories are coded."""
    flown = clean.drop_flagged(raw, STATUS_FLAGS)
    reports = {"delay_by_airline": hypothesis.airline_delay_test(flown)}
    reports["delay_by_time_of_day"] = hypothesis.time_of_day_test(temporal_features(flown))
    return reports


def run_all(
    raw: DataFrame, key: str, balance_method: str = "undersample", seed: int = 42
) -> dict[str, DataFrame]:
    """Every report of the flow, as lazy tables except for the model scores."""
    cleaned, summary = load_and_clean(raw, key, balance_method, seed, copy_col="__copy_no")
    # folds, samples and neighbours need a key that copies do not share
    cleaned = unique_key(cleaned, key, "__copy_no").drop("__copy_no")
    labelled = clean.classify_delay(cleaned, TARGET).persist(StorageLevel.MEMORY_AND_DISK)
    reports = {"summary": summary, "cleaned": labelled, **explore(labelled, key)}
    engineered, params = engineer(labelled, key=key)
    engineered = engineered.persist(StorageLevel.MEMORY_AND_DISK)
    reports["features"], reports["scaling"] = engineered, params
    battery = hypothesis.run_battery(engineered, DELAY_CLASS, [key])
    reports.update(battery)
    reports.update(named_tests(raw))
    reports.update(models.run_model_selection(engineered, DELAY_CLASS, key, seed=seed))
    return reports
