"""Z-score and min-max scaling with a reusable parameter table.

Population standard deviation; a constant column scales to 0; missing values are ignored while
fitting and stay missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import numeric_columns, wide_to_long
from tarmac.session import parameter_table

DEFAULT_EXCLUDE = ("ARR_DELAY", "DELAY_CLASS")


def scalable_columns(df: DataFrame, exclude: Sequence[str] = DEFAULT_EXCLUDE) -> list[str]:
    return numeric_columns(df, exclude)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, mean, sd, min, max)``, all columns in one aggregate."""
    aggregates = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [
            F.avg(x).alias(f"a{i}"),
            F.stddev_pop(x).alias(f"s{i}"),
            F.min(x).alias(f"l{i}"),
            F.max(x).alias(f"h{i}"),
        ]
    wide = df.agg(*aggregates)
    return parameter_table(
        wide_to_long(
            wide,
            [],
            {
                c: {
                    "mean": F.col(f"a{i}"),
                    "sd": F.col(f"s{i}"),
                    "min": F.col(f"l{i}"),
                    "max": F.col(f"h{i}"),
                }
                for i, c in enumerate(columns)
            },
        )
    )


def _scaled(column: str, shift: float | None, width: float | None) -> Column:
    x = F.col(column).cast("double")
    if shift is None:
        return F.lit(None).cast("double")
    if not width:
        return F.when(x.isNotNull(), x - F.lit(shift))
    return (x - F.lit(shift)) / F.lit(width)


def apply_scaler(df: DataFrame, params: DataFrame, method: str = "standard") -> DataFrame:
    """Scale the fitted columns of any table; the parameters hold one row per column."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method {method!r}")
    fitted = {}
    for r in params.collect():
        if method == "standard":
            fitted[r["feature"]] = (r["mean"], r["sd"])
        else:
            span = None if r["min"] is None else r["max"] - r["min"]
            fitted[r["feature"]] = (r["min"], span)
    return df.select(
        *[_scaled(c, *fitted[c]).alias(c) if c in fitted else F.col(c) for c in df.columns]
    )


def scale(
    df: DataFrame,
    method: str = "standard",
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = DEFAULT_EXCLUDE,
    fit_on: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scaled table and its parameters. ``both`` returns the z-scores; the parameters serve either.

    ``fit_on`` fits on another table, such as the training part alone.
    """
    if method not in ("standard", "minmax", "both"):
        raise ValueError(f"unknown scaling method {method!r}")
    columns = list(columns) if columns is not None else scalable_columns(df, exclude)
    params = fit_scaler(fit_on if fit_on is not None else df, columns)
    return apply_scaler(df, params, "standard" if method == "both" else method), params


def scale_both(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = DEFAULT_EXCLUDE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Z-scored table, min-max table and the shared parameters, from one fit."""
    columns = list(columns) if columns is not None else scalable_columns(df, exclude)
    params = fit_scaler(df, columns)
    return apply_scaler(df, params, "standard"), apply_scaler(df, params, "minmax"), params
