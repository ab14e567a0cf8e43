"""Column roles resolved from the schema; only metadata is read."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns in schema order; booleans are not numeric."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")


def as_double(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project ``keep`` plus ``columns`` cast to double."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])


def melt(
    df: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    feature: str = "feature",
    value: str = "value",
) -> DataFrame:
    """Long form ``(keep..., feature, value)`` with missing values left out."""
    return (
        as_double(df, columns, keep)
        .unpivot(list(keep), list(columns), feature, value)
        .where(F.col(value).isNotNull())
    )


def wide_to_long(
    wide: DataFrame, keep: Sequence[str], fields: dict[str, dict[str, Column]], feature: str = "feature"
) -> DataFrame:
    """Turn one wide row into one row per feature; ``fields[feature][name]`` gives each value."""
    rows = [
        F.struct(F.lit(name).alias(feature), *[c.alias(k) for k, c in cols.items()])
        for name, cols in fields.items()
    ]
    return wide.select(*keep, F.inline(F.array(*rows)))
