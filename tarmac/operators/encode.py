"""One-hot indicators and alphabetical label codes, fitted once and reusable on new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import require_columns
from tarmac.session import materialize, parameter_table

#: Widest one-hot block that is spelled out as columns.
MAX_CATEGORIES = 1000
#: Dictionary entries that the driver may number and broadcast.
DICTIONARY_ROWS = 200_000


def _text(column: str):
    """Categories are text; a missing value is the category ``nan``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def fit_one_hot(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted categories per column, found in one pass over all columns.

    More than ``max_categories`` is an error, not a wider table.
    """
    require_columns(df, columns)
    distinct = _long_text(df, columns, missing="nan").distinct()
    sizes = {r["feature"]: r["n"] for r in distinct.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    wide = [c for c in columns if sizes.get(c, 0) > max_categories]
    if wide:
        raise ValueError(f"more than {max_categories} categories in {wide}; use one_hot_vectors or labels")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in distinct.collect():
        out[r["feature"]].append(r["value"])
    return {c: sorted(values) for c, values in out.items()}


def _long_text(df: DataFrame, columns: Sequence[str], missing: str | None = None) -> DataFrame:
    """``(feature, value)`` of text columns, missing values dropped or named."""
    cells = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
    )
    long = df.select(cells)
    return long.na.drop() if missing is None else long.na.fill(missing, ["value"])


def apply_one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """Replace each fitted column by tinyint indicators; an unseen category gives all zeros."""
    kept = [F.col(c) for c in df.columns if c not in categories]
    indicators = [
        (_text(name) == F.lit(v)).cast("tinyint").alias(f"{name}_{v}")
        for name, values in categories.items()
        for v in values
    ]
    return df.select(*kept, *indicators)


def one_hot(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> DataFrame:
    return apply_one_hot(df, fit_one_hot(df, columns, max_categories))


def fit_one_hot_vectors(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Dictionaries ``(value, code)`` of any size, a missing value being the category ``nan``."""
    return fit_label_sets(df.select(*[_text(c).alias(c) for c in columns]), columns)


def apply_one_hot_vectors(
    df: DataFrame, dictionaries: dict[str, DataFrame], suffix: str = "_vector"
) -> DataFrame:
    """Replace each column by a sparse indicator vector as long as its dictionary; an unseen category gives no
    entry."""
    for name, dictionary in dictionaries.items():
        width = dictionary.agg(F.coalesce(F.max("code") + 1, F.lit(0))).first()[0]
        coded = apply_labels(df.withColumn(name, _text(name)), name, dictionary)
        unknown = F.coalesce(F.col(name), F.lit(width)).cast("double")
        # the encoder leaves out the last number, which here stands for an unseen category
        numbers = df.sparkSession.range(width + 1).select(F.col("id").cast("double").alias(name))
        encoder = OneHotEncoder(inputCol=name, outputCol=f"{name}{suffix}", dropLast=True).fit(numbers)
        df = encoder.transform(coded.withColumn(name, unknown)).drop(name)
    return df


def one_hot_vectors(df: DataFrame, columns: Sequence[str], suffix: str = "_vector") -> DataFrame:
    """One-hot encoding for columns of any number of categories, as sparse vectors."""
    return apply_one_hot_vectors(df, fit_one_hot_vectors(df, columns), suffix)


def _numbered_by_range(values: DataFrame, parts: int) -> DataFrame:
    """``(value, code)`` of distinct values too many for one task.

    Sorted ranges are written first, so that their numbers cannot move between jobs.
    """
    ranged = materialize(
        values.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id())
    )
    offsets = parameter_table(
        ranged.groupBy("part")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn(
            "before", F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("c")
        )
        .select("part", "before")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return (
        ranged.withColumn("place", place)
        .join(offsets, "part")
        .select("value", (F.col("before") + F.col("place") - 1).cast("int").alias("code"))
    )


def fit_label_sets(
    df: DataFrame, columns: Sequence[str], max_rows: int = DICTIONARY_ROWS
) -> dict[str, DataFrame]:
    """Dictionary ``(value, code)`` per column, alphabetical from 0, from one pass over all columns.

    While the dictionaries are proven small the driver numbers them; larger ones are numbered by
    sorted ranges, column by column.
    """
    require_columns(df, columns)
    spark = df.sparkSession
    fetched = _long_text(df, columns).distinct().limit(max_rows + 1).toArrow()
    if fetched.num_rows <= max_rows:
        found: dict[str, list[str]] = {c: [] for c in columns}
        for feature, value in zip(fetched["feature"].to_pylist(), fetched["value"].to_pylist()):
            found[feature].append(value)
        return {
            c: F.broadcast(
                spark.createDataFrame(
                    [(v, i) for i, v in enumerate(sorted(values))], "value string, code int"
                )
            )
            for c, values in found.items()
        }
    out = {}
    for c in columns:
        values = _long_text(df, [c]).select("value").distinct()
        out[c] = _numbered_by_range(values, max(2, -(-values.count() // max_rows)))
    return out


def fit_labels(df: DataFrame, column: str, max_rows: int = DICTIONARY_ROWS) -> DataFrame:
    """Dictionary of one column."""
    return fit_label_sets(df, [column], max_rows)[column]


def labels_in_order(df: DataFrame, ordered: Sequence[str]) -> DataFrame:
    """Dictionary with a stated order, for categories whose rank matters."""
    return df.sparkSession.createDataFrame(
        [(v, i) for i, v in enumerate(ordered)], "value string, code int"
    )


def apply_labels(df: DataFrame, column: str, dictionary: DataFrame, output: str | None = None) -> DataFrame:
    """Swap a column for its codes; null and unseen values stay null."""
    output = output or column
    codes = dictionary.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    joined = df.join(codes, F.col(column).cast("string") == F.col("__value"), "left")
    if output not in df.columns:
        return joined.withColumnRenamed("__code", output).drop("__value")
    return joined.select(
        *[F.col("__code").alias(c) if c == output else F.col(c) for c in df.columns]
    )


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name, dictionary in fit_label_sets(df, columns).items():
        df = apply_labels(df, name, dictionary)
    return df


def category_codes(df: DataFrame, column: str, output: str) -> DataFrame:
    """Alphabetical code for colouring; a missing category is -1."""
    coded = apply_labels(df, column, fit_labels(df, column), output)
    return coded.withColumn(output, F.coalesce(F.col(output), F.lit(-1)))
