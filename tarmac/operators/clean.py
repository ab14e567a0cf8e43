"""Row filters, column drops, target treatment and imputation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import numeric_columns, present, require_columns
from tarmac.functions.expr import clip_lower
from tarmac.operators.quantiles import column_quantiles
from tarmac.session import materialize, parameter_row

#: Counters of a column's frequent values in a task.
FREQUENT_VALUES = 1024
#: Cells of the filter that rows without a possible copy do not pass; at most so many numbers are broadcast.
SUSPECT_CELLS = 1 << 20


def drop_flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Keep rows on which every flag is 0; a missing flag drops the row."""
    require_columns(df, flags)
    for name in flags:
        df = df.where(F.col(name) == 0)
    return df


def drop_columns(df: DataFrame, columns: Sequence[str], ignore_missing: bool = True) -> DataFrame:
    if not ignore_missing:
        require_columns(df, columns)
    return df.drop(*present(df, columns))


def drop_null(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One row of every set of identical rows; null equals null.

    Rows without a possible copy are not shuffled (``suspected_copies``)."""
    alone, suspects = suspected_copies(df)
    return suspects.distinct() if alone is None else alone.unionByName(suspects.distinct())


def fingerprint(df: DataFrame) -> Column:
    """128 bits of a row, the same for rows that are equal: nulls count by place, -0.0 as 0.0, NaN as NaN. Nested columns
    do not take part, so rows may also share them by chance or by their flat columns alone."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(c == 0, F.lit(0.0)).when(F.isnan(c), F.lit(float("nan"))).otherwise(c)
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) and type(f.dataType).__name__ != "VariantType":
            parts += [c.isNull(), c]
    parts = parts or [F.lit(0)]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def suspected_copies(df: DataFrame, mark: Callable[[DataFrame], Column] = fingerprint) -> tuple[DataFrame | None, DataFrame]:
    """The rows that have no copy for sure, and those that may have one, which are to be compared whole.

    Fingerprints are counted, and those met twice set cells of a filter of ``SUSPECT_CELLS``; a row is suspect if
    its fingerprint falls into such a cell. With so many copies that most cells are set nearly all rows are suspect,
    which costs what comparing all rows does. Tables of few columns are all suspect: their rows are hardly wider
    than a fingerprint.
    """
    if len(df.columns) <= 4:
        return None, df
    counted = df.select(mark(df).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    cell = F.pmod(F.xxhash64("mark"), F.lit(SUSPECT_CELLS))
    cells = materialize(counted.where("n > 1").select(cell.alias("cell")).distinct())
    rows = df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("row"), F.pmod(F.xxhash64(mark(df)), F.lit(SUSPECT_CELLS)).alias("cell"))
    # at most SUSPECT_CELLS numbers
    cells = F.broadcast(cells)
    return rows.join(cells, "cell", "left_anti").select("row.*"), rows.join(cells, "cell", "left_semi").select("row.*")


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Feature frame and target frame of one table."""
    require_columns(df, [target])
    return df.drop(target), df.select(target)


def clip_delay(df: DataFrame, column: str) -> DataFrame:
    """Early arrivals count as no delay."""
    require_columns(df, [column])
    return df.withColumn(column, clip_lower(F.col(column), 0.0))


def clipped_count(df: DataFrame, column: str) -> DataFrame:
    """How many rows ``clip_delay`` would change."""
    require_columns(df, [column])
    return df.select(F.count_if(F.col(column) < 0).alias("clipped_rows"))


def delay_class(column: Column) -> Column:
    """Three delay classes; a missing delay is 'Unknown'."""
    # Class boundaries in minutes.
    short_from, short_to = 15, 30
    return (
        F.when(column < short_from, F.lit("On-time"))
        .when(column <= short_to, F.lit("Short delay"))
        .when(column > short_to, F.lit("Long delay"))
        .otherwise(F.lit("Unknown"))
    )


def classify_delay(df: DataFrame, column: str, output: str = "DELAY_CLASS") -> DataFrame:
    require_columns(df, [column])
    return df.withColumn(output, delay_class(F.col(column)))


def feature_matrix(df: DataFrame, target: str, also_exclude: Sequence[str] = ("ARR_DELAY",)) -> DataFrame:
    """Target plus every numeric feature as a double, missing set to 0."""
    require_columns(df, [target])
    features = numeric_columns(df, exclude=[target, *also_exclude])
    if not features:
        raise ValueError("no numeric feature columns")
    return df.select(
        target, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    )


# --- missing values ---------------------------------------------------------------------------


def _fill_with(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill each listed column with its fitted value; a mean turns a whole-number column into doubles."""
    out = []
    for f in df.schema.fields:
        if values.get(f.name) is None:
            out.append(F.col(f.name))
            continue
        value = values[f.name]
        keep_type = not (isinstance(f.dataType, T.IntegralType) and isinstance(value, float))
        dtype = f.dataType if keep_type else T.DoubleType()
        out.append(
            F.coalesce(F.col(f.name).cast(dtype), F.lit(value).cast(dtype)).alias(f.name)
        )
    return df.select(*out)


def incomplete_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Mean of every column that has missing values, in one aggregate; complete columns are None."""
    if not columns:
        return {}
    has_gap = [F.count(c) < F.count(F.lit(1)) for c in columns]
    return parameter_row(
        df.agg(
            *[
                F.when(gap, F.avg(F.col(c).cast("double"))).alias(c)
                for c, gap in zip(columns, has_gap)
            ]
        )
    )


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of every column with missing values, the smallest one on a tie.

    Tasks keep summaries of their most frequent values, whose counts are too low by a known amount at most. Where
    a value stands out from all that the summaries may have lost, the few values that can be the mode are counted
    exactly (not again if nothing was lost). A column without such a value is counted by all its different values.
    """
    out: dict[str, object] = {}
    if not columns:
        return out
    gaps = parameter_row(df.agg(*[(F.count(c) < F.count(F.lit(1))).alias(c) for c in columns]))
    open_columns = [c for c in columns if gaps[c]]
    if not open_columns:
        return out
    types = {c: df.schema[c].dataType for c in open_columns}
    text, rest = _frequent_modes(df, open_columns, types)
    if rest:
        text |= _best_of(_cells(df, rest, types).groupBy("column", "text", "number").agg(F.count(F.lit(1)).alias("n_rows_")))
    typed = df.sparkSession.range(1).select(
        *[F.lit(text.get(c)).cast(types[c]).alias(f"c{i}") for i, c in enumerate(open_columns)]
    )
    found = typed.first()
    return {c: found[i] for i, c in enumerate(open_columns)}


def _cells(df: DataFrame, columns: Sequence[str], types: dict[str, T.DataType]) -> DataFrame:
    """``(column, text, number)`` of every known cell."""

    def number(c: str) -> Column:
        numeric = isinstance(types[c], (T.NumericType, T.BooleanType))
        return F.col(c).cast("double") if numeric else F.lit(None).cast("double")

    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), number(c).alias("number")) for c in columns
    ]
    return df.select(F.inline(F.array(*cells))).where(F.col("text").isNotNull())


def _best_of(counted: DataFrame) -> dict[str, str]:
    best = counted.groupBy("column").agg(F.min(F.struct(-F.col("n_rows_"), "number", "text")).alias("best"))
    return {r["column"]: r["best"]["text"] for r in best.collect()}


class _Summaries:
    """Frequent values of each column of a task: at most ``FREQUENT_VALUES`` counters. When there are more, all lose as
    much as the first one that has no room, and so does the count of any value left out; the sum of these losses is
    handed on with a null text."""

    def __init__(self, columns: Sequence[str], most: int):
        self.columns, self.most = list(columns), most

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[dict] = [{} for _ in self.columns]
        lost = [0] * len(self.columns)
        for batch in batches:
            for i in range(len(self.columns)):
                held = counts[i]
                found = batch.column(i).drop_null().value_counts()
                for value, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                    held[value] = held.get(value, 0) + n
                if len(held) > self.most:
                    taken = sorted(held.values(), reverse=True)[self.most]
                    counts[i] = {v: n - taken for v, n in held.items() if n > taken}
                    lost[i] += taken
        for name, held, loss in zip(self.columns, counts, lost):
            texts, numbers = [*held, None], [*held.values(), loss]
            yield pa.record_batch([pa.array([name] * len(texts)), pa.array(texts, pa.string()), pa.array(numbers, pa.int64())], names=["column", "text", "n"])


def _frequent_modes(df: DataFrame, columns: Sequence[str], types: dict[str, T.DataType]) -> tuple[dict[str, str], list[str]]:
    """Modes that the summaries prove, and the columns that are left."""
    names = [f"c{i}" for i in range(len(columns))]
    texts = df.select(*[F.col(c).cast("string").alias(n) for c, n in zip(columns, names)])
    summed = texts.mapInArrow(_Summaries(names, FREQUENT_VALUES), "column string, text string, n long")
    summed = materialize(summed.groupBy("column", "text").agg(F.sum("n").alias("n")))
    known = F.col("text").isNotNull()
    tops = summed.groupBy("column").agg(F.max(F.when(known, F.col("n"))).alias("top"), F.max(F.when(~known, F.col("n"))).alias("lost"))
    # a value that is missing here or lies further below the top than the loss cannot reach it
    possible = summed.join(F.broadcast(tops), "column").where(known & (F.col("n") + F.col("lost") >= F.col("top")) & (F.col("top") > F.col("lost")))
    sizes = {r["column"]: (r["size"], r["lost"]) for r in possible.groupBy("column", "lost").agg(F.count(F.lit(1)).alias("size")).collect()}
    proven = [n for n in names if n in sizes and sizes[n][0] <= FREQUENT_VALUES]
    rest = [c for c, n in zip(columns, names) if n not in proven and n in {r["column"] for r in tops.where("top IS NOT NULL OR lost > 0").collect()}]
    if not proven:
        return {}, rest
    of = dict(zip(names, columns))
    listed = possible.where(F.col("column").isin(proven)).select("column", "text", "n")
    # at most FREQUENT_VALUES texts of a column
    cells = _cells(df, [of[n] for n in proven], types)
    by_name = F.element_at(F.create_map(*[x for n in proven for x in (F.lit(n), F.lit(of[n]))]), F.col("column"))
    listed = listed.withColumn("column", by_name)
    if any(sizes[n][1] for n in proven):
        counted = cells.join(F.broadcast(listed.drop("n")), ["column", "text"])
        counted = counted.groupBy("column", "text", "number").agg(F.count(F.lit(1)).alias("n_rows_"))
    else:
        numeric = [of[n] for n in proven if isinstance(types[of[n]], (T.NumericType, T.BooleanType))]
        value = F.when(F.col("text").isin("true", "false"), (F.col("text") == "true").cast("double")).otherwise(F.expr("try_cast(text AS double)"))
        number = F.when(F.col("column").isin(numeric), value) if numeric else F.lit(None).cast("double")
        counted = listed.select("column", "text", number.alias("number"), F.col("n").alias("n_rows_"))
    return _best_of(counted), rest


def fill_missing(df: DataFrame, strategy: str = "mean", value: object = None) -> DataFrame:
    """Impute by column mean, median, mode or a constant; columns without gaps are left alone.

    A constant goes to every column whose type can hold it (strings take text, numbers take numbers).
    """
    if strategy not in ("mean", "median", "mode", "constant"):
        raise ValueError("strategy must be 'mean', 'median', 'mode' or 'constant'")
    if strategy == "mean":
        return _fill_with(df, incomplete_means(df, numeric_columns(df)))
    if strategy == "median":
        columns = [c for c, m in incomplete_means(df, numeric_columns(df)).items() if m is not None]
        if not columns:
            return df
        found = column_quantiles(df, columns, [0.5]).collect()
        return _fill_with(df, {r["feature"]: float(r["quantiles"][0]) for r in found})
    if strategy == "mode":
        return _fill_with(df, column_modes(df, df.columns))
    if value is None:
        raise ValueError("a constant fill needs a value")
    return df.na.fill(value)


def handle_missing(df: DataFrame, method: str = "drop", value: object = None) -> DataFrame:
    if method not in ("drop", "fill"):
        raise ValueError("method must be 'drop' or 'fill'")
    if method == "drop":
        return df.na.drop()
    if value is None:
        raise ValueError("method 'fill' needs a value")
    return df.na.fill(value)


# --- outliers ---------------------------------------------------------------------------------


def iqr_fences(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, extent: DataFrame | None = None
) -> dict[str, tuple[float, float]]:
    """Lower and upper fence per column, from exact quartiles (one row per column on the driver)."""
    rows = column_quantiles(df, columns, [0.25, 0.75], extent=extent).collect()
    fences = {}
    for r in rows:
        q1, q3 = r["quantiles"]
        fences[r["feature"]] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return fences


def replace_outliers_iqr(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, extent: DataFrame | None = None
) -> DataFrame:
    """Values beyond the fences, and missing ones, become the mean of the values inside."""
    columns = present(df, columns)
    if not columns:
        return df
    fences = iqr_fences(df, columns, k, extent)
    inside = {
        c: F.when(F.col(c).cast("double").between(*fences[c]), F.col(c).cast("double"))
        for c in columns
        if c in fences
    }
    if not inside:
        return df
    means = parameter_row(df.agg(*[F.avg(e).alias(c) for c, e in inside.items()]))
    return df.select(
        *[
            F.coalesce(inside[c], F.lit(means[c])).alias(c) if c in inside else F.col(c)
            for c in df.columns
        ]
    )


def impute_mean_all(df: DataFrame) -> DataFrame:
    """Mean imputation of every numeric column."""
    return fill_missing(df, "mean")


def treat_outliers_and_missing(df: DataFrame, outlier_columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Outlier replacement of the given columns and mean imputation of all other numeric ones.

    Shares one pass for counts, means and extents, then finds quartiles and the means inside the fences.
    """
    outliers = present(df, outlier_columns)
    columns = numeric_columns(df)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [F.count(c).alias(f"c{i}"), F.avg(x).alias(f"m{i}")]
        if c in outliers:
            aggregates += [F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
    row = parameter_row(df.agg(*aggregates))
    values = {
        c: row[f"m{i}"]
        for i, c in enumerate(columns)
        if c not in outliers and row[f"c{i}"] < row["n"]
    }
    extent = df.sparkSession.createDataFrame(
        [
            (c, row[f"c{i}"], row[f"l{i}"], row[f"h{i}"])
            for i, c in enumerate(columns)
            if c in outliers and row[f"c{i}"]
        ],
        "feature string, n long, lo double, hi double",
    )
    return _fill_with(replace_outliers_iqr(df, outliers, k, extent), values)
