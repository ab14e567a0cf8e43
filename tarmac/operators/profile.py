"""Descriptive statistics, ranges, correlations and data quality, one pass for all columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import as_double, wide_to_long
from tarmac.operators.quantiles import column_quantiles
from tarmac.session import parameter_table

#: Bytes of pair matrices that a task holds before it hands them on.
HELD_BYTES = 64 << 20
#: Columns of a block; a pair of blocks is a tile of at most this many columns squared.
BLOCK_COLUMNS = 384
_ROUNDING = 1e-13


def dataset_info(df: DataFrame) -> DataFrame:
    """``(column, data_type, non_null, n_rows)`` in one aggregate over the table."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)],
    )
    types = dict(df.dtypes)
    return wide_to_long(
        counted,
        [],
        {
            c: {
                "data_type": F.lit(types[c]),
                "non_null": F.col(f"c{i}"),
                "n_rows": F.col("n_rows"),
            }
            for i, c in enumerate(names)
        },
        feature="column",
    )


def describe(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max per column, optionally per group."""
    keep = [by] if by else []
    if by:
        df = df.where(F.col(by).isNotNull())
    work = as_double(df, columns, keep)
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.avg(c).alias(f"a{i}"),
            F.stddev_samp(c).alias(f"s{i}"),
            F.min(c).alias(f"l{i}"),
            F.max(c).alias(f"h{i}"),
        ]
    moments = parameter_table(wide_to_long(
        work.groupBy(*keep).agg(*aggregates),
        keep,
        {
            c: {
                "count": F.col(f"n{i}"),
                "mean": F.col(f"a{i}"),
                "std": F.col(f"s{i}"),
                "min": F.col(f"l{i}"),
                "max": F.col(f"h{i}"),
            }
            for i, c in enumerate(columns)
        },
    ))
    extent = moments.where(F.col("count") > 0).select(
        *keep, "feature", F.col("count").alias("n"), F.col("min").alias("lo"), F.col("max").alias("hi")
    )
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], keep, extent=extent)
    return moments.join(quartiles, [*keep, "feature"], "left").select(
        *keep,
        "feature",
        "count",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("q25"),
        F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
        "max",
    )


def value_range(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """max - min per column; with ``by`` also per group (``level`` tells the two apart)."""
    keep = [by] if by else []
    work = as_double(df, columns, keep)
    spans = [(F.max(c) - F.min(c)).alias(f"r{i}") for i, c in enumerate(columns)]
    fields = {c: {"value_range": F.col(f"r{i}")} for i, c in enumerate(columns)}
    if not by:
        return wide_to_long(work.agg(*spans), [], fields)
    level = F.when(F.grouping(by) == 1, F.lit("overall")).otherwise(F.lit("group"))
    both = work.rollup(by).agg(level.alias("level"), *spans)
    both = both.where((F.col("level") == "overall") | F.col(by).isNotNull())
    return wide_to_long(both, ["level", by], fields)


# --- correlation ------------------------------------------------------------------------------


class _PairSums:
    """Sums over the rows on which both columns of a pair are known: counts, values, squares and products.

    Pairs are worked on in tiles, the products of two blocks of columns. A task adds up one set of matrices per group
    and tile over all its batches, and hands them on early only when they outgrow ``HELD_BYTES``. Values are
    shifted by ``centres`` so that squares keep their digits.
    """

    def __init__(self, columns: Sequence[str], centres: Sequence[float], keep: Sequence[str], tiles: Sequence[tuple[range, range]]):
        self.columns, self.centres, self.keep, self.tiles = list(columns), np.asarray(centres, float), list(keep), list(tiles)
        self.blocks = sorted({block for tile in tiles for block in tile}, key=lambda block: block.start)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, list] = {}
        bytes_each = sum(8 * (4 if left == right else 6) * len(left) * len(right) for left, right in self.tiles)
        for batch in batches:
            x = {block: self.matrix(batch, block) for block in self.blocks}
            if self.keep:
                coded = batch.column(self.keep[0]).dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                groups = [(name, codes == i) for i, name in enumerate(coded.dictionary.to_pylist())]
            else:
                groups = [(None, slice(None))]
            for name, rows in groups:
                parts = {block: self.known(matrix[rows]) for block, matrix in x.items()}
                if name not in held:
                    held[name] = [0, *[None for _ in self.tiles]]
                sums = held[name]
                sums[0] += len(parts[self.blocks[0]][0])
                for number, (left, right) in enumerate(self.tiles, 1):
                    new = self.sums(parts[left], parts[right], left == right)
                    if sums[number] is None:
                        sums[number] = new
                    else:
                        for old, more in zip(sums[number], new):
                            old += more
            if len(held) * bytes_each > HELD_BYTES:
                yield from self.rows(held, batch.schema)
                held = {}
        if held:
            yield from self.rows(held, batch.schema)

    def matrix(self, batch: pa.RecordBatch, block: range) -> np.ndarray:
        columns = [batch.column(self.columns[i]).to_numpy(zero_copy_only=False).astype(float) for i in block]
        return np.stack(columns, axis=1) - self.centres[block.start : block.stop]

    @staticmethod
    def known(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = ~np.isnan(x)
        x = np.where(known, x, 0.0)
        return x, known.astype(float), x * x

    @staticmethod
    def sums(left: tuple, right: tuple, same: bool) -> list[np.ndarray]:
        (x, known, square), (y, there, other) = left, right
        out = [known.T @ there, x.T @ there, square.T @ there, x.T @ y]
        return out if same else [*out, known.T @ y, known.T @ other]

    def rows(self, held: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for name, (count, *tiles) in held.items():
            for (left, right), sums in zip(self.tiles, tiles):
                if left == right:
                    first, second = np.triu_indices(len(left))
                    n, s, q, p = sums
                    columns = [n[first, second], s[first, second], s[second, first], q[first, second], q[second, first], p[first, second]]
                else:
                    first, second = (x.ravel() for x in np.indices((len(left), len(right))))
                    n, s, q, p, t, u = (x.ravel() for x in sums)
                    columns = [n, s, t, q, u, p]
                cells = [
                    pa.array(np.full(len(first), count)),
                    pa.array((first + left.start).astype(np.int32)),
                    pa.array((second + right.start).astype(np.int32)),
                    *map(pa.array, columns),
                ]
                group = [pa.array([name] * len(first), schema.field(k).type) for k in self.keep]
                yield pa.record_batch([*group, *cells], names=[*self.keep, "rows", "i", "j", *_SUMS])


_SUMS = ["n", "si", "sj", "qi", "qj", "p"]


def column_tiles(n_columns: int) -> list[list[tuple[range, range]]]:
    """Pairs of column blocks, in passes whose matrices fit in ``HELD_BYTES`` together."""
    blocks = [range(a, min(a + BLOCK_COLUMNS, n_columns)) for a in range(0, n_columns, BLOCK_COLUMNS)]
    tiles = [(a, b) for i, a in enumerate(blocks) for b in blocks[i:]]
    each = max(1, HELD_BYTES // (6 * 8 * BLOCK_COLUMNS**2))
    return [tiles[i : i + each] for i in range(0, len(tiles), each)]


def _centres(work: DataFrame, columns: Sequence[str]) -> list[float]:
    """Mean of the finite values of each column, 0 without any."""
    if len(columns) <= BLOCK_COLUMNS // 4:
        finite = [F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in columns]
        found = work.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(finite)]).first()
        return [m or 0.0 for m in found]

    # so many aggregates in one expression take longer to compile than to run
    def sums(batches):
        total = np.zeros((2, len(columns)))
        for batch in batches:
            for i, name in enumerate(columns):
                x = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
                x = x[np.isfinite(x)]
                total[:, i] += len(x), x.sum()
        yield pa.record_batch([pa.array(np.arange(len(columns))), *map(pa.array, total)], names=["i", "n", "s"])

    parts = work.select(*columns).mapInArrow(sums, "i long, n double, s double")
    mean = F.coalesce(F.try_divide(F.sum("s"), F.sum("n")), F.lit(0.0))
    return [r.m for r in parts.groupBy("i").agg(mean.alias("m")).orderBy("i").collect()]


def pair_sums(df: DataFrame, columns: Sequence[str], by: str | None = None) -> tuple[DataFrame, list[float]]:
    """``([by], i, j, rows, n, si, sj, qi, qj, p)`` for all column numbers i <= j, and the centres that values are
    shifted by: over the rows that know both columns, their number, sums, sums of squares and sum of products.

    Up to ``BLOCK_COLUMNS`` columns take one pass. More are cut into blocks, and each pass reads the columns of a few
    pairs of blocks only, so that a task holds ``HELD_BYTES`` of sums whatever the number of columns.
    """
    keep = [by] if by else []
    if by:
        df = df.where(F.col(by).isNotNull())
    work = as_double(df, columns, keep)
    centres = _centres(work, columns)
    group = [work.schema[by].simpleString().replace(":", " ", 1)] if by else []
    schema = ", ".join([*group, "rows long, i int, j int", *[f"{c} double" for c in _SUMS]])
    cells = None
    for tiles in column_tiles(len(columns)):
        used = sorted({i for tile in tiles for block in tile for i in block})
        part = work.select(*keep, *[columns[i] for i in used]) if len(used) < len(columns) else work
        part = part.mapInArrow(_PairSums(columns, centres, keep, tiles), schema)
        cells = part if cells is None else cells.unionByName(part)
    total = cells.groupBy(*keep, "i", "j").agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in _SUMS])
    return total, centres


def pair_correlation() -> Column:
    """Pearson correlation from the columns of ``pair_sums``; null where a column is constant."""
    square_i = F.col("qi") - F.try_divide(F.col("si") * F.col("si"), F.col("n"))
    square_j = F.col("qj") - F.try_divide(F.col("sj") * F.col("sj"), F.col("n"))
    # below this share of the sum of squares a difference is rounding: the column is constant on these rows
    varies = (square_i > F.col("qi") * _ROUNDING) & (square_j > F.col("qj") * _ROUNDING)
    product = F.col("p") - F.try_divide(F.col("si") * F.col("sj"), F.col("n"))
    return F.when(varies, product / F.sqrt(square_i * square_j))


def corr_pairs(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Pearson correlation of every unordered pair ``x before y`` and of each column with itself.

    A pass for the centres and, up to ``BLOCK_COLUMNS`` columns, one for the sums: tasks multiply masked matrices of
    their rows, Spark adds the cells. A pair is judged on the rows that know both; a column that is constant there
    gives null.
    """
    keep = [by] if by else []
    total, _ = pair_sums(df, columns, by)
    if by:
        total = total.where(F.col("rows") > 2)
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(
        *keep,
        names[F.col("i")].alias("x"),
        names[F.col("j")].alias("y"),
        pair_correlation().alias("r"),
        F.col("n").cast("long").alias("n"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Full symmetric matrix in long form ``([by], x, y, r, n)``; a constant column gives null."""
    keep = [by] if by else []
    half = corr_pairs(df, columns, by)
    ends = F.when(
        F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")))
    ).otherwise(
        F.array(
            F.struct(F.col("x").alias("a"), F.col("y").alias("b")),
            F.struct(F.col("y").alias("a"), F.col("x").alias("b")),
        )
    )
    return half.select(*keep, F.explode(ends).alias("e"), "r", "n").select(
        *keep, F.col("e.a").alias("x"), F.col("e.b").alias("y"), "r", "n"
    )


def top_correlations(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The n strongest pairs by absolute correlation, strongest first."""
    return (
        corr_pairs(df, columns)
        .where((F.col("x") != F.col("y")) & F.col("r").isNotNull())
        .orderBy(F.abs("r").desc(), "x", "y")
        .limit(n)
    )


def top_corr_matrix(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """Correlation matrix of the columns that occur in the n strongest pairs."""
    matrix = parameter_table(corr_matrix(df, columns))
    position = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("x")) < F.array_position(
        F.array(*[F.lit(c) for c in columns]), F.col("y")
    )
    strongest = (
        matrix.where(position & F.col("r").isNotNull())
        .orderBy(F.abs("r").desc(), "x", "y")
        .limit(n)
        .select(F.explode(F.array("x", "y")).alias("name"))
        .distinct()
    )
    names = strongest.select(F.col("name").alias("x"))
    others = strongest.select(F.col("name").alias("y"))
    return matrix.join(names, "x", "left_semi").join(others, "y", "left_semi").select("x", "y", "r", "n")


# --- quality ----------------------------------------------------------------------------------


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column, most first."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    unknown = {
        c: (F.col(c).isNull() | F.isnan(c)) if c in floats else F.col(c).isNull() for c in columns
    }
    wide = df.agg(*[F.count_if(unknown[c]).alias(f"m{i}") for i, c in enumerate(columns)])
    return wide_to_long(
        wide, [], {c: {"missing": F.col(f"m{i}")} for i, c in enumerate(columns)}
    ).orderBy(F.desc("missing"), "feature")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of identical rows; only rows that may have a copy are compared whole."""
    from tarmac.operators.clean import suspected_copies

    _, suspects = suspected_copies(df)
    return (
        suspects.groupBy(*[f"`{c}`" for c in df.columns])
        .agg(F.count(F.lit(1)).alias("__copies"))
        .agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    )


def iqr_outlier_counts(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Values strictly outside the quartile fences per column, most first."""
    from tarmac.operators.clean import iqr_fences

    fences = iqr_fences(df, columns, k)
    work = as_double(df, columns)
    outside = {
        c: (F.col(c) < fences[c][0]) | (F.col(c) > fences[c][1]) if c in fences else F.lit(False)
        for c in columns
    }
    wide = work.agg(*[F.count_if(outside[c]).alias(f"o{i}") for i, c in enumerate(columns)])
    return wide_to_long(
        wide, [], {c: {"outliers": F.col(f"o{i}")} for i, c in enumerate(columns)}
    ).orderBy(F.desc("outliers"), "feature")


def quality_report(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    return {
        "missing": missing_counts(df, columns),
        "duplicates": duplicate_count(df),
        "outliers": iqr_outlier_counts(df, columns),
    }


def analytical_report(df: DataFrame, columns: Sequence[str], by: str | None = None) -> dict[str, DataFrame]:
    """Descriptive statistics, ranges, correlations and quality as tidy tables."""
    report = {
        "describe_overall": describe(df, columns),
        "range": value_range(df, columns, by),
        "corr_overall": corr_matrix(df, columns),
        **quality_report(df, columns),
    }
    if by:
        report["describe_by_group"] = describe(df, columns, by)
        report["corr_by_group"] = corr_matrix(df, columns, by)
    return report
