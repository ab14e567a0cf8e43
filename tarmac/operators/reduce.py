"""Principal components of z-scored columns and their scatter points."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import present
from tarmac.operators.encode import category_codes
from tarmac.operators.profile import pair_correlation, pair_sums
from tarmac.session import materialize

#: Columns whose matrix is solved on the driver: 8 MB of cells.
DENSE_COLUMNS = 1000
#: Vectors that a block has beyond the wanted ones, and blocks of the basis before it is shrunk.
EXTRA_VECTORS, BASIS_BLOCKS = 4, 12
#: Most components of a wide table whose shares are found.
MOST_COMPONENTS = 512


def _complete(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Numbers as ``x0, x1, ...`` on the rows that know them all."""
    names = [f"__x{i}" for i in range(len(columns))]
    return df.select(
        *keep, *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)]
    ).na.drop(subset=names)


class _Sums:
    """Means, deviations and correlations of complete rows, all from the same pair sums."""

    def __init__(self, complete: DataFrame, names: Sequence[str]):
        sums, centres = pair_sums(complete, names)
        self.size = len(names)
        cells = sums.select("i", "j", "n", "si", "qi", F.coalesce(pair_correlation(), F.lit(0.0)).alias("r"))
        self.dense = self.size <= DENSE_COLUMNS
        self.cells = cells if self.dense else materialize(cells)
        got = (self.cells if self.dense else self.cells.where("i = j")).toArrow().to_pandas()
        own = got[got["i"] == got["j"]].sort_values("i")
        n = own["n"].to_numpy()
        mean = own["si"].to_numpy() / n
        self.means = np.asarray(centres)[own["i"]] + mean
        self.deviations = np.sqrt(np.maximum(own["qi"].to_numpy() / n - mean**2, 0.0))
        self.own = own["r"].to_numpy()
        self.deviations[self.own == 0] = 0.0
        if self.dense:
            self.matrix = np.zeros((self.size, self.size))
            self.matrix[got["i"], got["j"]] = self.matrix[got["j"], got["i"]] = got["r"]

    def axes(self, k: int, tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
        """The k largest eigenvalues (all of a small matrix) and their axes, whose largest loading is positive."""
        if self.dense:
            values, axes = np.linalg.eigh(self.matrix)
            values, axes = values[::-1], axes[:, ::-1]
        else:
            values, axes = leading_axes(self.cells, self.size, k, tolerance)
        top = np.abs(axes).argmax(axis=0)
        return values, axes * np.where(axes[top, np.arange(axes.shape[1])] < 0, -1.0, 1.0)


def leading_axes(cells: DataFrame, size: int, k: int, tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenpairs of a symmetric matrix given as a table of its cells ``(i, j, r)`` with i <= j.

    A block of vectors is improved by the residuals of its best approximations (Rayleigh-Ritz in a growing basis,
    shrunk to the best vectors when it has ``BASIS_BLOCKS`` blocks). Each round multiplies the table with a block in
    one Spark job; the driver holds some blocks of ``size`` rows and never the matrix. Ends when residuals are below
    ``tolerance`` times the largest eigenvalue.
    """
    width = min(size, k + EXTRA_VECTORS)
    draw = np.random.default_rng(11)
    basis = np.linalg.qr(draw.normal(size=(size, width)))[0]
    images = _times(cells, basis)
    while True:
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, mapped = basis @ turn[:, :width], images @ turn[:, :width]
        rest = mapped - vectors * values[:width]
        far = np.linalg.norm(rest[:, :k], axis=0)
        if (far <= tolerance * max(abs(values[0]), 1e-300)).all():
            return values[:k], vectors[:, :k]
        if basis.shape[1] + width > BASIS_BLOCKS * width:
            keep = 2 * width
            basis, images = basis @ turn[:, :keep], images @ turn[:, :keep]
        for _ in range(2):
            rest = rest - basis @ (basis.T @ rest)
        new, weight = np.linalg.qr(rest)
        new = new[:, np.abs(np.diag(weight)) > 1e-13 * max(abs(values[0]), 1e-300)]
        new = new - basis @ (basis.T @ new)
        if not new.shape[1] or basis.shape[1] + new.shape[1] > size:
            return values[:k], vectors[:, :k]
        new = np.linalg.qr(new)[0]
        basis, images = np.hstack([basis, new]), np.hstack([images, _times(cells, new)])


def _times(cells: DataFrame, block: np.ndarray) -> np.ndarray:
    """The matrix of the cells times a block of vectors: sums of a task, one row for each row of the matrix, then of all."""
    size, width = block.shape

    def multiply(batches):
        total = np.zeros((size, width))
        for batch in batches:
            i, j, r = (batch.column(c).to_numpy() for c in ("i", "j", "r"))
            for place in range(width):
                total[:, place] += np.bincount(i, weights=r * block[j, place], minlength=size)
                off = i != j
                total[:, place] += np.bincount(j[off], weights=(r * block[i, place])[off], minlength=size)
        columns = [pa.array(total[:, place]) for place in range(width)]
        yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), *columns], names=["i", *[f"c{n}" for n in range(width)]])

    schema = ", ".join(["i int", *[f"c{n} double" for n in range(width)]])
    parts = cells.select("i", "j", "r").mapInArrow(multiply, schema)
    got = parts.groupBy("i").agg(*[F.sum(f"c{n}").alias(f"c{n}") for n in range(width)]).toArrow().to_pandas().sort_values("i")
    return got.drop(columns="i").to_numpy()


def pca(
    df: DataFrame, columns: Sequence[str], key_cols: Sequence[str], k: int = 2, keep: Sequence[str] = ()
) -> DataFrame:
    """Projection ``(keys..., pc1..pck)`` of the rows without missing values.

    The rows are aggregated to the cells of a columns x columns matrix, from which means, deviations and axes come.
    Up to ``DENSE_COLUMNS`` columns the matrix is solved on the driver and the axes become literals of a projection; of
    more columns the cells stay a table, the leading axes are found by products with it, and tasks multiply
    their rows with the axes.
    """
    if k < 2 or k > len(columns):
        raise ValueError("k must be at least 2 and at most the number of columns")
    kept = [*key_cols, *keep]
    complete = _complete(df, columns, kept)
    names = [c for c in complete.columns if c not in kept]
    sums = _Sums(complete, names)
    _, axes = sums.axes(k)
    width = np.where(sums.deviations > 0, sums.deviations, 1.0)
    if not sums.dense:
        schema = T.StructType([*[complete.schema[c] for c in kept], *[T.StructField(f"pc{j + 1}", T.DoubleType()) for j in range(k)]])
        return complete.mapInArrow(_Project(names, kept, sums.means, axes[:, :k] / width[:, None]), schema)
    components = []
    for j in range(k):
        score = F.lit(0.0)
        for i, n in enumerate(names):
            score = score + (F.col(n) - F.lit(float(sums.means[i]))) / F.lit(float(width[i])) * F.lit(float(axes[i, j]))
        components.append(score.alias(f"pc{j + 1}"))
    return complete.select(*kept, *components)


class _Project:
    def __init__(self, names: Sequence[str], kept: Sequence[str], means: np.ndarray, weights: np.ndarray):
        self.names, self.kept, self.means, self.weights = list(names), list(kept), means, weights

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in self.names], axis=1)
            scores = (x - self.means) @ self.weights
            columns = [*[batch.column(c) for c in self.kept], *[pa.array(s) for s in scores.T]]
            yield pa.record_batch(columns, names=[*self.kept, *[f"pc{j + 1}" for j in range(scores.shape[1])]])


def pca_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Explained share per component; ``selected`` marks those needed to reach the threshold.

    Of more than ``DENSE_COLUMNS`` columns only the components that are needed, and possibly some more, are found;
    more than ``MOST_COMPONENTS`` are an error."""
    complete = _complete(df, columns, [])
    sums = _Sums(complete, complete.columns)
    everything = max(float(sums.own.sum()), 1e-300)
    k = min(4, sums.size)
    while True:
        # the error of an eigenvalue is that of its axis squared
        values = np.clip(sums.axes(k, tolerance=1e-6)[0], 0.0, None)
        if sums.dense or values.sum() >= threshold * everything or k == sums.size:
            break
        if k >= MOST_COMPONENTS:
            raise ValueError(f"more than {MOST_COMPONENTS} components are needed for a share of {threshold}")
        k = min(2 * k, sums.size, MOST_COMPONENTS)
    rows, total = [], 0.0
    for i, r in enumerate(values / (max(values.sum(), 1e-300) if sums.dense else everything)):
        rows.append((i + 1, float(r), total + float(r), total < threshold))
        total += float(r)
    return df.sparkSession.createDataFrame(
        rows, "component int, ratio double, cumulative double, selected boolean"
    )


def projection_points(
    df: DataFrame,
    columns: Sequence[str],
    key_cols: Sequence[str],
    target: str,
    class_col: str = "DELAY_CLASS",
    k: int = 2,
) -> DataFrame:
    """Components plus the colour of each point: the class code, else the target value."""
    colour = class_col if present(df, [class_col]) else target
    points = pca(df, columns, key_cols, k, keep=[colour])
    if colour == class_col:
        return category_codes(points, class_col, "label").drop(class_col)
    return points.withColumnRenamed(colour, "label")
