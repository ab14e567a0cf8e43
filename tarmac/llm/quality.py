"""Document quality by regularised quadratic discriminant analysis of text statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import chunks, short_batches, text_bytes
from tarmac.llm.words import Hasher, window_starts

STATISTICS = (
    "words word_length line_words capitals symbols digits sentence_ends distinct_words "
    "repeated_lines repeated_triples top_word bars"
).split()
_SYMBOLS = b"#*$%&|<>{}[]=^~@!_"


def statistics(texts: pa.Array, hasher: Hasher, lines: Hasher) -> np.ndarray:
    """One row of transformed statistics per text: counts as logarithms, shares as logarithms of share + 0.01.
    A text without words has the values of an empty text, all of them finite."""
    data, offsets = text_bytes(texts)
    starts, ends, first = hasher.bounds(data, offsets)
    n = np.diff(first).astype(float)
    rows = np.repeat(np.arange(len(n)), np.diff(first))
    line_starts, line_ends, line_first = lines.bounds(data, offsets)
    has = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_rows = np.repeat(np.arange(len(n)), np.diff(line_first))
    line_starts, line_ends, line_rows = line_starts[has], line_ends[has], line_rows[has]
    n_lines = np.bincount(line_rows, minlength=len(n)).astype(float)

    def per_text(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def table(members) -> np.ndarray:
        kind = np.zeros(256, bool)
        kind[list(members)] = True
        return kind

    letters = per_text(table([*range(65, 91), *range(97, 123)]))
    chars = per_text(~table(range(128, 192)))
    hashes = hasher.hashes(data, starts, ends)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    distinct, top = _distinct(rows, hashes, len(n))
    line_distinct, _ = _distinct(line_rows, lines.hashes(data, line_starts, line_ends), len(n))
    at, window_rows = window_starts(first, 3)
    triples = hasher.windows(hashes, 3)[at] if len(at) else np.zeros(0, np.uint64)
    triple_distinct, _ = _distinct(window_rows, triples, len(n))

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.log(part / np.maximum(whole, 1) + 0.01)

    ended = np.bincount(rows, weights=np.isin(last, list(b".!?")), minlength=len(n))
    columns = [
        np.log1p(n),
        np.log1p(chars / np.maximum(n, 1)),
        np.log1p(n / np.maximum(n_lines, 1)),
        share(per_text(table(range(65, 91))), letters),
        share(per_text(table(_SYMBOLS)), chars),
        share(per_text(table(range(48, 58))), chars),
        share(ended, n),
        share(distinct, n),
        share(n_lines - line_distinct, n_lines),
        share(np.maximum(n - 2, 0) - triple_distinct, np.maximum(n - 2, 0)),
        share(top, n),
        share(per_text(table(b"|")), n),
    ]
    return np.stack(columns, axis=1)


def _distinct(rows: np.ndarray, hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different hashes in each row and how often its commonest occurs."""
    if not len(rows):
        return np.zeros(count), np.zeros(count)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])))
    uses = np.diff(np.append(new, len(rows)))
    top = np.zeros(count)
    np.maximum.at(top, rows[new], uses)
    return np.bincount(rows[new], minlength=count).astype(float), top


class _Statistics:
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lines = Hasher(), Hasher(b"\n")
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                values = statistics(chunk.column("_text"), hasher, lines)
                ends = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(values.reshape(-1)))
                yield pa.record_batch([chunk.column("_row"), lists], names=["_row", "x"])


def with_statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but the text if not given) and ``x``, the array of statistics of each whole text."""
    short_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in (text, "x")] if keep is None else keep
    packed = df.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    schema = T.StructType([packed.schema["_row"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return packed.mapInArrow(_Statistics(), schema).select("_row.*", "x")


@dataclass
class QuadraticModel:
    """Per class: log prior, mean and Cholesky factor of the shrunk covariance."""

    priors: np.ndarray
    means: np.ndarray
    factors: np.ndarray

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), 2))
        for c in range(2):
            z = np.linalg.solve(self.factors[c], (x - self.means[c]).T)
            out[:, c] = -0.5 * (z * z).sum(axis=0) - np.log(np.diag(self.factors[c])).sum() + self.priors[c]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1, from the difference of the two log densities."""
        density = self.log_densities(x)
        return 1 / (1 + np.exp(np.clip(density[:, 0] - density[:, 1], -700, 700)))


def fit(labelled: DataFrame, label: str = "label", pooled: float = 0.1, ridge: float = 0.05) -> QuadraticModel:
    """Fit on rows with ``x`` and a 0/1 label; rows with another or no label are ignored.

    Counts, sums and products of the statistics are summed per class by Spark over all labelled rows; the
    driver gets 2 x (1 + d + d²) numbers. Each class covariance is shrunk towards the pooled one (share
    ``pooled``) and its own mean variance (share ``ridge``). A class without rows is an error.
    """
    d = len(STATISTICS)
    x = F.col("x")
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = (
        labelled.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("c")).agg(F.count("*").alias("n"), *sums, *products)
    ).collect()
    by_class = {r["c"]: r for r in rows}
    if set(by_class) != {0, 1}:
        raise ValueError("both classes need labelled rows")
    counts = np.array([by_class[c]["n"] for c in (0, 1)], float)
    means = np.array([[by_class[c][f"s{i}"] / counts[c] for i in range(d)] for c in (0, 1)])
    scatter = np.empty((2, d, d))
    for c in (0, 1):
        for i in range(d):
            for j in range(i, d):
                scatter[c, i, j] = scatter[c, j, i] = by_class[c][f"p{i}_{j}"] - counts[c] * means[c, i] * means[c, j]
    together = scatter.sum(axis=0) / counts.sum()
    factors = np.empty_like(scatter)
    for c in (0, 1):
        own = (1 - pooled) * scatter[c] / counts[c] + pooled * together
        level = max(np.trace(own) / d, 1e-6)
        factors[c] = np.linalg.cholesky((1 - ridge) * own + ridge * level * np.eye(d))
    return QuadraticModel(np.log(counts / counts.sum()), means, factors)


class _Scores:
    def __init__(self, model: QuadraticModel):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(STATISTICS)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, d)
            yield pa.record_batch([batch.column("_row"), pa.array(self.model.scores(x))], names=["_row", "score"])


def score(rows: DataFrame, model: QuadraticModel) -> DataFrame:
    """Rows of ``with_statistics`` with ``score`` (0 to 1, higher for class 1) in place of ``x``."""
    keep = [c for c in rows.columns if c not in ("x", "score")]
    packed = rows.select(F.struct(*keep).alias("_row"), "x")
    schema = T.StructType([packed.schema["_row"], T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(_Scores(model), schema).select("_row.*", "score")


def fold(key: str | Column, folds: int) -> Column:
    """Remainder of the CRC-32 of a key's text by ``folds``; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
