"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells of the fixed-size filter that ``probable_members`` broadcasts, whatever the table's size.
FILTER_CELLS = 1 << 20
#: Rows of texts in an Arrow batch.
BATCH_ROWS = 1000
#: Bytes of an Arrow batch; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
#: Bytes of text that a task's Python code works on at a time; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Let no more than ``BATCH_ROWS`` rows or ``BATCH_BYTES`` bytes travel to Python at once: the default of 10,000
    whole texts takes tens of megabytes several times over in each task. Spark reads these settings when a job starts, so
    they stay with the session; smaller ones that it has already stay as they are."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        known = re.fullmatch(r"(\d+)b?", spark.conf.get(name))
        if not known or not 0 < int(known[1]) <= most:
            spark.conf.set(name, str(most))


def release_memory() -> None:
    """Give memory that a finished task's Python code has freed back to the system: Python workers outlive their
    tasks, and what they hold on to counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_key(text: str = "text"):
    """96 bits that stand for a whole text: equal texts share them. Null counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(whole), F.crc32(whole.cast("binary"))


def probable_members(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose long ``key`` may be among ``wanted``, found without a shuffle of ``df``.

    The broadcast table holds the cells that wanted keys fall into: at most ``FILTER_CELLS`` numbers of 8
    bytes, whatever the size of either table. An exact join has to follow; with very many wanted keys the
    filter lets all rows pass and only that join decides.
    """
    cells = wanted.select(F.pmod(F.col(key), F.lit(FILTER_CELLS)).alias("_cell")).distinct()
    return (
        df.withColumn("_cell", F.pmod(F.col(key), F.lit(FILTER_CELLS)))
        .join(F.broadcast(cells), "_cell", "left_semi")
        .drop("_cell")
    )


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``max_bytes`` of text, or one row."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (strings or binary), one after the other, and where each begins; null counts as empty."""
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null(b"" if binary else "")
    texts = texts.cast(pa.large_binary() if binary else pa.large_string())
    _, offset_buffer, data = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def long_lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Arrow lists of longs from the values of all rows and each row's count."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int64), pa.int64()))
