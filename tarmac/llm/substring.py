"""Removal of long word sequences that occur more than once, found through difference-cover anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import chunks, short_batches, text_bytes, text_key
from tarmac.llm.words import Hasher, mix, window_starts
from tarmac.session import materialize

#: Period and cover: every difference modulo 21 is the difference of two members (a perfect difference set).
PERIOD = 21
COVER = (0, 1, 4, 14, 16)


def repeated_windows_removed(df: DataFrame, text: str = "text", width: int = 35) -> DataFrame:
    """Remove every word that a ``width``-word window covers whose words also start anywhere else.

    Words are runs of anything but ASCII white space. Windows are judged on the input.

    1. Anchors: windows of ``width - 20`` words that begin at a position whose remainder modulo 21 lies in the
       cover. Two equal windows of ``width`` words, wherever they begin, contain equal anchors at the same
       distance from their start, so only anchors are shuffled (5 of 21 positions), by their hash.
    2. Extension: an anchor found twice is extended to each ``width``-word window that contains it, and only
       these are hashed and counted over the whole corpus.
    3. Words under a window found twice go.

    Rows are known by 96 bits of their text, since equal texts lose the same words; the columns ``text`` is
    read from need no unique id. A hash found twice within a task's chunk travels once, so a passage that
    very many texts share sends one row per chunk. Neighbouring places settled in a chunk travel as one run. Every
    step is written to the shared folder and its shuffle files go then, so that the steps' files do not add up.

    :return: the input's columns and ``n_words``, ``n_removed`` (long), ``kept_text`` (kept words joined by one
        space), replacing columns of these names. Null and empty texts have no words. Texts shorter than
        ``width`` words stay whole; an exact copy of a longer text makes both lose all words.
    """
    if width < PERIOD + 4:
        raise ValueError(f"the window must have at least {PERIOD + 4} words")
    short_batches(df.sparkSession)
    k1, k2 = text_key(text)
    texts = df.select(k1.alias("_k1"), k2.alias("_k2"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    anchors = _found_twice(texts.mapInArrow(_Anchors(width), _OCCURRENCE))
    suspects = materialize(texts.join(_by_text(anchors), ["_k1", "_k2"]), drop_shuffles=True)
    windows = _found_twice(suspects.mapInArrow(_Extended(width), _OCCURRENCE))
    cut = (
        suspects.drop("_runs")
        .join(_by_text(windows), ["_k1", "_k2"])
        .dropDuplicates(["_k1", "_k2"])
        .mapInArrow(_Cut(width), "_k1 long, _k2 long, _removed long, _kept string")
    )
    cut = materialize(cut, drop_shuffles=True)
    added = ("n_words", "n_removed", "kept_text")
    whole = df.select(F.struct(*df.columns).alias("row"), k1.alias("_k1"), k2.alias("_k2"))
    spaces = F.regexp_replace(F.coalesce(F.col("row").getField(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    spaced = F.btrim(spaces, F.lit(" "))
    n_words = F.when(spaced == "", F.lit(0)).otherwise(
        F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1
    )
    return whole.join(cut, ["_k1", "_k2"], "left").select(
        *[F.col("row").getField(c).alias(c) for c in df.columns if c not in added],
        n_words.cast("long").alias("n_words"),
        F.coalesce(F.col("_removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.col("_kept"), spaced).alias("kept_text"),
    )


_OCCURRENCE = "hash long, n int, _k1 long, _k2 long, at int, length int"


def _found_twice(occurrences: DataFrame) -> DataFrame:
    """Runs of places whose hash occurs at least twice in all. Rows without a place only add to the count."""
    total = F.sum("n").over(Window.partitionBy("hash"))
    return (
        occurrences.withColumn("total", total)
        .where("total > 1 AND at IS NOT NULL")
        .select("_k1", "_k2", F.struct("at", "length").alias("run"))
    )


def _by_text(runs: DataFrame) -> DataFrame:
    """All runs of each text, in a table of their own."""
    return materialize(runs.groupBy("_k1", "_k2").agg(F.collect_set("run").alias("_runs")), drop_shuffles=True)


def _occurrences(hashes: np.ndarray, rows: np.ndarray, at: np.ndarray, keys: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each place, given text after text. Places whose hash occurs again in this chunk are settled: each run
    of them carries weight 2 under a hash of its own, so that they are dealt to many tasks, and one row without a
    place tells the others of each hash."""
    unique, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    told = unique[counts > 1]
    text = keys.column("_k1").to_numpy().view(np.uint64)[rows]
    # a settled place that follows a settled place of its text is part of that one's run
    begins = np.ones(len(at), bool)
    begins[1:] = ~(again[1:] & again[:-1] & (rows[1:] == rows[:-1]) & (at[1:] == at[:-1] + 1))
    begin = np.flatnonzero(begins)
    length = np.diff(np.append(begin, len(at)))
    hashes, again, text, at, rows = hashes[begin], again[begin], text[begin], at[begin], rows[begin]
    own = mix(hashes ^ mix(text + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    keyed = np.where(again, own, hashes)
    # equal texts have the same settled runs, of which one row is enough
    kept = np.unique(keyed, return_index=True)[1]
    keyed, again, at, length, rows = keyed[kept], again[kept], at[kept], length[kept], rows[kept]
    k1, k2 = keys.column("_k1").take(pa.array(rows)), keys.column("_k2").take(pa.array(rows))
    none = pa.nulls(len(told), pa.int64())
    return pa.record_batch(
        [
            pa.array(np.concatenate([keyed, told]).view(np.int64)),
            pa.array(np.concatenate([np.where(again, 2, 1), np.full(len(told), 2)]).astype(np.int32)),
            pa.concat_arrays([k1, none]),
            pa.concat_arrays([k2.cast(pa.int64()), none]),
            pa.concat_arrays([pa.array(at.astype(np.int32)), pa.nulls(len(told), pa.int32())]),
            pa.concat_arrays([pa.array(length.astype(np.int32)), pa.nulls(len(told), pa.int32())]),
        ],
        names=["hash", "n", "_k1", "_k2", "at", "length"],
    )


class _Anchors:
    """Hashes of the windows at cover positions."""

    def __init__(self, width: int):
        self.width = width - PERIOD + 1

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, cover = Hasher(), np.isin(np.arange(PERIOD), COVER)
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                hashes, first = hasher.words(chunk.column("_text"))
                starts, rows = window_starts(first, self.width)
                at = starts - first[rows]
                kept = cover[at % PERIOD]
                starts, rows, at = starts[kept], rows[kept], at[kept]
                if len(starts):
                    yield _occurrences(hasher.windows(hashes, self.width)[starts], rows, at, chunk)


class _Extended:
    """Hashes of the whole windows that contain an anchor found twice."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, reach = Hasher(seed=1), PERIOD
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                hashes, first = hasher.words(chunk.column("_text"))
                anchors, owner = _places(chunk.column("_runs"))
                # a window from p holds the anchor at a if a - 20 <= p <= a
                marks = np.zeros(len(hashes) + 1, np.int32)
                low = np.maximum(first[owner] + anchors - reach + 1, first[owner])
                np.add.at(marks, low, 1)
                np.add.at(marks, first[owner] + anchors + 1, -1)
                near = np.cumsum(marks[:-1]) > 0
                starts, rows = window_starts(first, self.width)
                kept = near[starts] if len(starts) else np.zeros(0, bool)
                starts, rows = starts[kept], rows[kept]
                if len(starts):
                    found = hasher.windows(hashes, self.width)[starts]
                    yield _occurrences(found, rows, starts - first[rows], chunk)


class _Cut:
    """Texts without the words under the given windows."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                data, offsets = text_bytes(chunk.column("_text"))
                starts, ends, first = hasher.bounds(data, offsets)
                windows, owner = _places(chunk.column("_runs"))
                marks = np.zeros(len(starts) + 1, np.int32)
                np.add.at(marks, first[owner] + windows, 1)
                np.add.at(marks, first[owner] + windows + self.width, -1)
                gone = np.cumsum(marks[:-1]) > 0
                raw = data.tobytes()
                kept = []
                for row in range(chunk.num_rows):
                    own = np.arange(first[row], first[row + 1])
                    own = own[~gone[own]]
                    kept.append(" ".join(raw[s:e].decode() for s, e in zip(starts[own].tolist(), ends[own].tolist())))
                removed = np.add.reduceat(np.append(gone, False), first[:-1]) * (np.diff(first) > 0)
                yield pa.record_batch(
                    [chunk.column("_k1"), chunk.column("_k2"), pa.array(removed.astype(np.int64)), pa.array(kept)],
                    names=["_k1", "_k2", "_removed", "_kept"],
                )


def _places(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All places of a column with lists of runs, and the row of each."""
    runs = lists.flatten()
    at, length = (pa.array(runs.field(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "length"))
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(at, length) + inside, np.repeat(rows, length)
