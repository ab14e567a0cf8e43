"""Quality rules: counts over each text, and a linear-chain conditional random field that labels its lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import chunks, short_batches, text_bytes
from tarmac.llm.words import Hasher, window_starts
from tarmac.session import materialize

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Upper bounds of the bins that each line statistic is cut into; the last bin is open.
BINS = {
    "words": (1, 2, 4, 8, 16, 32, 64),
    "word_length": (3, 4, 5, 6, 8, 12),
    "symbols": (0, 0.02, 0.05, 0.1, 0.2),
    "capitals": (0, 0.05, 0.1, 0.3, 0.6),
    "digits": (0, 0.02, 0.1, 0.3),
    "ended": (0, 0.05, 0.2, 0.6),
    "repeated_words": (0, 0.1, 0.3, 0.6),
    "seen_before": (0,),
    "ends_sentence": (0,),
}
WIDTH = sum(len(b) + 1 for b in BINS.values())
CONTENT, BOILERPLATE = 1, 0


def analyse(texts: pa.Array, hasher: Hasher, splitter: Hasher):
    """Counts of each text (columns as in ``COUNTS``), and for each line with a word its text's row, its number of words
    and the places of its statistics' bins among ``WIDTH`` features."""
    data, offsets = text_bytes(texts)
    count = len(offsets) - 1
    starts, ends, first = hasher.bounds(data, offsets)
    rows = np.repeat(np.arange(count), np.diff(first))
    hashes = hasher.hashes(data, starts, ends)

    def sums(kind: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])

    def members(codes) -> np.ndarray:
        kind = np.zeros(256, bool)
        kind[list(codes)] = True
        return kind

    points = sums(~members(range(128, 192)))
    chars = points[ends] - points[starts]
    symbols = sums(members(b"#*$%&|<>"))
    repeated = np.zeros(len(starts) + 1, np.int64)
    at, window_rows = window_starts(first, 3)
    if len(at):
        triples = hasher.windows(hashes, 3)[at]
        order = np.lexsort((triples, window_rows))
        same = (np.diff(window_rows[order]) == 0) & (triples[order][1:] == triples[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        np.add.at(repeated, at[twice], 1)
        np.add.at(repeated, at[twice] + 3, -1)
    in_repeat = np.cumsum(repeated[:-1]) > 0

    line_starts, line_ends, line_first = splitter.bounds(data, offsets)
    line_rows = np.repeat(np.arange(count), np.diff(line_first))
    low, high = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    has = high > low
    line_starts, line_ends, line_rows, low, high = (x[has] for x in (line_starts, line_ends, line_rows, low, high))
    line_hashes = splitter.hashes(data, line_starts, line_ends)
    before = np.zeros(len(line_rows), bool)
    if len(line_rows):
        order = np.lexsort((np.arange(len(line_rows)), line_hashes, line_rows))
        same = (np.diff(line_rows[order]) == 0) & (line_hashes[order][1:] == line_hashes[order][:-1])
        before[order[1:]] = same

    def per_text(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=count).astype(np.int64)

    counts = np.stack(
        [
            np.diff(first),
            per_text(chars, rows),
            symbols[offsets[1:]] - symbols[offsets[:-1]],
            per_text(before, line_rows),
            per_text(in_repeat, rows),
        ],
        axis=1,
    )

    def per_line(prefix: np.ndarray) -> np.ndarray:
        return prefix[high] - prefix[low]

    def within(kind: np.ndarray) -> np.ndarray:
        prefix = sums(kind)
        return prefix[line_ends] - prefix[line_starts]

    def prefixed(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    words = (high - low).astype(float)
    size = np.maximum(points[line_ends] - points[line_starts], 1)
    letters = np.maximum(within(members([*range(65, 91), *range(97, 123)])), 1)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    ended = np.isin(last, list(b".!?"))
    statistics = [
        words,
        per_line(prefixed(chars)) / np.maximum(words, 1),
        (symbols[line_ends] - symbols[line_starts]) / size,
        within(members(range(65, 91))) / letters,
        within(members(range(48, 58))) / size,
        per_line(prefixed(ended)) / np.maximum(words, 1),
        per_line(prefixed(in_repeat)) / np.maximum(words, 1),
        before.astype(float),
        ended[high - 1].astype(float) if len(high) else np.zeros(0),
    ]
    features, shift = [], 0
    for values, bounds in zip(statistics, BINS.values()):
        features.append(np.searchsorted(bounds, values) + shift)
        shift += len(bounds) + 1
    return counts, line_rows, words, np.stack(features, axis=1)


@dataclass
class LineModel:
    """A linear-chain conditional random field over two labels.

    emissions: weight of each feature for content (boilerplate has weight 0); steps: weight of each label after
    each other; opening: weight of each label of a text's first line.
    """

    emissions: np.ndarray
    steps: np.ndarray
    opening: np.ndarray

    def content(self, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether each line is content on the best path through its text (Viterbi); ties go to content. Lines are in
        order of ``rows``; the paths of all texts advance together."""
        labels = np.zeros(len(rows), bool)
        if not len(rows):
            return labels
        scores = self.emissions[features].sum(axis=1)
        begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        length = np.diff(np.append(begin, len(rows)))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        back = np.zeros((len(rows), 2), np.int8)
        best = np.stack([np.full(len(begin), self.opening[0]), self.opening[1] + scores[begin]], axis=1)
        for step in range(1, int(length[0])):
            alive = int(np.searchsorted(-length, -step, side="left"))
            line = begin[:alive] + step
            for label in range(2):
                stay, move = best[:alive, CONTENT] + self.steps[CONTENT, label], best[:alive, 0] + self.steps[0, label]
                back[line, label] = stay >= move
            new = np.maximum(best[:alive, :1] + self.steps[0], best[:alive, 1:] + self.steps[1])
            new[:, CONTENT] += scores[line]
            best[:alive] = new
        label = (best[:, CONTENT] >= best[:, BOILERPLATE]).astype(np.int8)
        for step in range(int(length[0]) - 1, -1, -1):
            alive = int(np.searchsorted(-length, -step, side="left"))
            line = begin[:alive] + step
            labels[line] = label[:alive] == CONTENT
            if step:
                label[:alive] = back[line, label[:alive]]
        return labels


def train(features: np.ndarray, rows: np.ndarray, labels: np.ndarray, rounds: int = 150, ridge: float = 1.0) -> LineModel:
    """Weights of greatest conditional likelihood of the label sequences, by Adam on forward-backward gradients.

    ``rows`` tells lines of different sequences apart; sequences are short here (see ``fit``), so they advance together.
    """
    begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    length = np.diff(np.append(begin, len(rows)))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    alive = [int(np.searchsorted(-length, -step, side="left")) for step in range(int(length[0]))]
    after = [begin[: alive[t]] + t for t in range(len(alive))]
    inner = np.concatenate(after[1:]) if len(after) > 1 else np.zeros(0, int)
    observed_steps = np.zeros((2, 2))
    np.add.at(observed_steps, (labels[inner - 1], labels[inner]), 1)
    observed_opening = np.bincount(labels[begin], minlength=2)
    observed = np.bincount(features[labels == 1].reshape(-1), minlength=WIDTH)
    theta = np.zeros(WIDTH + 6)
    first_moment, second_moment = np.zeros_like(theta), np.zeros_like(theta)
    for round_ in range(1, rounds + 1):
        emissions, steps, opening = theta[:WIDTH], theta[WIDTH : WIDTH + 4].reshape(2, 2), theta[WIDTH + 4 :]
        local = np.zeros((len(rows), 2))
        local[:, 1] = emissions[features].sum(axis=1)
        forward, backward = np.zeros((len(rows), 2)), np.zeros((len(rows), 2))
        forward[begin] = opening + local[begin]
        for t in range(1, len(alive)):
            line = after[t]
            before = forward[line - 1]
            forward[line] = np.logaddexp(before[:, :1] + steps[0], before[:, 1:] + steps[1]) + local[line]
        for t in range(len(alive) - 1, 0, -1):
            line = after[t]
            ahead = backward[line] + local[line]
            backward[line - 1] = np.logaddexp(ahead[:, :1] + steps[:, 0], ahead[:, 1:] + steps[:, 1])
        total = forward + backward
        norm = np.logaddexp(total[:, 0], total[:, 1])
        content = np.exp(total[:, 1] - norm)
        expected = np.bincount(features.reshape(-1), weights=np.repeat(content, features.shape[1]), minlength=WIDTH)
        joint = np.exp(
            forward[inner - 1][:, :, None] + steps[None] + (local + backward)[inner][:, None, :] - norm[inner][:, None, None]
        ).sum(axis=0)
        expected_opening = np.array([(1 - content[begin]).sum(), content[begin].sum()])
        gradient = np.concatenate(
            [observed - expected, (observed_steps - joint).reshape(-1), observed_opening - expected_opening]
        )
        gradient = (gradient - ridge * theta) / len(rows)
        first_moment = 0.9 * first_moment + 0.1 * gradient
        second_moment = 0.99 * second_moment + 0.01 * gradient**2
        scale = first_moment / (1 - 0.9**round_) / (np.sqrt(second_moment / (1 - 0.99**round_)) + 1e-9)
        theta = theta + 0.1 * scale
    return LineModel(theta[:WIDTH].copy(), theta[WIDTH : WIDTH + 4].reshape(2, 2).copy(), theta[WIDTH + 4 :].copy())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "label",
    max_documents: int = 4000,
    segment: int = 40,
) -> LineModel:
    """Train the line model on the lines of labelled texts: all lines of a text labelled 1 count as content, all lines
    of one labelled 0 as boilerplate. A good line in a bad text is a wrong label, which the many good lines of good
    texts outweigh.

    At most ``max_documents`` texts of each label are used (the bound of the sample), those with the least hash of
    their id, in whole; sequences longer than ``segment`` lines are learned in segments. Training runs on the driver
    over the sample's line features. A missing label is an error.
    """
    short_batches(docs.sparkSession)
    wanted = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    wanted = materialize(wanted.groupBy(id_col).agg(F.min(label).cast("int").alias("y")))
    order, sample = F.xxhash64(F.col(id_col), F.lit(23)), None
    for y in (0, 1):
        part = wanted.where(F.col("y") == y).orderBy(order, id_col).limit(max_documents)
        sample = part if sample is None else sample.unionByName(part)
    rows = (
        docs.select(F.col(id_col), F.col(text).alias("_text"))
        .join(F.broadcast(sample), id_col)
        .select("y", "_text")
        .mapInArrow(_Features(), "y int, features array<int>")
        .toArrow()
    )
    y = rows["y"].to_numpy()
    if set(y.tolist()) != {0, 1}:
        raise ValueError("both labels need labelled texts")
    lists = rows["features"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lines = lists.value_lengths().to_numpy() // len(BINS)
    features = lists.flatten().to_numpy().reshape(-1, len(BINS)).astype(np.int64)
    place = np.arange(len(features)) - np.repeat(np.cumsum(lines) - lines, lines)
    sequences = np.repeat(np.arange(len(lines)), lines) * (1 << 32) + place // segment
    return train(features, sequences, np.repeat(y, lines).astype(np.int64))


def judge(
    docs: DataFrame, model: LineModel, text: str = "text", keep: list[str] | None = None, least_content: float = 0.5
) -> DataFrame:
    """Columns ``keep`` (all but the text if not given) with the counts of each whole text, ``base_failed``,
    ``content_share`` and ``kept``.

    Words are runs of anything but ASCII white space. ``word_chars``: code points in words; ``n_symbols``: characters of
    ``#*$%&|<>``; ``n_dup_lines``: lines with a word that equal an earlier line of the text; ``n_repeat_words``: words in
    windows of three words found twice or more in the text. ``base_failed``: fewer than 50 words, or more than half
    of the words in repeated windows. ``content_share``: share of the words that are in lines labelled content.
    ``kept``: not ``base_failed`` and a share of ``least_content`` or more. A null or empty text has zeros and fails.
    """
    short_batches(docs.sparkSession)
    added = [*COUNTS, "base_failed", "content_share", "kept"]
    keep = [c for c in docs.columns if c not in (text, *added)] if keep is None else keep
    packed = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    schema = T.StructType(
        [
            packed.schema["_row"],
            *[T.StructField(c, T.LongType()) for c in COUNTS],
            T.StructField("content_share", T.DoubleType()),
        ]
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        packed.mapInArrow(_Judge(model), schema)
        .withColumn("base_failed", failed)
        .select("_row.*", *COUNTS, "base_failed", "content_share", (~failed & (F.col("content_share") >= least_content)).alias("kept"))
    )


class _Features:
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, splitter = Hasher(), Hasher(b"\n")
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                _, rows, _, features = analyse(chunk.column("_text"), hasher, splitter)
                lines = np.bincount(rows, minlength=chunk.num_rows) * len(BINS)
                ends = pa.array(np.concatenate([[0], np.cumsum(lines)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(features.reshape(-1).astype(np.int32)))
                yield pa.record_batch([chunk.column("y"), lists], names=["y", "features"])


class _Judge:
    def __init__(self, model: LineModel):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, splitter = Hasher(), Hasher(b"\n")
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                counts, rows, words, features = analyse(chunk.column("_text"), hasher, splitter)
                content = self.model.content(features, rows) * words
                share = np.bincount(rows, weights=content, minlength=chunk.num_rows) / np.maximum(counts[:, 0], 1)
                yield pa.record_batch(
                    [chunk.column("_row"), *[pa.array(counts[:, i].astype(np.int64)) for i in range(len(COUNTS))], pa.array(share)],
                    names=["_row", *COUNTS, "content_share"],
                )
