"""Toxicity from two Kneser-Ney word models, one per class, that back off to counts of the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import chunks, release_memory, short_batches
from tarmac.llm.decontaminate import SEPARATORS
from tarmac.llm.words import Hasher, mix
from tarmac.session import materialize

_U = np.uint64
#: Different words a task counts before it hands its counts on.
HELD_WORDS = 500_000


@dataclass
class Lookup:
    """Numbers by 64-bit key; a missing key has zeros."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Lookup:
        keys = keys.astype(np.int64).view(_U)
        order = np.argsort(keys)
        zero = np.zeros((1, values.shape[1]), values.dtype)
        return cls(np.append(keys[order], _U(2**64 - 1)), np.concatenate([values[order], zero]))

    def get(self, keys: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, keys)
        place[self.keys[place] != keys] = len(self.keys) - 1
        return self.values[place]


@dataclass
class ToxicityModel:
    """Class 0 is ordinary, class 1 toxic.

    words: word -> per class the number of different words before it; its count in the whole corpus; per class
    how often a word follows it; per class and together how much of that the pair discount takes.
    pairs: (previous word, word) -> counts per class; None if pairs of words say nothing more than words.
    totals: per class the sum of the first numbers; discounted: how much of it the word discount takes.
    window, windows: words of a window, and how many of a text's windows count.
    slope, length, offset: weights of the evidence, of log(1 + words of the text), and the constant.
    """

    words: Lookup
    pairs: Lookup | None
    totals: np.ndarray
    discounted: np.ndarray
    word_discount: float
    pair_discount: float
    corpus_words: float
    corpus_types: float
    window: int
    windows: int = 1
    slope: float = 1.0
    length: float = 0.0
    offset: float = 0.0

    def token_evidence(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log P(word | previous word) of the toxic model less that of the ordinary one, for every word.

        Counts of a pair in a class, less their discount, back off to the pair's counts in both classes together,
        these to the class's continuation counts of the word, and these to its count in the corpus.
        """
        own = self.words.get(hashes)
        shared = (own[:, 2] + 1) / (self.corpus_words + self.corpus_types + 1)
        lower = [
            (np.maximum(own[:, c] - self.word_discount, 0) + self.discounted[c] * shared) / self.totals[c]
            for c in range(2)
        ]
        if self.pairs is None:
            return np.log(lower[1]) - np.log(lower[0])
        previous = np.concatenate([np.zeros(1, _U), hashes[:-1]])
        before = np.concatenate([np.zeros((1, own.shape[1])), own[:-1]])
        opening = first[:-1][np.diff(first) > 0]
        previous[opening] = 0
        before[opening] = self.words.get(np.zeros(1, _U))
        pair = self.pairs.get(pair_key(previous, hashes))
        both = np.maximum(pair.sum(axis=1) - self.pair_discount, 0)
        context = before[:, 3] + before[:, 4]
        logs = []
        for c in range(2):
            together = np.where(context > 0, (both + before[:, 7] * lower[c]) / np.maximum(context, 1), lower[c])
            high = np.maximum(pair[:, c] - self.pair_discount, 0)
            alone = (high + before[:, 5 + c] * together) / np.maximum(before[:, 3 + c], 1)
            logs.append(np.log(np.where(before[:, 3 + c] > 0, alone, together)))
        return logs[1] - logs[0]

    def evidence(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per text the mean over its ``windows`` best windows of ``window`` consecutive words, none sharing a word
        with a better one, or as many as there are (over all words of a shorter text); a text without words has 0."""
        if not len(hashes):
            return np.zeros(len(first) - 1)
        return best_means(self.token_evidence(hashes, first), first, self.window, self.windows)[:, -1]

    def scores(self, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
        z = self.slope * evidence + self.length * np.log1p(words) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def best_means(values: np.ndarray, first: np.ndarray, window: int, most: int) -> np.ndarray:
    """Column k: per text the mean over its k + 1 best windows, each the best of those that share no word with a
    better one; over all its windows if it has fewer."""
    out = np.zeros((len(first) - 1, most))
    sums = np.concatenate([[0.0], np.cumsum(values)])
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size <= window))
    out[short] = ((sums[first[1:][short]] - sums[first[:-1][short]]) / size[short])[:, None]
    long = np.flatnonzero(size > window)
    if not len(long):
        return out
    means = (sums[window:] - sums[:-window]) / window
    edges = np.zeros(len(means) + 1, np.int64)
    np.add.at(edges, first[:-1][long], 1)
    np.add.at(edges, np.minimum(first[1:][long] - window + 1, len(means)), -1)
    valid = np.cumsum(edges[:-1]) > 0
    means = np.where(valid, means, -np.inf)
    starts = first[:-1][long]
    owner = np.searchsorted(starts, np.arange(len(means)), side="right") - 1
    total, count = np.zeros(len(long)), np.zeros(len(long))
    for k in range(most):
        best = np.maximum.reduceat(means, starts)
        there = best > -np.inf
        total[there] += best[there]
        count += there
        out[long, k] = total / count
        if k + 1 < most:
            place = np.flatnonzero((means == best[owner]) & (means > -np.inf) & (owner >= 0))
            place = place[np.unique(owner[place], return_index=True)[1]]
            shared = place[:, None] + np.arange(1 - window, window)[None, :]
            means[np.clip(shared, 0, len(means) - 1)] = -np.inf
    return out


def pair_key(previous: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(previous * _U(0x9E3779B97F4A7C15) + word)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "label",
    max_documents: int = 12_000,
    window: int | Sequence[int] = (1, 2, 4),
    windows: int | Sequence[int] = (1, 2, 3),
    word_discount: float | Sequence[float] = (4.0, 2.0),
    pair_discounts: Sequence[float | None] = (2.0, 12.0, 48.0),
    prior: float | None = 0.5,
) -> ToxicityModel:
    """Fit the two word models and the calibration of their difference.

    :param docs: the whole corpus, labelled or not: its word counts are the last level both models back off to.
    :param labels: ``id_col`` and a 0/1 ``label`` of the rows to learn from; others are ignored, a row labelled
        both ways counts as toxic. At most ``max_documents`` of each class are used, those with the least hash of
        their id; this bound bounds the model that every task gets. Four fifths of them train the word models,
        the rest the calibration. A label of an absent document says nothing; without any calibration document the
        plain difference counts, shifted by the prior.
    :param window, windows: log-likelihoods are averaged over this many words, and over this many of a text's best
        windows. Toxic words stand among ordinary ones, so a text is as toxic as its most toxic windows. The more words
        a text has, the more its best windows reach by chance; the calibration takes its length into account.
    :param word_discount, pair_discounts: taken off every count of a class before it counts for that class; what is
        taken goes to the next level. Discounts above 1 leave expressions that a class has only met by chance to
        the shared counts. None leaves pairs out.
    :param prior: share of toxic texts that calibration documents are weighted to, and so which odds a score of one half
        stands for. With 0.5 a missed share of the toxic texts weighs as much as a flagged share of the clean ones; None
        takes the share among all labels.

    Where several values are given, the calibration documents decide. Word discounts are compared at the first pair discount,
    then pair discounts at the word discount chosen, each with all sizes and numbers of windows. Of the settings
    whose log-loss is within one standard error of the least, the one with the narrowest and then fewest
    windows is taken: few calibration documents tell such settings apart by chance only, and a single toxic word
    is diluted least. Among these the least log-loss decides.

    Words are in lower case without punctuation. A class without labelled rows is an error.
    """
    short_batches(docs.sparkSession)
    wanted = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    wanted = materialize(wanted.groupBy(id_col).agg(F.max(label).cast("int").alias("c")))
    shares = {r["c"]: r["n"] for r in wanted.groupBy("c").agg(F.count("*").alias("n")).collect()}
    if set(shares) != {0, 1}:
        raise ValueError("both classes need labelled rows")
    order = F.xxhash64(F.col(id_col), F.lit(17))
    sample = None
    for c in (0, 1):
        part = wanted.where(F.col("c") == c).orderBy(order, id_col).limit(max_documents)
        sample = part if sample is None else sample.unionByName(part)
    sample = sample.withColumn("part", F.when(F.pmod(order, F.lit(5)) == 0, "calibrate").otherwise("train"))
    texts = docs.select(F.col(id_col), F.col(text).alias("_text"))
    learned = materialize(texts.join(F.broadcast(sample), id_col).select("c", "part", "_text"))
    pairs = materialize(
        learned.where("part = 'train'")
        .mapInArrow(_Pairs(), "c int, u long, v long, n long")
        .groupBy("u", "v")
        .agg(*[F.sum(F.when(F.col("c") == c, F.col("n")).otherwise(F.lit(0))).alias(f"n{c}") for c in (0, 1)])
    )
    corpus = materialize(
        texts.select("_text").mapInArrow(_Words(), "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    )
    share = shares[1] / (shares[0] + shares[1]) if prior is None else prior
    held = learned.where("part = 'calibrate'")
    sizes = [(w, k) for w in _several(window) for k in _several(windows)]
    tried = []

    def attempt(word_taken, pair_taken):
        model = _model(pairs, corpus, max(_several(window)), word_taken, pair_taken)
        seen = held.mapInArrow(_Evidence(model, ["c"], settings=sizes), "c int, words long, evidence array<double>")
        # in an order of their own, so that sums do not depend on tasks
        seen = seen.orderBy("c", "words", "evidence").toArrow()
        evidence = np.array(seen["evidence"].to_pylist(), float).reshape(-1, len(sizes))
        for number, (width, most) in enumerate(sizes):
            weights, loss = _calibrate(evidence[:, number], seen["words"].to_numpy(), seen["c"].to_numpy(), share)
            slope, length, offset = weights
            tuned = replace(model, window=width, windows=most, slope=slope, length=length, offset=offset)
            tried.append((tuned, (word_taken, pair_taken), loss))

    discounts = list(pair_discounts)
    plain = None if None in discounts else discounts[0]
    for word_taken in _several(word_discount):
        attempt(word_taken, plain)
    word_taken = _choose(tried)[1][0]
    for pair_taken in discounts:
        if pair_taken != plain:
            attempt(word_taken, pair_taken)
    return _choose([x for x in tried if x[1][0] == word_taken])[0]


def _several(values) -> list:
    return list(values) if isinstance(values, Sequence) else [values]


def _choose(tried: list[tuple[ToxicityModel, tuple, np.ndarray]]) -> tuple[ToxicityModel, tuple, np.ndarray]:
    """The narrowest and fewest windows whose mean loss is within one standard error of the least, which is that of
    the difference document by document; among equals the least loss."""
    if not len(tried[0][2]):
        return min(tried, key=lambda x: (x[0].window, x[0].windows))
    least = min(tried, key=lambda x: x[2].mean())[2]
    more = [x[2] - least for x in tried]
    near = [x for x, m in zip(tried, more) if m.mean() <= m.std() / max(len(m), 1) ** 0.5]
    return min(near, key=lambda x: (x[0].window, x[0].windows, x[2].mean()))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but the text if not given) with ``evidence`` and ``score`` (0 to 1, higher for
    toxic) of each whole text. Null and empty texts have evidence 0. A text that is a field of a struct column in
    ``keep`` may be named ``column.field``; it then travels to the tasks once."""
    short_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, "evidence", "score")] if keep is None else keep
    packed = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    numbers = [T.StructField("_words", T.LongType()), T.StructField("evidence", T.DoubleType())]
    schema = T.StructType([packed.schema["_row"], *numbers])
    path = None
    if "." in text and text.split(".")[0] in keep:
        column, inner = text.split(".")
        path = keep.index(column), docs.schema[column].dataType.names.index(inner)
        packed = packed.select("_row")
    scored = packed.mapInArrow(_Evidence(model, ["_row"], path), schema)
    z = F.col("evidence") * model.slope + F.log1p("_words") * model.length + model.offset
    bounded = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))
    return scored.select("_row.*", "evidence", (1 / (1 + F.exp(-bounded))).alias("score"))


def _model(
    pairs: DataFrame, corpus: DataFrame, window: int, word_discount: float, pair_discount: float | None
) -> ToxicityModel:
    seen = [(F.col(f"n{c}") > 0).cast("double") for c in (0, 1)]
    heard = pairs.groupBy("v").agg(*[F.sum(seen[c]).alias(f"before{c}") for c in (0, 1)])
    totals = heard.agg(
        *[F.sum(f"before{c}").alias(f"total{c}") for c in (0, 1)],
        *[F.sum(F.least(F.col(f"before{c}"), F.lit(word_discount))).alias(f"discounted{c}") for c in (0, 1)],
    ).first()
    taken = F.lit(0.0 if pair_discount is None else pair_discount)
    said = pairs.groupBy(F.col("u").alias("v")).agg(
        *[F.sum(F.col(f"n{c}").cast("double")).alias(f"after{c}") for c in (0, 1)],
        *[F.sum(F.least(F.col(f"n{c}").cast("double"), taken)).alias(f"taken{c}") for c in (0, 1)],
        F.sum(F.least((F.col("n0") + F.col("n1")).cast("double"), taken)).alias("taken"),
    )
    known = heard.join(said, "v", "full").fillna(0.0)
    told = F.greatest("before0", "before1") > word_discount
    kept = None
    if pair_discount is not None:
        # the words of a kept pair count as well; all others give the same evidence without their numbers
        kept = pairs.where(F.col("n0") + F.col("n1") > pair_discount)
        ends = kept.select("v").union(kept.select("u")).distinct().withColumn("paired", F.lit(True))
        known = known.join(ends, "v", "left")
        told = told | F.col("paired")
    known = known.where(told).drop("paired")
    counts = corpus.select("v", F.col("n").cast("double").alias("corpus"))
    known = known.join(counts, "v", "left").fillna(0.0)
    columns = ["before0", "before1", "corpus", "after0", "after1", "taken0", "taken1", "taken"]
    got = known.select("v", *columns).toArrow()
    words = Lookup.of(got["v"].to_numpy(), np.stack([got[c].to_numpy() for c in columns], axis=1))
    pair_table = None
    if kept is not None:
        got = kept.toArrow()
        keys = pair_key(got["u"].to_numpy().view(_U), got["v"].to_numpy().view(_U)).view(np.int64)
        pair_table = Lookup.of(keys, np.stack([got[c].to_numpy().astype(float) for c in ("n0", "n1")], axis=1))
    whole = corpus.agg(F.sum("n").cast("double").alias("words"), F.count("*").alias("types")).first()
    return ToxicityModel(
        words=words,
        pairs=pair_table,
        totals=np.maximum([totals["total0"] or 0.0, totals["total1"] or 0.0], 1.0),
        discounted=np.maximum([totals["discounted0"] or 0.0, totals["discounted1"] or 0.0], 1.0),
        word_discount=word_discount,
        pair_discount=pair_discount or 0.0,
        corpus_words=whole["words"] or 0.0,
        corpus_types=float(whole["types"]),
        window=window,
    )


def _calibrate(
    evidence: np.ndarray, words: np.ndarray, label: np.ndarray, share: float
) -> tuple[tuple[float, float, float], np.ndarray]:
    """Logistic regression of the label on the evidence and log(1 + words), classes weighted to ``share`` of ones; a
    little ridge keeps the slope finite if the classes are separate, and one of 1 keeps the weight of the length
    small if lengths hardly differ. Returns the weights with the constant, and every document's weighted loss."""
    if not len(label):
        return (1.0, 0.0, float(np.log(share / (1 - share)))), np.zeros(0)
    weight = np.where(label == 1, share / max((label == 1).sum(), 1), (1 - share) / max((label == 0).sum(), 1))
    weight = weight * len(label)
    beta = np.array([1.0, 0.0, np.log(share / (1 - share))])
    x = np.stack([evidence, np.log1p(words), np.ones(len(label))], axis=1)
    ridge, sign = np.array([1e-2, 1.0, 1e-6]), np.where(label == 1, 1, -1)

    def losses(beta):
        return weight * np.logaddexp(0, -sign * (x @ beta))

    def aim(beta):
        return losses(beta).sum() + (ridge * beta * beta).sum() / 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (label - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.clip(np.linalg.solve(hessian, gradient), -5, 5)
        while aim(beta + step) > aim(beta) and np.abs(step).max() >= 1e-9:
            step = step / 2
        if np.abs(step).max() < 1e-9:
            break
        beta = beta + step
    beta[0] = max(beta[0], 1e-3)
    return (float(beta[0]), float(beta[1]), float(beta[2])), losses(beta)


class _Pairs:
    """Counts of (class, previous word, word) per chunk; the word before the first is 0."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SEPARATORS)
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                hashes, first = hasher.words(pc.utf8_lower(chunk.column("_text")))
                previous = np.concatenate([np.zeros(1, _U), hashes[:-1]]) if len(hashes) else hashes
                previous[first[:-1][np.diff(first) > 0]] = 0
                classes = np.repeat(chunk.column("c").to_numpy().astype(np.int64), np.diff(first))
                order = np.lexsort((hashes, previous, classes))
                c, u, v = classes[order], previous[order], hashes[order]
                new = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1]))[: len(c)])
                counts = np.diff(np.append(new, len(c)))
                yield pa.record_batch(
                    [pa.array(c[new].astype(np.int32)), *[pa.array(x[new].view(np.int64)) for x in (u, v)], pa.array(counts)],
                    names=["c", "u", "v", "n"],
                )


class _Words:
    """Counts of words, summed within a task as far as ``HELD_WORDS`` different words."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SEPARATORS)
        keys, counts, waiting = np.zeros(0, _U), np.zeros(0, np.int64), []

        def merged(keys, counts, waiting):
            every = np.concatenate([keys, *waiting])
            unique, inverse = np.unique(every, return_inverse=True)
            weight = np.concatenate([counts, np.ones(len(every) - len(counts), np.int64)])
            return unique, np.bincount(inverse, weights=weight, minlength=len(unique)).astype(np.int64)

        for batch in batches:
            for chunk in chunks(batch, "_text"):
                waiting.append(hasher.words(pc.utf8_lower(chunk.column("_text")))[0])
                if sum(map(len, waiting)) > HELD_WORDS:
                    keys, counts = merged(keys, counts, waiting)
                    waiting = []
                    if len(keys) > HELD_WORDS:
                        yield self.batch(keys, counts)
                        keys, counts = np.zeros(0, _U), np.zeros(0, np.int64)
        yield self.batch(*merged(keys, counts, waiting))
        del keys, counts, waiting
        release_memory()

    @staticmethod
    def batch(keys, counts):
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts)], names=["v", "n"])


class _Evidence:
    """Adds the number of words and the evidence, or with ``settings`` the evidence under each (window, windows)."""

    def __init__(
        self,
        model: ToxicityModel,
        keep: list[str],
        path: tuple[int, int] | None = None,
        settings: list[tuple[int, int]] | None = None,
    ):
        self.model, self.keep, self.path, self.settings = model, keep, path, settings

    def under_settings(self, hashes: np.ndarray, first: np.ndarray) -> pa.Array:
        columns = np.zeros((len(first) - 1, len(self.settings)))
        if len(hashes):
            values = self.model.token_evidence(hashes, first)
            for width in {w for w, _ in self.settings}:
                of = [i for i, (w, _) in enumerate(self.settings) if w == width]
                means = best_means(values, first, width, max(self.settings[i][1] for i in of))
                for i in of:
                    columns[:, i] = means[:, self.settings[i][1] - 1]
        return pa.array(list(columns), pa.list_(pa.float64()))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SEPARATORS)
        for batch in batches:
            if self.path:
                texts = batch.column("_row").flatten()[self.path[0]].flatten()[self.path[1]]
                batch = pa.record_batch([*batch.columns, texts], names=[*batch.schema.names, "_text"])
            for chunk in chunks(batch, "_text"):
                hashes, first = hasher.words(pc.utf8_lower(chunk.column("_text")))
                if self.settings:
                    words, evidence = "words", self.under_settings(hashes, first)
                else:
                    words, evidence = "_words", pa.array(self.model.evidence(hashes, first))
                yield pa.record_batch(
                    [*[chunk.column(c) for c in self.keep], pa.array(np.diff(first).astype(np.int64)), evidence],
                    names=[*self.keep, words, "evidence"],
                )
        del hasher
        release_memory()
