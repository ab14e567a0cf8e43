"""Words that differ by one code point, found with FM-indexes over the vocabulary, and their most frequent forms."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import release_memory, short_batches
from tarmac.session import materialize, parameter_table

#: Words that one index holds at about the most.
BLOCK_WORDS = 8192
#: Different words that a task counts before it hands them on.
COUNTED_WORDS = 300_000
#: Numbers of an index's table of counts; a larger index looks its counts up in sorted lists.
TABLE_CELLS = 1 << 25
#: Intervals of at most this many suffixes are read through, longer ones are tried with every character.
READ_THROUGH = 16
#: Runs of A to Z and U+00C0 to U+00FF, in lower-cased UTF-8.
_RUNS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")


def word_counts(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 5, min_count: int = 3, slip_every: int = 97
) -> DataFrame:
    """``word``, ``n``: runs of letters of whole texts, ``A`` to ``Z`` in lower case, with stated slips.

    With h the CRC-32 of ``<id>:<run>``, a run whose h ``slip_every`` divides has lost its code point h % length. A null id
    counts as empty, null texts have no words. Words are counted in tasks first, so frequent ones cost a row per
    task.
    """
    short_batches(df.sparkSession)
    rows = df.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text).cast("binary").alias("text")
    )
    counted = rows.mapInArrow(_Counts(slip_every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.char_length("word") >= min_chars) & (F.col("n") >= min_count))


class _Counts:
    def __init__(self, slip_every: int):
        self.slip_every = slip_every

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        crc32, every = zlib.crc32, self.slip_every
        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                start = crc32(f"{own}:".encode())
                for run, n in Counter(_RUNS.findall(text.as_py().lower())).items():
                    h = crc32(run, start)
                    if h % every == 0:
                        letters = run.decode()
                        place = h % len(letters)
                        run = (letters[:place] + letters[place + 1 :]).encode()
                    total[run] += n
                if len(total) > COUNTED_WORDS:
                    yield self.batch(total)
                    total = Counter()
        yield self.batch(total)
        del total
        release_memory()

    @staticmethod
    def batch(total: Counter) -> pa.RecordBatch:
        words = pa.array(list(total), pa.binary()).cast(pa.string())
        return pa.record_batch([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def near_words(vocabulary: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All pairs of different words that differ by one inserted, deleted or replaced code point, in both orders.

    An error touches one half of a word at most, so a near word has the other half unchanged, at its start or at its
    end. Words are dealt to blocks by a hash of such halves: as one to be found under the halves that words of its length
    or one more or less have, and as one that asks under its own. Each block is an FM-index of its delimited words: a
    search matches the half from the delimiter inwards, and goes on across the other half with one error. Where
    the first half is matched, words are indexed backwards, so both directions are one search. A half that
    more than ``block_words`` words share is cut into a grid of blocks.

    :param vocabulary: ``word`` (different strings, without U+0000) and ``n`` (long).
    :return: ``word``, ``near``, ``near_n``; each pair once in either order.
    """
    length = F.char_length("word")

    def halves(side: int, sizes: list[str]) -> DataFrame:
        """A row for each different half of the given sizes."""
        whole = "word" if side else "reverse(word)"
        keys = F.array_distinct(F.array(*[F.expr(f"xxhash64({side}, right({whole}, {x}))") for x in sizes]))
        return vocabulary.select("word", "n", F.lit(side).alias("side"), F.explode(keys).alias("half"))

    size = "char_length(word)"
    # of a word of m code points the first half has m div 2, the last one the rest
    found = halves(0, [f"({size} - 1) div 2", f"({size} + 1) div 2"]).unionByName(
        halves(1, [f"{size} div 2", f"({size} + 2) div 2"])
    )
    asking = halves(0, [f"{size} div 2"]).unionByName(halves(1, [f"({size} + 1) div 2"]))
    found, asking = materialize(found), materialize(asking)
    total = found.count()
    blocks = max(1, -(-total // block_words))
    common = found.groupBy("half").agg(F.count("*").alias("words")).where(F.col("words") > block_words)
    common = parameter_table(common.select("half", F.ceil(F.col("words") / F.lit(block_words)).cast("int").alias("cuts")))

    def placed(rows: DataFrame, asks: bool) -> DataFrame:
        cut = rows.join(common, "half", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
        own, every = F.pmod(F.xxhash64("word", F.lit(7)), F.col("cuts")).cast("int"), F.sequence(F.lit(0), F.col("cuts") - 1)
        grid = cut.withColumn("own", own).withColumn("other", F.explode(every))
        row, column = ("other", "own") if asks else ("own", "other")
        block = F.when(F.col("cuts") == 1, F.pmod("half", F.lit(blocks))).otherwise(F.xxhash64("half", row, column))
        return grid.select("side", block.alias("block"), F.lit(asks).alias("asks"), "word", "n")

    rows = placed(found, False).unionByName(placed(asking, True))
    return rows.groupBy("side", "block").applyInPandas(_search_block, "word string, near string, near_n long")


def _search_block(rows: pd.DataFrame) -> pd.DataFrame:
    side = int(rows["side"].iloc[0]) if len(rows) else 0
    mine = rows[~rows["asks"]].drop_duplicates("word")
    given = mine["word"].tolist() if side else [w[::-1] for w in mine["word"]]
    order = sorted(range(len(given)), key=given.__getitem__)
    words, counts = [given[i] for i in order], mine["n"].to_numpy()[order]
    asked = rows.loc[rows["asks"], "word"].tolist()
    patterns = asked if side else [w[::-1] for w in asked]
    # the half that is matched exactly, from the end of the pattern
    exact = np.array([(len(w) + side) // 2 for w in asked], np.int64)
    q, t = FMIndex(words).one_error(patterns, exact)
    out = [(asked[i], words[j] if side else words[j][::-1], counts[j]) for i, j in zip(q.tolist(), t.tolist())]
    if side:
        # with the first half unchanged as well, the other side finds the pair
        out = [x for x in out if not x[1].startswith(x[0][: len(x[0]) // 2])]
    return pd.DataFrame(out, columns=["word", "near", "near_n"])


class FMIndex:
    """Index of different words in code-point order, each behind a delimiter, searched from right to left.

    Suffixes end at a delimiter and delimiters are ordered as the words behind them, so the order of all suffixes is
    total, and the first ranks are the delimiters in the order of the words.
    """

    def __init__(self, words: list[str]):
        self.words = len(words)
        text = np.frombuffer(("\0" + "".join(w + "\0" for w in words)).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(text, return_inverse=True)
        codes = codes.astype(np.int64)
        marks = np.flatnonzero(codes == 0)
        # the last delimiter has no word behind it and comes first
        rank = codes + len(marks)
        rank[marks] = np.arange(1, len(marks) + 1)
        rank[marks[-1]] = 0
        order = self.sorted_suffixes(rank, int(np.diff(marks).max(initial=1)))
        self.before = codes[order - 1]
        size, letters = len(text), len(self.alphabet)
        self.size = size
        self.firsts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=letters))])
        # steps[c, i]: first rank of c, and how often c stands before the first i suffixes
        self.table = None
        if (size + 1) * letters <= TABLE_CELLS:
            self.table = np.zeros((letters + 1, size + 1), np.int32)
            for c in range(letters):
                self.table[c, 0] = self.firsts[c]
                np.cumsum(self.before == c, out=self.table[c, 1:])
                self.table[c, 1:] += self.firsts[c]
        else:
            places = np.argsort(self.before, kind="stable")
            self.places = self.before[places] * (size + 1) + places

    @staticmethod
    def sorted_suffixes(rank: np.ndarray, longest: int) -> np.ndarray:
        """Order of suffixes by doubling the compared length; delimiters are all different and end a comparison."""
        size, width = len(rank), 1
        order = np.argsort(rank, kind="stable")
        while width <= longest:
            after = np.zeros(size, np.int64)
            after[:-width] = rank[width:] + 1
            both = rank * (size + 2) + after
            order = np.argsort(both, kind="stable")
            ordered = both[order]
            rank = np.empty(size, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            width *= 2
        return order

    def step(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bound of the interval of ``c`` in front of the suffixes below ``at``; unknown characters give 0."""
        if self.table is not None:
            return self.table[c, at].astype(np.int64)
        found = np.searchsorted(self.places, c * (self.size + 1) + at)
        return np.where(c < len(self.alphabet), found, 0)

    def one_error(self, patterns: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of patterns and of words that differ from them by exactly one code point in front of the last
        ``exact`` code points, which agree."""
        none = np.zeros(0, np.int64)
        if not self.words or not patterns:
            return none, none
        # a pattern as it is read: delimiter, the word from its end, delimiter
        text = np.frombuffer("".join("\0" + p[::-1] + "\0" for p in patterns).encode("utf-32-le"), np.uint32)
        codes = np.minimum(np.searchsorted(self.alphabet, text), len(self.alphabet) - 1)
        codes = np.where(self.alphabet[codes] == text, codes, len(self.alphabet))
        sizes = np.array([len(p) + 2 for p in patterns], np.int64)
        start = np.cumsum(sizes) - sizes
        whole = np.arange(len(patterns))
        q, at = whole, np.ones(len(patterns), np.int64)
        low, high = np.zeros(len(q), np.int64), np.full(len(q), self.firsts[1])
        w_q, w_at, w_low, w_high = none, none, none, none
        found_q, found_t = [], []
        while len(q) or len(w_q):
            # one error from here on
            open_ = np.flatnonzero(at > exact[q])
            s_q, s_at = q[open_], at[open_]
            here = codes[start[s_q] + s_at]
            inner = s_at < sizes[s_q] - 1
            state, c, c_low, c_high = self.branch(low[open_], high[open_])
            other = c != here[state]
            state, c_low, c_high = state[other], c_low[other], c_high[other]
            replaced = inner[state]
            # of a run of equal code points only the last one is taken out
            gone = inner & (here != codes[start[s_q] + np.minimum(s_at + 1, sizes[s_q] - 1)])
            w_q = np.concatenate([w_q, s_q[state], s_q[state[replaced]], s_q[gone]])
            w_at = np.concatenate([w_at, s_at[state], s_at[state[replaced]] + 1, s_at[gone] + 1])
            w_low = np.concatenate([w_low, c_low, c_low[replaced], low[open_][gone]])
            w_high = np.concatenate([w_high, c_high, c_high[replaced], high[open_][gone]])
            # without an error, up to the last delimiter
            more = at < sizes[q] - 1
            q, at, low, high = self.advance(codes, start, q[more], at[more], low[more], high[more])
            w_q, w_at, w_low, w_high = self.advance(codes, start, w_q, w_at, w_low, w_high)
            done = w_at == sizes[w_q]
            # delimiters stand in the order of their words, the last one before them
            found_q.append(w_q[done])
            found_t.append(w_low[done] - 1)
            w_q, w_at, w_low, w_high = w_q[~done], w_at[~done], w_low[~done], w_high[~done]
        pairs = np.unique(np.stack([np.concatenate(found_q), np.concatenate(found_t)]), axis=1)
        return pairs[0], pairs[1]

    def advance(self, codes, start, q, at, low, high):
        c = codes[start[q] + at]
        low, high = self.step(c, low), self.step(c, high)
        alive = low < high
        return q[alive], at[alive] + 1, low[alive], high[alive]

    def branch(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """Intervals in front of the given ones by each letter that stands there: state, letter, low, high."""
        width, letters = high - low, len(self.alphabet)
        few = np.flatnonzero(width <= READ_THROUGH)
        state = np.repeat(few, width[few])
        inside = np.arange(len(state)) - np.repeat(np.cumsum(width[few]) - width[few], width[few])
        seen = np.unique(state * letters + self.before[low[state] + inside])
        many = np.flatnonzero(width > READ_THROUGH)
        state = np.concatenate([seen // letters, np.repeat(many, letters - 1)])
        c = np.concatenate([seen % letters, np.tile(np.arange(1, letters), len(many))])
        state, c = state[c > 0], c[c > 0]
        below, above = self.step(c, low[state]), self.step(c, high[state])
        alive = below < above
        return state[alive], c[alive], below[alive], above[alive]


def spelling_groups(vocabulary: DataFrame, factor: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each word's near words, the form it is a variant of, and the root of that.

    The form is the near word of largest count (the first in code-point order among equals) if its count is at least
    ``factor`` times the word's own. As counts grow along forms, following them ends after few steps; it is done by
    joins that double the distance.

    :return: ``word``, ``form``, ``root``, ``n``, ``n_near`` (long, 0 without near words), ``form_n``.
    """
    if factor < 2:
        raise ValueError("factor has to be at least 2, so that forms cannot go round in a circle")
    vocabulary = materialize(vocabulary.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(vocabulary, block_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = vocabulary.join(near, "word", "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    groups = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ))
    # words without a form are where all ways end and need no row
    ways = groups.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ways = materialize(ways)
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = ways.join(onward, "root", "left")
        if longer.where("next IS NOT NULL").isEmpty():
            break
        ways = longer.select("word", F.coalesce("next", "root").alias("root"))
    return groups.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
