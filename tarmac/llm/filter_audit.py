"""What each filter of a chain removes in every order, from one mask of failed filters per document.

Copies are found with compressed tries over whole texts, a range of texts per task: ranges are text prefixes, made
longer where a prefix stands for too much text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import chunks, release_memory, short_batches
from tarmac.session import materialize

FILTERS = "ABCDE"
#: Bytes of a prefix that is not made longer.
FIRST_DEPTH = 32
#: Bytes by which a heavy prefix grows beyond what all its texts share, in the first round.
STEP = 32
#: How many times more it is in each further round.
STEP_GROWTH = 4
#: A prefix is heavy if its texts have more bytes than this and than the corpus over ``HEAVY_RANGES``.
HEAVY_BYTES = 4 << 20
#: Most heavy prefixes of one depth, and so of what one round fetches.
HEAVY_RANGES = 4096
#: Bytes of text that a task's trie holds before it is read out.
TRIE_BYTES = 8 << 20

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))


class Trie:
    """Compressed trie of byte strings. A node is a list of its value (None inside) and its children by first byte,
    each a pair of the edge's bytes and the node behind it."""

    def __init__(self):
        self.root, self.bytes = [None, {}], 0

    def terminal(self, text: bytes) -> list:
        """The node at which ``text`` ends, made where it is missing."""
        node, at, end = self.root, 0, len(text)
        while at < end:
            edge = node[1].get(text[at])
            if edge is None:
                leaf = [None, {}]
                node[1][text[at]] = (text[at:], leaf)
                self.bytes += end - at
                return leaf
            label, below = edge
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            shared = common_length(label, text[at : at + len(label)])
            middle = [None, {label[shared]: (label[shared:], below)}]
            node[1][text[at]] = (label[:shared], middle)
            node, at = middle, at + shared
        return node

    def values(self) -> Iterator:
        """Values of all terminals."""
        stack = [self.root]
        while stack:
            value, children = stack.pop()
            if value is not None:
                yield value
            stack.extend(below for _, below in children.values())


def common_length(a: bytes, b: bytes) -> int:
    """Bytes that two strings share from their start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def text_mask(text: bytes) -> int:
    """Filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    words = text.split()
    size = len(text)
    return (
        (len(words) < 100)
        + 2 * (100 * len(set(words)) < 80 * len(words))
        + 4 * (100 * (size - len(text.translate(None, _UPPER))) > 10 * len(text.translate(None, _CONTINUATION)))
        + 8 * (len(text.translate(None, _SIGNS)) < size)
    )


def prefix_key(text: bytes, depth: int) -> bytes:
    """What stands for the first ``depth`` bytes of a text: themselves, or their digest where they are many."""
    head = text[:depth]
    return b"%d:" % depth + (head if len(head) <= 64 else xxhash.xxh3_128_digest(head))


def _after(a, b) -> bool:
    """Whether id ``a`` is larger than ``b``; null is larger than any other."""
    return a is not b and b is not None and (a is None or a > b)


class _Ranges:
    """Heavy prefixes: by key, how deep to look instead, or the least id of the one text that they are."""

    def __init__(self):
        self.deeper: dict[bytes, int] = {}
        self.single: dict[bytes, object] = {}

    def key(self, text: bytes) -> tuple[bytes, bool]:
        """Key of the range of a text, and whether it lies behind a heavy prefix."""
        depth, inside = FIRST_DEPTH, False
        while (longer := self.deeper.get(key := prefix_key(text, depth))) is not None:
            depth, inside = longer, True
        return key, inside


def filter_masks(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    part_col: str = "lang",
    heavy_bytes: int = HEAVY_BYTES,
) -> DataFrame:
    """Filters that each document fails, as bits of ``mask``: A 1, B 2, C 4, D 8, E 16.

    A: fewer than 100 words; B: under 80 % of the words are different; C: over 10 % of the code points are ``A`` to
    ``Z``; D: one of ``#$%&*|``; E: a row of a smaller id has the same text.

    1. Bytes of text are summed by prefix. A prefix of too many bytes is looked at again: if all its texts are one
       text, its least id settles it; otherwise what they all share, and a little more, becomes the prefix. That
       little grows fourfold in each round, so near copies take a few rounds however long they are. This ends when
       no prefix is heavy, so copies and common openings do not fill one task. Texts behind a prefix that was never
       heavy are read once.
    2. Every task puts its texts into a compressed trie, a few megabytes at a time. Of copies in one trie only
       the rows with the least id are open, the others fail E. Open ones go with their text to the task of their
       prefix.
    3. There, sorted, they are put into tries whose terminals hold the least id; rows above it fail E.

    Null texts count as empty, a null part as the empty string, a null id is larger than any other and rows of one
    id never fail E by each other. Columns of ``df`` may have any other names.

    :return: ``id_col``, ``part`` (string), ``mask`` (int), ``n_rows`` (long): rows that agree in all three may be
        one row. An empty table gives none.
    """
    short_batches(df.sparkSession)
    rows = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    ranges = heavy_prefixes(rows, heavy_bytes)
    id_type = rows.schema["id"].dataType
    fields = [("key", T.LongType()), ("text", T.BinaryType()), ("id", id_type), ("part", T.StringType()), ("mask", T.IntegerType()), ("n", T.LongType())]
    schema = T.StructType([T.StructField(*x) for x in fields])
    local = rows.mapInArrow(_Local(ranges, _arrow(id_type)), schema)
    dealt = local.repartition("key").sortWithinPartitions("key", "text")
    out = T.StructType([T.StructField(*x) for x in fields[2:]])
    masks = dealt.mapInArrow(_Merge(_arrow(id_type)), out)
    return masks.select(F.col("id").alias(id_col), "part", "mask", F.col("n").alias("n_rows"))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def heavy_prefixes(rows: DataFrame, heavy_bytes: int = HEAVY_BYTES) -> _Ranges:
    """Prefixes that stand for too much text, and how they are split, of ``rows`` with binary ``text`` and ``id``.

    The driver fetches at most ``HEAVY_RANGES`` short keys of each depth.
    """
    ranges = _Ranges()
    key = F.concat(F.lit(f"{FIRST_DEPTH}:").cast("binary"), F.substring("text", 1, FIRST_DEPTH))
    counts = materialize(rows.groupBy(key.alias("key")).agg(F.sum(F.length("text")).alias("bytes")))
    total = counts.agg(F.sum("bytes")).first()[0] or 0
    bound = max(heavy_bytes, total // HEAVY_RANGES)
    id_type = rows.schema["id"].dataType
    spans = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("low", T.BinaryType()), T.StructField("high", T.BinaryType()), T.StructField("id", id_type)])
    # the key of every later prefix lies behind one of these, at most HEAVY_RANGES
    first = counts.where(F.col("bytes") > bound).select("key")
    rows = rows.join(F.broadcast(first), key == first["key"], "left_semi")
    step = STEP
    while heavy := {bytes(r.key) for r in counts.where(F.col("bytes") > bound).select("key").collect()}:
        ends = rows.mapInArrow(_Ends(ranges, heavy, _arrow(id_type)), spans)
        ends = ends.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("id").alias("id"))
        found = ends.mapInArrow(_shared, T.StructType([spans["key"], T.StructField("shared", T.LongType()), spans["id"]])).collect()
        ranges.single.update({bytes(r.key): r.id for r in found if r.shared is None})
        ranges.deeper.update(split := {bytes(r.key): r.shared + step for r in found if r.shared is not None})
        step *= STEP_GROWTH
        if not split:
            break
        counts = rows.mapInArrow(_Sizes(ranges), "key binary, bytes long")
        counts = materialize(counts.groupBy("key").agg(F.sum("bytes").alias("bytes")))
    return ranges


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes that the least and the greatest text of a prefix share; null if they are the same text."""
    for batch in batches:
        pairs = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())
        shared = pa.array([None if a == b else common_length(a, b) for a, b in pairs], pa.int64())
        yield pa.record_batch([batch.column("key"), shared, batch.column("id")], names=["key", "shared", "id"])


class _Ends:
    """Least and greatest text and least id of each heavy prefix in a task."""

    def __init__(self, ranges: _Ranges, heavy: set[bytes], id_type: pa.DataType):
        self.ranges, self.heavy, self.id_type = ranges, heavy, id_type

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list] = {}
        for batch in batches:
            for text, own in zip(batch.column("text").to_pylist(), batch.column("id").to_pylist()):
                key, _ = self.ranges.key(text)
                if key not in self.heavy:
                    continue
                known = found.setdefault(key, [text, text, own])
                known[:] = min(known[0], text), max(known[1], text), own if _after(known[2], own) else known[2]
        names = ("low", "high")
        columns = [pa.array([x[n] for x in found.values()], pa.binary()) for n in range(2)]
        ids = pa.array([x[2] for x in found.values()], self.id_type)
        yield pa.record_batch([pa.array(list(found), pa.binary()), *columns, ids], names=["key", *names, "id"])


class _Sizes:
    """Bytes of text by key, of the texts behind heavy prefixes."""

    def __init__(self, ranges: _Ranges):
        self.ranges = ranges

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes: dict[bytes, int] = {}
            for text in batch.column("text").to_pylist():
                key, inside = self.ranges.key(text)
                if inside and key not in self.ranges.single:
                    sizes[key] = sizes.get(key, 0) + len(text)
            yield pa.record_batch([pa.array(list(sizes), pa.binary()), pa.array(list(sizes.values()), pa.int64())], names=["key", "bytes"])


class _Rows:
    """Output rows of a task."""

    def __init__(self, id_type: pa.DataType, with_text: bool):
        self.types = {"id": id_type, "part": pa.string(), "mask": pa.int32(), "n": pa.int64()}
        if with_text:
            self.types = {"key": pa.int64(), "text": pa.binary()} | self.types
        self.rows: list[tuple] = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.types)
        self.rows = []
        return pa.record_batch({name: pa.array(x, kind) for (name, kind), x in zip(self.types.items(), columns)})


def _settle(node: list, row: tuple, lost: list) -> None:
    """Hold ``row`` (id first) at a terminal if its id is the least so far; rows with a larger id go to ``lost``."""
    if node[0] is None:
        node[0] = [row]
        return
    best = node[0][0][0]
    if _after(row[0], best):
        lost.append(row)
    elif _after(best, row[0]):
        lost.extend(node[0])
        node[0] = [row]
    else:
        node[0].append(row)


class _Local:
    """Masks A to D of a task's texts, and E where a copy in the same trie or the least id of a heavy text decides.

    Rows whose E is decided have no text."""

    def __init__(self, ranges: _Ranges, id_type: pa.DataType):
        self.ranges, self.id_type = ranges, id_type

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie = _Rows(self.id_type, True), Trie()
        for batch in batches:
            for chunk in chunks(batch, "text"):
                columns = (chunk.column(c).to_pylist() for c in ("text", "id", "part"))
                for text, own, part in zip(*columns):
                    node = trie.terminal(text)
                    lost: list = []
                    _settle(node, (own, part, text), lost)
                    self.decided(out, lost)
                if trie.bytes > TRIE_BYTES:
                    self.read_out(trie, out)
                    trie = Trie()
                yield out.batch()
        self.read_out(trie, out)
        yield out.batch()
        del trie
        release_memory()

    def decided(self, out: _Rows, rows: list) -> None:
        # dealt out by id: these rows only pass through
        out.rows.extend((_spread(own, part), None, own, part, text_mask(text) | 16, 1) for own, part, text in rows)

    def read_out(self, trie: Trie, out: _Rows) -> None:
        single = self.ranges.single
        for rows in trie.values():
            text = rows[0][2]
            mask, (key, _) = text_mask(text), self.ranges.key(text)
            number = _number(key)
            counts: dict[tuple, int] = {}
            for own, part, _ in rows:
                counts[own, part] = counts.get((own, part), 0) + 1
            for (own, part), n in counts.items():
                if key in single:
                    copy = _after(own, single[key])
                    out.rows.append((_spread(own, part), None, own, part, mask | 16 * copy, n))
                else:
                    out.rows.append((number, text, own, part, mask, n))


def _number(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


def _spread(own, part: str) -> int:
    return _number(f"{own}:{part}".encode())


class _Merge:
    """Least ids at the terminals of tries over sorted rows; rows above the least id of their text fail E."""

    def __init__(self, id_type: pa.DataType):
        self.id_type = id_type

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie, last = _Rows(self.id_type, False), Trie(), None
        for batch in batches:
            for chunk in chunks(batch, "text"):
                columns = (chunk.column(c).to_pylist() for c in ("text", "id", "part", "mask", "n"))
                for text, own, part, mask, n in zip(*columns):
                    if text is None:
                        out.rows.append((own, part, mask, n))
                        continue
                    # rows are sorted by text, so all of a text's rows are in one trie
                    if trie.bytes > TRIE_BYTES and text != last:
                        out.rows.extend(row for rows in trie.values() for row in rows)
                        trie = Trie()
                    last, lost = text, []
                    _settle(trie.terminal(text), (own, part, mask, n), lost)
                    out.rows.extend((own, part, mask | 16, n) for own, part, mask, n in lost)
                yield out.batch()
        out.rows.extend(row for rows in trie.values() for row in rows)
        yield out.batch()
        del trie
        release_memory()


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents by ``part`` and ``mask``: ``n``, and those with a label 1 in ``quality`` (``good``) and ``toxic``.

    Only labelled documents are joined. A document counts as labelled 1 if any of its labels is; labels of absent
    documents and of a null id say nothing.
    """
    masks = materialize(masks)
    ones = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    ones = materialize(ones.where("good = 1 OR toxic = 1"))
    named = masks.join(ones, id_col).groupBy("part", "mask").agg(
        *[F.sum(F.col("n_rows") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")]
    )
    every = masks.groupBy("part", "mask").agg(F.sum("n_rows").alias("n"))
    zero = F.lit(0).cast("long")
    return every.unionByName(named, allowMissingColumns=True).groupBy("part", "mask").agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("n", "good", "toxic")]
    )


def interaction_report(counts: DataFrame) -> DataFrame:
    """What every filter does at every step of every order, by ``part``, from documents by mask.

    Columns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost``, ``shapley``. A part has at most 32 masks, so its rows are made from one list of them
    without a join. A document that fails k filters is removed by each of them in 120 / k of all orders.
    """
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append(("".join(order), step, bit, before))
            before |= bit
    literal = F.from_json(
        F.lit("[" + ",".join('{"o":"%s","s":%d,"b":%d,"p":%d}' % x for x in steps) + "]"),
        "array<struct<o string, s int, b int, p int>>",
    )
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = cells.select("part", "cells", F.explode(literal).alias("at"))

    def total(condition: str, value: str = "x.n") -> str:
        return f"aggregate(filter(cells, x -> {condition}), 0L, (a, x) -> a + {value})"

    fails, passed = "(x.mask & at.b) <> 0", "(x.mask & at.p) = 0"
    share = "x.n * (120 div bit_count(x.mask))"
    return rows.select(
        "part",
        F.col("at.o").alias("filter_order"),
        F.col("at.s").alias("step"),
        F.expr(total("(x.mask & (at.b | at.p)) = 0")).alias("kept"),
        F.expr(total(f"{fails} AND {passed}")).alias("removed"),
        F.expr(total(f"{fails} AND NOT {passed}")).alias("redundant"),
        F.expr(total("x.mask = at.b")).alias("unique_fails"),
        F.expr(total(f"{fails} AND {passed}", "x.good")).alias("good_lost"),
        F.expr(total(f"{fails} AND {passed}", "x.toxic")).alias("toxic_lost"),
        F.expr(total(fails, share)).alias("shapley"),
    )
