"""Jaccard self-join on word n-grams: MinHash bands find candidates, whole n-gram sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import graph
from tarmac.llm.common import chunks, long_lists, probable_members, release_memory, short_batches
from tarmac.llm.words import Hasher, mix, numbers, window_starts
from tarmac.session import materialize

#: Distinct texts that share a band and are compared as single pairs; more are compared block by block.
PAIR_BUCKET = 24
#: Texts of a block.
BLOCK = 384
#: Shingles of two blocks that are matched at a time, about.
MATCHED = 1 << 18


def choose_bands(threshold: float, recall: float, max_hashes: int = 64) -> tuple[int, int]:
    """Bands and rows per band: the most selective layout within ``max_hashes`` that finds a pair exactly at the
    threshold with probability ``recall`` or more."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no layout reaches this recall; allow more hashes")
    return best


def ngram_links(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999,
) -> DataFrame:
    """Similarity classes of all texts whose sets of ``n``-word shingles have a Jaccard index of ``threshold``
    or more, links counted in full.

    Words are runs of anything but ASCII white space, unchanged. A text of fewer than ``n`` words is its own
    only shingle. Texts without words (null, empty, blank) are linked to nothing.

    1. Equal word sequences become one node, known by a 64-bit hash, with its number of rows.
    2. A node's MinHash signature is cut into bands (``choose_bands``); nodes are shuffled on band hashes.
    3. Nodes that share a band are verified on their whole shingle sets. Each pair counts in the first band the
       two share and nowhere else. A band shared by up to ``PAIR_BUCKET`` nodes sends pairs; a more common one
       is dealt to blocks by hash and each task compares two blocks, returning counts and a spanning
       forest of links, never all pairs.
    4. Connected nodes form a class.

    :return: ``id_col``, ``class_id`` (least id of the class; null if only null ids are in it), ``n_links`` (rows
        with another position in the table and similarity of ``threshold`` or more) and ``node``, ``class_node``.
        One row per input row, repeated rows and ids included. Recall per pair at the threshold is ``recall``,
        and nearly 1 above it; nothing below the threshold is linked.
    """
    short_batches(df.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    source = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    source = source.withColumn("_key", F.xxhash64("_text"))
    signed = materialize(
        source.mapInArrow(_Signatures(n, bands, rows), "_id " + dict(df.dtypes)[id_col] + ", _key long, node long, bands array<long>")
    )
    nodes = (
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count("*").alias("n"), F.min("_key").alias("_key"), F.first("bands").alias("bands"))
    )
    nodes = materialize(nodes)
    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = materialize(members.join(sizes, "bucket"))
    # the texts of candidate nodes only
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    texts = (
        probable_members(source.select("_key", "_text"), "_key", wanted.select("_key"))
        .groupBy("_key")
        .agg(F.first("_text").alias("_text"))
        .join(wanted, "_key")
        .drop("_key")
    )
    texts = materialize(texts)
    found = _pairwise(members, texts, n, threshold).unionByName(_blockwise(members, texts, n, threshold))
    found = materialize(found)
    links = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("_links"))
    classes = graph.components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = (
        nodes.select("node", "n")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .select(
            "node",
            F.coalesce("component", "node").alias("class_node"),
            (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    placed = materialize(signed.select("_id", "_key", "node").join(known, "node", "left"))
    least = placed.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min("_id").alias("class_id"))
    return placed.join(least, "class_node", "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "node",
        "class_node",
        F.col("_key").alias("text_hash"),
    )


def one_per_class(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``df`` with one row of each similarity class: that of the least id, and among rows of one id that
    of the least text hash. Of rows equal in id and text one stays. Rows without words all stay."""
    linked = materialize(ngram_links(df, id_col, text, **options).where("node IS NOT NULL"))
    row = F.struct(id_col, "text_hash")
    first = linked.groupBy("class_node").agg(F.count("*").alias("rows"), F.min(row).alias("first")).where("rows > 1")
    crowd = materialize(linked.join(first, "class_node").select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"), "first"))
    keys = F.struct(F.col("_id").alias(id_col), F.col("_hash").alias("text_hash"))
    gone = crowd.where(~keys.eqNullSafe(F.col("first"))).select("_id", "_hash").distinct()
    rows = df.select(F.struct(*df.columns).alias("row"))
    own, body = F.col("row").getField(id_col), F.col("row").getField(text)
    same = own.eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(body, F.lit(""))) == F.col("_hash"))
    kept = rows.join(gone, same, "left_anti")
    repeated = crowd.groupBy("_id", "_hash").agg(F.count("*").alias("rows")).where("rows > 1").select("_id", "_hash")
    if not repeated.limit(1).count():
        return kept.select("row.*")
    once = kept.join(repeated, same, "left_semi").select("row", own.alias("own"), body.alias("body")).dropDuplicates(["own", "body"])
    return kept.join(repeated, same, "left_anti").unionByName(once.select("row")).select("row.*")


_FOUND = "node long, other long, links long"


def _pairwise(members: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    rare = members.where(F.col("size") <= PAIR_BUCKET)
    left, right = rare.select("bucket", F.col("node").alias("a")), rare.select("bucket", F.col("node").alias("b"))
    pairs = left.join(right, "bucket").where("a < b").groupBy("a", "b").agg(F.collect_set("bucket").alias("shared"))
    one = texts.select(*[F.col(c).alias(f"{c}_a") for c in texts.columns])
    two = texts.select(*[F.col(c).alias(f"{c}_b") for c in texts.columns])
    both = pairs.join(one, F.col("a") == F.col("node_a")).join(two, F.col("b") == F.col("node_b"))
    common = F.zip_with("bands_a", "bands_b", lambda x, y: F.when(x == y, x))
    first = F.filter(common, lambda x: x.isNotNull())[0]
    checked = (
        both.where(F.array_contains("shared", first))
        .select("a", "b", "n_a", "n_b", "_text_a", "_text_b")
        .mapInArrow(_Pairs(n, threshold), "a long, b long, n_a long, n_b long")
    )
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other"), F.col("n_b").alias("links")),
        F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("other"), F.col("n_a").alias("links")),
    )
    return checked.select(F.inline(ends))


def _blockwise(members: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    common = members.where(F.col("size") > PAIR_BUCKET).drop("n")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = (
        common.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
        .join(texts, "node")
        .withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket",
            F.least("block", "against").alias("low"),
            F.greatest("block", "against").alias("high"),
            "block",
            "node",
            "n",
            "bands",
            "_text",
        )
    )
    keys = ["bucket", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_Blocks(n, threshold), _FOUND)


class _Signatures:
    """Node and band hashes of each text; both null for a text without words."""

    def __init__(self, n: int, bands: int, rows: int):
        self.n, self.bands, self.rows = n, bands, rows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, count = Hasher(), self.bands * self.rows
        factors, masks = numbers(count, 11) | np.uint64(1), numbers(count, 13)
        for batch in batches:
            for chunk in chunks(batch, "_text"):
                shingles, rows, words = _shingles(hasher, chunk.column("_text"), self.n)
                has = np.flatnonzero(words[1] > words[0])
                begin = np.searchsorted(rows, has)
                signature = np.zeros((len(has), self.bands), np.uint64)
                if len(has):
                    for k in range(count):
                        least = np.minimum.reduceat((shingles ^ masks[k]) * factors[k], begin)
                        band = k // self.rows
                        signature[:, band] = mix(signature[:, band] * np.uint64(31) + least + np.uint64(band + 1))
                nodes = np.zeros(chunk.num_rows, np.int64)
                nodes[has] = words[2][has].view(np.int64)
                empty = np.ones(chunk.num_rows, bool)
                empty[has] = False
                counts = np.where(empty, 0, self.bands)
                yield pa.record_batch(
                    [
                        chunk.column("_id"),
                        chunk.column("_key"),
                        pa.array(nodes, mask=empty),
                        long_lists(signature.reshape(-1).view(np.int64), counts),
                    ],
                    names=["_id", "_key", "node", "bands"],
                )
        release_memory()


class _Pairs:
    """The pairs whose shingle sets are similar enough."""

    def __init__(self, n: int, threshold: float):
        self.n, self.threshold = n, threshold

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch, "_text_a"):
                sides = [_sets(hasher, chunk.column(c), self.n) for c in ("_text_a", "_text_b")]
                alike = []
                for i in range(chunk.num_rows):
                    a, b = (values[begin[i] : begin[i + 1]] for values, begin in sides)
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                    alike.append(shared >= self.threshold * (len(a) + len(b) - shared) - 1e-9)
                yield chunk.select(["a", "b", "n_a", "n_b"]).filter(pa.array(alike, pa.bool_()))
        release_memory()


class _Blocks:
    """Link counts and a spanning forest of each two blocks of a common band. Rows arrive sorted by band and
    blocks; one pair of blocks is in memory at a time."""

    def __init__(self, n: int, threshold: float):
        self.n, self.threshold = n, threshold

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, current, parts = Hasher(), None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "low", "high")])
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1, [batch.num_rows]])
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                key = tuple(keys[:, start].tolist())
                if parts and key != current:
                    yield self.compare(hasher, parts)
                    parts = []
                current = key
                parts.append(batch.slice(start, end - start))
        if parts:
            yield self.compare(hasher, parts)
        del parts
        release_memory()

    def compare(self, hasher: Hasher, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(parts).combine_chunks()
        column = {c: group.column(c).combine_chunks() for c in group.column_names}
        column = {c: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for c, x in column.items()}
        block, node, weight = (column[c].to_numpy().astype(np.int64) for c in ("block", "node", "n"))
        bands = column["bands"].flatten().to_numpy().reshape(len(node), -1)
        low, high, bucket = (column[c][0].as_py() for c in ("low", "high", "bucket"))
        values, begin = _sets(hasher, column["_text"], self.n)
        size = np.diff(begin)
        owner = np.repeat(np.arange(len(node), dtype=np.int32), size)
        shared = np.zeros((len(node), len(node)), np.float32)
        # equal shingles have equal remainders, so that the counts of each remainder add up
        slices = np.uint64(1 + len(values) // MATCHED)
        for remainder in range(int(slices)):
            mine = np.flatnonzero(values % slices == np.uint64(remainder))
            _, place, uses = np.unique(values[mine], return_inverse=True, return_counts=True)
            often = uses[place] > 1
            holder, place = owner[mine[often]], np.unique(place[often], return_inverse=True)[1]
            for start in range(0, int(place.max(initial=-1)) + 1, 8192):
                part = (place >= start) & (place < start + 8192)
                has = np.zeros((len(node), 8192), np.float32)
                has[holder[part], place[part] - start] = 1
                shared += has @ has.T
        alike = shared >= self.threshold * (size[:, None] + size[None, :] - shared) - 1e-4
        for i in range(len(node)):
            equal = bands[i] == bands
            first = bands[i][equal.argmax(axis=1)]
            alike[i] &= equal.any(axis=1) & (first == bucket)
        alike &= (node[:, None] != node[None, :]) & ((block[:, None] != block[None, :]) | (low == high))
        label = np.arange(len(node))
        while True:
            least = np.minimum(label, np.where(alike, label[None, :], len(node)).min(axis=1))
            least = least[least]
            if (least == label).all():
                break
            label = least
        links = alike @ weight
        root = pa.array(node[label], mask=label == np.arange(len(node)))
        return pa.record_batch(
            [pa.array(node), root, pa.array(links.astype(np.int64))], names=["node", "other", "links"]
        ).filter(pa.array(links > 0))


def _shingles(hasher: Hasher, texts: pa.Array, n: int):
    """Shingle hashes in order of texts, the row of each, and first word, end and whole hash of every text."""
    hashes, first = hasher.words(texts)
    starts, rows = window_starts(first, n)
    shingles = hasher.windows(hashes, n)[starts] if len(starts) else np.zeros(0, np.uint64)
    whole = hasher.spans(hashes, first[:-1], first[1:])
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(short):
        rows = np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        shingles, rows = np.concatenate([shingles, whole[short]])[order], rows[order]
    return shingles, rows, (first[:-1], first[1:], whole)


def _sets(hasher: Hasher, texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, text after text, and where each text's begin. Hashing takes some forty
    bytes for a byte of text, so texts are hashed a chunk at a time."""
    found, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for chunk in chunks(pa.record_batch([texts], names=["text"]), "text"):
        shingles, rows, _ = _shingles(hasher, chunk.column("text"), n)
        order = np.lexsort((shingles, rows))
        shingles, rows = shingles[order], rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])
        found.append(shingles[new])
        sizes.append(np.bincount(rows[new], minlength=chunk.num_rows))
    return np.concatenate(found), np.cumsum(np.concatenate(sizes))
