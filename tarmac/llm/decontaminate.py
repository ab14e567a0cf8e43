"""Texts that hold a benchmark item, word for word or with few edits: random walks turn edits into changed symbols, sampled
symbols are looked up, and what is met is compared exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import FILTER_CELLS, chunks, release_memory, short_batches
from tarmac.llm.words import Hasher, numbers
from tarmac.session import materialize

#: Bytes of benchmark text that one pass over the corpus looks for, about; a larger benchmark takes several passes.
BLOCK_BYTES = 4 << 20
#: Words are runs of ASCII letters and digits and of other bytes above 127, in lower case.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
#: Steps of a walk after which its random functions come again, and between two symbols of a sample.
PERIOD = 4
#: Most repetitions; where a recall needs more, samples get smaller.
MAX_REPETITIONS = 6
#: Texts on which the recall of repetitions is measured, for each place of the edits.
TRIALS = 400
#: Longer items are simulated as items of this size with edits as dense.
SIMULATED_WORDS = 1000
#: Places to be verified that a task holds at a time.
HELD_PLACES = 1 << 20
_U = np.uint64
_STEP_CODE = _U(0xD6E8FEB86659FD93)


def edits_allowed(n_words: np.ndarray | int, share: float):
    return np.floor(np.asarray(n_words) * share + 1e-9).astype(int)


def contaminated(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_edit_share: float = 0.1,
    recall: float = 0.97,
    min_words: int = 1,
    bits: int = 4,
) -> DataFrame:
    """Every (text, item) of which some stretch of the text is the item but for a few words.

    Words are compared in lower case without punctuation. An item of n words is found if n *
    ``max_edit_share`` words (rounded down) or fewer are inserted, removed or replaced, the text around it
    being free.

    1. A window is embedded by a walk over its words: at each step the word under the walker is written down, and a
       random function of step and word tells whether the walker moves on. After an edit, walks over the item and
       the edited text soon meet again by chance, so that few symbols of the embedding differ.
    2. ``bits`` symbols of the embedding are sampled, ``PERIOD`` steps apart, at every place of it. The random functions
       come again after ``PERIOD`` steps, so the walks of all item-sized windows that pass a word go on alike,
       and the samples behind each word of a text are hashed once for all of them. Samples of the item's own
       embedding are looked up among them. Each repetition has random functions of its own and a walk from the
       first and one from the last word of windows.
    3. Items take as many repetitions as simulated edits of their size need for ``recall``, be the edits spread, anywhere,
       in the opening, in the middle or at the end (``sampling_plan``). Items that allow no edit are looked up whole.
    4. Where a sample is met, the item is compared with the text around it by exact word edit distance.

    The items are fetched in blocks of about ``BLOCK_BYTES`` and sent to every task of one pass over the texts,
    which are neither shuffled nor cut. Items of fewer than ``min_words`` words, without words and null items are
    left out.

    :param max_edit_share: 0 or more and below 1; with 1 the empty stretch would match every item.
    :param recall: least share of edited items to be found, for every size of items and place of the edits; an error if
        no samples reach it.
    :param bits: most symbols of a sample; short items, and items of very many edits, have fewer.
    :return: ``id_col``, ``item_id``, ``edits`` (int), ``word_start`` (int, number of the text's word where the best match
        begins, the first among equals), ``n_item_words``. One row per row and item; repeated rows repeat.
        Null and empty texts hold nothing.
    """
    if not 0 <= max_edit_share < 1:
        raise ValueError("max_edit_share has to be 0 or more and below 1")
    if not 0 < recall < 1 or bits < 1:
        raise ValueError("recall has to be between 0 and 1, and bits at least 1")
    short_batches(df.sparkSession)
    wanted = items.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).alias("_item"), F.lower(item_text).alias("_text")
    )
    source = df.select(F.col(id_col).alias("_id"), F.lower(F.col(text)).alias("_text"))
    schema = (
        f"{id_col} {dict(df.dtypes)[id_col]}, item_id {dict(items.dtypes)[item_id]}, "
        "edits int, word_start int, n_item_words int"
    )
    total = wanted.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    found = None
    for block in range(blocks):
        part = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("_text"), F.lit(blocks)) == block)
        rows = part.orderBy("_item", "_text").toArrow()
        search = _Search(rows, id_col, min_words, max_edit_share, recall, bits)
        matches = source.mapInArrow(search, schema)
        found = matches if found is None else found.unionByName(matches)
    return found if item_id == "item_id" else found.withColumnRenamed("item_id", item_id)


def drop_contaminated(
    df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 8, **options
) -> DataFrame:
    """The rows of ``df`` that hold no item of ``min_words`` words or more, with any columns.

    Rows are told apart by id and text together. Texts are not shuffled but for those whose key falls into the
    same one of ``FILTER_CELLS`` cells as a found one; these are joined exactly."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("hash"))
    keyed = df.select(key.alias("key"), F.col(text).alias("text"))
    found = contaminated(keyed, items, "key", "text", min_words=min_words, **options)
    found = materialize(found.select("key").distinct())

    def cell(key):
        return F.pmod(F.xxhash64(key), F.lit(FILTER_CELLS))

    # at most FILTER_CELLS numbers
    cells = F.broadcast(found.select(cell("key").alias("cell"), F.lit(True).alias("met")).distinct())
    rows = df.select(F.struct(*df.columns).alias("row"), key.alias("own"))
    rows = rows.withColumn("cell", cell("own")).join(cells, "cell", "left")
    suspects = rows.where("met").join(found, F.col("own").eqNullSafe(F.col("key")), "left_anti")
    return rows.where("met IS NULL").select("row.*").unionByName(suspects.select("row.*"))


class _Walk:
    """Samples of the embedding of windows by one random walk, from all words of many texts at once.

    ``patterns`` has ``PERIOD`` random bits for each value of a word's lowest bits, one of them set: the walker moves
    on at least once in a period."""

    def __init__(self, repetition: int):
        draw = numbers(1 << 16, 1000 + repetition)
        patterns = (1 + draw % _U((1 << PERIOD) - 1)).astype(np.uint8)
        self.moves = [(patterns >> j) & 1 for j in range(PERIOD)]

    def onward(self, hashes: np.ndarray) -> np.ndarray:
        """Where the walker stands one period after each word; the number of words if there are no more."""
        low = (hashes & _U(0xFFFF)).astype(np.uint16)
        at = np.arange(len(hashes), dtype=np.int32)
        for j, moves in enumerate(self.moves):
            # behind the last word it stands still
            move = np.append(moves[low], np.uint8(0))
            at = at + (move[:-1] if j == 0 else move[at])
        return at

    def samples(self, hashes: np.ndarray, end: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, ... ``most`` symbols: codes of the samples that begin at each word, and which of them stay
        within its text (``end``: where the text of each word ends)."""
        onward = np.append(self.onward(hashes), np.int32(len(hashes)))
        words = np.append(hashes, _U(0))
        at = np.arange(len(hashes), dtype=np.int32)
        code, inside = np.zeros(len(hashes), _U), np.ones(len(hashes), bool)
        for symbol in range(most):
            if symbol:
                at = onward[at]
                inside = inside & (at < end)
            code = code * _STEP_CODE + words[at]
            yield code, inside

    def own(self, hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the samples along the walk from the first word of an item, and where they begin."""
        onward, places, at = self.onward(hashes), [], 0
        *_, (code, inside) = self.samples(hashes, np.full(len(hashes), len(hashes)), bits)
        while at < len(hashes):
            if inside[at]:
                places.append(at)
            at = int(onward[at])
        places = np.array(places, np.int64)
        return code[places], places


def sample_size(n_words: int, bits: int) -> int:
    """Symbols of an item's samples: as many as any walk through it has."""
    return min(bits, 1 + (n_words - 1) // PERIOD)


def sampling_plan(n_words: int, edits: int, recall: float, bits: int) -> tuple[int, int]:
    """Symbols of a sample, ``bits`` at most, and repetitions for items of ``n_words`` words with ``edits`` edits.

    Samples get smaller where edits lie so close that ``MAX_REPETITIONS`` of larger ones would miss too many."""
    if n_words > SIMULATED_WORDS:
        # as dense edits leave the more samples unchanged the longer the item is
        n_words, edits = SIMULATED_WORDS, -(-edits * SIMULATED_WORDS // n_words)
    for size in range(sample_size(n_words, bits), 0, -1):
        found = repetitions(n_words, edits, recall, size)
        if found:
            return size, found
    raise ValueError(f"no samples reach a recall of {recall} for {edits} edits in {n_words} words")


@lru_cache(maxsize=4096)
def repetitions(n_words: int, edits: int, recall: float, bits: int) -> int | None:
    """Least number of repetitions that find ``recall`` of simulated items of ``n_words`` different words with ``edits``
    edits, for each of five places of the edits: evenly spread, anywhere, and neighbouring ones in the opening, in
    the middle and at the end. None if ``MAX_REPETITIONS`` do not."""
    draw = np.random.default_rng(n_words * 1000 + edits)
    everywhere, fifth = np.arange(n_words), max(edits, n_words // 5)
    middle = (n_words - fifth) // 2
    places = (None, everywhere, everywhere[:fifth], everywhere[middle : middle + fifth], everywhere[-fifth:])
    items, texts, kinds = [], [], []
    for kind, among in enumerate(places):
        for _ in range(TRIALS if n_words < 200 else TRIALS // 5):
            item = draw.integers(0, 1 << 63, n_words, np.int64).view(_U)
            where = (np.arange(edits) * 2 + 1) * n_words // (2 * edits) if among is None else draw.choice(among, edits, False)
            words = list(item)
            for place in sorted(where.tolist(), reverse=True):
                new = _U(draw.integers(0, 1 << 63))
                words[place : place + 1] = ([new], [], [new, words[place]])[draw.integers(3)]
            around = draw.integers(0, 1 << 63, 40, np.int64).view(_U)
            items.append(item)
            texts.append(np.concatenate([around[:20], np.array(words, _U), around[20:]]))
            kinds.append(kind)
    kinds, sizes = np.array(kinds), [len(x) for x in texts]
    owner = np.repeat(np.arange(len(texts)), sizes).astype(_U) * _STEP_CODE
    hit = np.zeros(len(items), bool)
    for number in range(MAX_REPETITIONS):
        walk = _Walk(number)
        for turned in (False, True):
            own = [walk.own(x[::-1] if turned else x, bits)[0] for x in items]
            wanted = np.concatenate(own) + np.repeat(np.arange(len(own)), [len(x) for x in own]).astype(_U) * _STEP_CODE
            flat = np.concatenate([x[::-1] if turned else x for x in texts])
            *_, (code, inside) = walk.samples(flat, np.repeat(np.cumsum(sizes), sizes), bits)
            met = np.isin(code + owner, wanted) & inside
            hit[np.repeat(np.arange(len(texts)), sizes)[met]] = True
        if all(hit[kinds == kind].mean() >= recall for kind in range(len(places))):
            return number + 1
    return None


class _Items:
    """Items as word hashes, and the edits each may have."""

    def __init__(self, rows: pa.Table, hasher: Hasher, min_words: int, share: float):
        column = rows.column("_text").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        hashes, first = hasher.words(column)
        size = np.diff(first)
        self.at = np.flatnonzero(size >= max(min_words, 1))
        self.ids = rows.column("_item").take(pa.array(self.at))
        self.words = [hashes[first[i] : first[i + 1]] for i in self.at]
        self.size = size[self.at]
        self.edits = edits_allowed(self.size, share)


class _Search:
    def __init__(self, rows: pa.Table, id_col: str, min_words: int, share: float, recall: float, bits: int):
        self.id_col, self.bits = id_col, bits
        hasher = Hasher(SEPARATORS)
        self.items = _Items(rows, hasher, min_words, share)
        self.whole, self.sampled = self.prepare(hasher, recall)

    def prepare(self, hasher: Hasher, recall: float):
        """Tables of what is looked up: for each length of items without edits their hashes; for each repetition,
        direction and size of samples the items' samples, each with its item and its place in the item."""
        items, bits = self.items, self.bits
        exact = np.flatnonzero(items.edits == 0)
        whole = []
        for width in np.unique(items.size[exact]).tolist():
            mine = exact[items.size[exact] == width]
            codes = np.concatenate([hasher.windows(items.words[i], width) for i in mine])
            whole.append((width, _Codes(codes, mine, np.zeros(len(mine), np.int64))))
        edited = np.flatnonzero(items.edits > 0)
        # more words with as many edits are found more easily
        least = {int(k): int(items.size[edited][items.edits[edited] == k].min()) for k in np.unique(items.edits[edited])}
        plans = {k: sampling_plan(n, k, recall, bits) for k, n in least.items()}
        sampled = []
        for number in range(max((rounds for _, rounds in plans.values()), default=0)):
            walk = _Walk(number)
            for turned in (False, True):
                by_bits: dict[int, list] = {}
                for i in edited.tolist():
                    size, rounds = plans[int(items.edits[i])]
                    if number < rounds:
                        words = items.words[i]
                        codes, places = walk.own(words[::-1] if turned else words, size)
                        places = len(words) - 1 - places if turned else places
                        by_bits.setdefault(size, []).append((codes, np.full(len(codes), i), places))
                tables = {size: _Codes(*map(np.concatenate, zip(*found))) for size, found in by_bits.items()}
                sampled.append((number, turned, tables))
        return whole, sampled

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SEPARATORS)
        walks = {number: _Walk(number) for number, _, _ in self.sampled}
        for batch in batches:
            if not len(self.items.size):
                continue
            for chunk in chunks(batch, "_text"):
                hashes, first = hasher.words(chunk.column("_text"))
                if len(hashes):
                    yield from self.matches(hasher, walks, hashes, first, chunk)
        del hasher, walks
        release_memory()

    def candidates(self, hasher: Hasher, walks: dict, hashes: np.ndarray, first: np.ndarray):
        """Places of the text, numbers of items, and where in these a place would lie, in bounded parts."""
        end = np.repeat(first[1:], np.diff(first))
        for width, table in self.whole:
            met = hasher.windows(hashes, width)
            inside = np.arange(len(met)) + width <= end[: len(met)]
            yield from table.meet(met, inside)
        turned_hashes, turned_end = hashes[::-1], len(hashes) - np.repeat(first[:-1], np.diff(first))[::-1]
        for number, turned, tables in self.sampled:
            given = (turned_hashes, turned_end) if turned else (hashes, end)
            for size, (codes, inside) in enumerate(walks[number].samples(*given, max(tables)), 1):
                if size in tables:
                    for place, item, offset in tables[size].meet(codes, inside):
                        yield (len(hashes) - 1 - place if turned else place), item, offset

    def matches(self, hasher: Hasher, walks: dict, hashes: np.ndarray, first: np.ndarray, chunk: pa.RecordBatch):
        items, good, asked, held = self.items, [], [], 0
        base = len(hashes) + 1

        def compare():
            each = np.unique(np.concatenate(asked))
            item, start = each // base, each % base
            row = np.searchsorted(first, start, side="right") - 1
            edits, begin = self.verify(hashes, first, row, start, item)
            near = edits <= items.edits[item]
            good.append((row[near], item[near], edits[near], begin[near]))

        for place, item, offset in self.candidates(hasher, walks, hashes, first):
            # a row of consecutive empty texts shares its first word; the last of them owns it
            row = np.searchsorted(first, place, side="right") - 1
            asked.append(np.unique(item * base + np.maximum(place - offset, first[row])))
            held += len(asked[-1])
            if held > HELD_PLACES:
                compare()
                asked, held = [], 0
        if asked:
            compare()
        if not good:
            return
        row, item, edits, begin = (np.concatenate(x) for x in zip(*good))
        if not len(row):
            return
        order = np.lexsort((begin, edits, item, row))
        row, item, edits, begin = row[order], item[order], edits[order], begin[order]
        best = np.ones(len(row), bool)
        best[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        row, item, edits, begin = row[best], item[best], edits[best], begin[best]
        ids = chunk.column("_id").take(pa.array(row))
        found = items.ids.take(pa.array(item))
        if isinstance(found, pa.ChunkedArray):
            found = found.combine_chunks()
        int32 = [pa.array(x.astype(np.int32)) for x in (edits, begin, items.size[item])]
        yield pa.record_batch([ids, found, *int32], names=[self.id_col, "item_id", "edits", "word_start", "n_item_words"])

    def verify(self, hashes, first, row, start, item):
        """Least edit distance between the item and any stretch of the text around the start that a met sample
        gives it, and that stretch's start. Rows come in order of items."""
        items = self.items
        edits, begin = np.full(len(start), 1 << 20), np.zeros(len(start), np.int64)
        for mine in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1) if len(item) else ():
            which = item[mine[0]]
            words, slack = items.words[which], int(items.edits[which])
            known = np.unique(words)
            # inserted and removed words before the sample move the start, those behind it the end
            width = len(words) + 2 * slack
            for part in np.array_split(mine, max(1, len(mine) * width // (1 << 20))):
                low = np.maximum(start[part] - slack, first[row[part]])
                place = low[:, None] + np.arange(width)[None, :]
                inside = place < first[row[part] + 1][:, None]
                text = np.where(inside, hashes[np.minimum(place, len(hashes) - 1)], _U(0))
                # all but the edited words of the item have to be there, in whatever order
                close = _among(text, known).sum(axis=1) >= len(words) - slack
                part, low, text, inside = part[close], low[close], text[close], inside[close]
                if len(part):
                    distance, offset = _best_stretch(words, text, inside)
                    edits[part], begin[part] = distance, low + offset - first[row[part]]
        return edits, begin


class _Codes:
    """Codes in order, each with an item and a place in it, and a small table of the codes' first bits."""

    def __init__(self, codes: np.ndarray, owners: np.ndarray, offsets: np.ndarray):
        order = np.argsort(codes, kind="stable")
        self.codes, self.owners, self.offsets = codes[order], owners[order], offsets[order]
        self.shift = _U(64 - min(max(16, len(codes).bit_length() + 5), 24))
        self.tops = np.zeros(1 << (64 - int(self.shift)), bool)
        self.tops[codes >> self.shift] = True

    def meet(self, met: np.ndarray, inside: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions of ``met`` with a known code, and its items and places, at most ``HELD_PLACES`` at a time but
        for one position's own."""
        near = np.flatnonzero(self.tops[met >> self.shift] & inside)
        low = np.searchsorted(self.codes, met[near], "left")
        many = np.searchsorted(self.codes, met[near], "right") - low
        near, low, many = near[many > 0], low[many > 0], many[many > 0]
        before = np.cumsum(many) - many
        cuts = np.flatnonzero(np.diff(before // HELD_PLACES)) + 1
        for part in np.split(np.arange(len(near)), cuts):
            if len(part):
                n = many[part]
                which = np.repeat(low[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield np.repeat(near[part], n), self.owners[which], self.offsets[which]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


def _best_stretch(words: np.ndarray, text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edit distance of ``words`` to the best stretch of each row of ``text``, and that stretch's start. Distance and
    start are one number (distance * base + start), so that the least number is the best distance and, among
    equals, the first start."""
    rows, width = text.shape
    base = width + 1
    columns = np.arange(width + 1)
    best = np.broadcast_to(columns, (rows, width + 1)).astype(np.int64).copy()
    far = np.int64(1) << 40
    blocked = np.concatenate([np.zeros((rows, 1), bool), ~inside], axis=1)
    best[blocked] = far
    for word in words:
        new = best + base
        np.minimum(new[:, 1:], best[:, :-1] + np.where(text == word, 0, base), out=new[:, 1:])
        # insertions: new[j] = min over i <= j of new[i] + (j - i) * base
        new = np.minimum.accumulate(new - columns * base, axis=1) + columns * base
        new[blocked] = far
        best = new
    least = best.min(axis=1)
    return least // base, least % base
