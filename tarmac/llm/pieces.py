"""SentencePiece models on the tokenizers library: encode and decode whole columns of texts."""

from __future__ import annotations

import hashlib
import os
import re
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import chunks, release_memory, short_batches

MARK = "▁"
#: Most bytes of a model file: its tokenizer is sent to every task.
MODEL_BYTES = 64 << 20
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    """What a model file says: pieces as (text, score, kind), the model kind and the normaliser's settings."""

    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    single_spaces: bool


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message's fields."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            if kind == 2:
                size, at = varint(at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def parse_model(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    return Model(
        pieces=pieces,
        kind=trainer.get(3, UNIGRAM),
        byte_fallback=bool(trainer.get(35, 0)),
        charsmap=normalizer.get(2, b""),
        dummy_prefix=bool(normalizer.get(3, 1)),
        single_spaces=bool(normalizer.get(4, 1)),
    )


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of a BPE model, best first: the higher the score of the joint piece, the earlier. Pieces of equal
    score (runs of spaces) grow from the left, so that the longer left part comes first."""
    scores = {text: score for text, score, kind in model.pieces if kind == NORMAL}
    found = []
    for text, score in scores.items():
        for cut in range(1, len(text)):
            if text[:cut] in scores and text[cut:] in scores:
                found.append((-score, -cut, text[:cut], text[cut:]))
    return [(left, right) for _, _, left, right in sorted(found)]


def build_core(model: Model):
    """The tokenizers library's model of the pieces; tokenizers made of it share its memory."""
    from tokenizers import models

    unknown = next((i for i, piece in enumerate(model.pieces) if piece[2] == UNKNOWN), None)
    if model.kind == BPE:
        return models.BPE(
            vocab={text: i for i, (text, _, _) in enumerate(model.pieces)},
            merges=merges(model),
            unk_token=model.pieces[unknown][0] if unknown is not None else None,
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    if model.kind == UNIGRAM:
        return models.Unigram([piece[:2] for piece in model.pieces], unknown, model.byte_fallback)
    raise ValueError("only unigram and BPE models are supported")


def build_normalizer(model: Model):
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.single_spaces:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", MARK))
    if model.single_spaces:
        steps.append(normalizers.Replace(Regex(rf"{MARK}+\z"), ""))
    return normalizers.Sequence(steps)


def build_tokenizer(data: bytes):
    """The tokenizers library's equal of a SentencePiece model file."""
    from tokenizers import Regex, decoders, pre_tokenizers

    model = parse_model(data)
    tokenizer = _parts_tokenizer(model, build_core(model))
    tokenizer.normalizer = build_normalizer(model)
    pattern, names = splitter(model), _names(model)
    cuts = [pre_tokenizers.Split(Regex(pattern), "isolated")] if pattern else []
    if names:
        cuts.append(pre_tokenizers.Split(Regex(names), "merged_with_previous"))
    if cuts:
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence(cuts)
    if model.dummy_prefix:
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), decoders.Strip(" ", 1, 0)]
        tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


def _parts_tokenizer(model: Model, core):
    """A tokenizer of the parts of an already normalised text (see ``splitter``)."""
    from tokenizers import AddedToken, Tokenizer, decoders

    tokenizer = Tokenizer(core)
    tokenizer.add_tokens([AddedToken(text, normalized=True) for text, _, kind in model.pieces if kind == USER_DEFINED])
    tokenizer.encode_special_tokens = True
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


def splitter(model: Model) -> str | None:
    """Pattern of the parts of a text that are encoded independently: runs of markers with the word after them.
    None if the model has a piece, or a user's symbol, that could cross their bounds."""
    crossing = (
        kind == USER_DEFINED or kind == NORMAL and re.search(f"[^{MARK}]{MARK}", text)
        for text, _, kind in model.pieces
    )
    return None if any(crossing) else f"{MARK}*[^{MARK}]+|{MARK}+"


def read_model(spark: SparkSession, path: str) -> bytes:
    """Bytes of a model file in any store that Spark reads."""
    found = spark.read.format("binaryFile").load(path).where(F.col("length") <= MODEL_BYTES)
    row = found.select("content").first()
    if row is None:
        raise ValueError(f"no model file of at most {MODEL_BYTES} bytes at {path}")
    return bytes(row[0])


def encode(
    df: DataFrame,
    model_path: str,
    text: str = "text",
    out: str = "token_ids",
    threads: int = 2,
    with_decoded: bool = True,
) -> DataFrame:
    """Add each whole text's token ids (array of int), the text they decode to, and whether it is the same.

    Columns ``out``, ``decoded`` and ``round_trip`` are added or replaced; without ``with_decoded`` the decoded text
    is compared in the task and left there. A null text gives null in all three, an empty one no tokens. Texts come
    back unchanged unless they hold the space marker itself, or the model's normaliser changes them;
    ``round_trip`` says so. Every worker builds the tokenizer from the model file's content once and works on slices of
    a quarter of a megabyte (a longer text is a slice of its own): texts are normalised and split at spaces, parts
    not met lately are encoded as batches with ``threads`` threads, and each text's tokens are put together from its
    parts. The decoded text is made of each row's own ids alone, as the bytes that its tokens stand for.
    """
    short_batches(df.sparkSession)
    data = read_model(df.sparkSession, model_path)
    rest = [c for c in df.columns if c not in (out, "decoded", "round_trip") or c == text]
    packed = df.select(F.struct(*rest).alias("_row"))
    added = [T.StructField("_ids", T.ArrayType(T.IntegerType())), T.StructField("_same", T.BooleanType())]
    if with_decoded:
        added.append(T.StructField("_back", T.StringType()))
    schema = T.StructType([packed.schema["_row"], *added])
    coded = packed.mapInArrow(_Coder(data, threads, rest.index(text), with_decoded), schema)
    decoded = [F.col("_back").alias("decoded")] if with_decoded else []
    return coded.select("_row.*", F.col("_ids").alias(out), *decoded, F.col("_same").alias("round_trip"))


def decode(df: DataFrame, model_path: str, ids: str = "token_ids", out: str = "text", threads: int = 2) -> DataFrame:
    """Add the text that each row's token ids stand for. Null ids give null, no ids the empty text."""
    data = read_model(df.sparkSession, model_path)
    rest = [c for c in df.columns if c != out]
    packed = df.select(F.struct(*rest).alias("_row"), F.col(ids).alias("_ids"))
    schema = T.StructType([packed.schema["_row"], T.StructField("_back", T.StringType())])
    return packed.mapInArrow(_Decoder(data, threads), schema).select("_row.*", F.col("_back").alias(out))


#: Different parts of texts that a task remembers with their tokens.
REMEMBERED = 60_000
#: Parts that are given to the library as one string, to be split there, and strings that are encoded at once.
JOINED, STRINGS = 128, 64
_SLICE_BYTES = 1 << 18


def _threads(count: int) -> None:
    """Set the threads of the tokenizers library before a task's first use of it."""
    os.environ["RAYON_NUM_THREADS"] = str(count)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"


def _built(data: bytes) -> tuple:
    """What a model file is made into: model, normaliser, tokenizers of single and of joined parts, surfaces of tokens.

    The last one is kept for the worker's later tasks, in a place of the interpreter's own because a task's code comes
    with the task: making it anew in each task would leave the worker's memory in pieces that it cannot give back.
    """
    from tokenizers import pre_tokenizers

    kept = sys.modules.setdefault("_tarmac_pieces", ModuleType("_tarmac_pieces"))
    key = hashlib.sha256(data).digest()
    if getattr(kept, "key", None) != key:
        model = parse_model(data)
        core = build_core(model)
        single, joined = _parts_tokenizer(model, core), _parts_tokenizer(model, core)
        joined.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="never", split=True)
        kept.key, kept.built = key, (model, build_normalizer(model), single, joined, _Surfaces(model))
    return kept.built


class _Parts:
    """Token ids of the parts met so far."""

    def __init__(self, model: Model, single, joined):
        self.single, self.joined = single, joined
        pieces = model.pieces
        # the token that opens a part behind a marker has the marker; without a piece for it, it would be bytes
        self.opens = np.array([text.startswith(MARK) for text, _, _ in pieces])
        self.can_join = any(text == MARK and kind == NORMAL for text, _, kind in pieces)

        self.number: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def forget(self, kept: int) -> None:
        """Forget all but the ``kept`` parts met first, among which are the most frequent ones."""
        self.number = {part: n for part, n in self.number.items() if n < kept}
        self.sizes = self.sizes[:kept].copy()
        self.ids = self.ids[: int(self.sizes.sum())].copy()

    def learn(self, parts: list[str]) -> None:
        # a word behind one marker is a part of its own in any string, so such parts go in joined
        joins = {x: self.can_join and x[0] == MARK and x.rfind(MARK) == 0 for x in parts}
        words, others = [x for x in parts if joins[x]], [x for x in parts if not joins[x]]
        strings = ["".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        tokens, sizes = [self.ids], [self.sizes]
        for own in self.encoded(self.joined, strings):
            starts = np.flatnonzero(self.opens[own])
            tokens.append(own)
            sizes.append(np.diff(np.append(starts, len(own))))
        for own in self.encoded(self.single, others):
            tokens.append(own)
            sizes.append(np.array([len(own)], np.int64))
        known = len(self.number)
        self.number.update(zip(words + others, range(known, known + len(parts))))
        self.ids, self.sizes = np.concatenate(tokens), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def encoded(tokenizer, strings: list[str]) -> Iterator[np.ndarray]:
        # the library's own record of a token takes many times the room of its id
        for i in range(0, len(strings), STRINGS):
            for coded in tokenizer.encode_batch_fast(strings[i : i + STRINGS], add_special_tokens=False):
                yield np.array(coded.ids, np.int32)


class _Surfaces:
    """The bytes that each token stands for, to rebuild texts from the ids that are handed out."""

    def __init__(self, model: Model):
        spelled = [
            bytes([int(text[3:-1], 16)]) if kind == BYTE else text.replace(MARK, " ").encode()
            for text, _, kind in model.pieces
        ]
        self.sizes = np.array([len(x) for x in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> list[str | None]:
        """The text of each row's ids; None where their bytes are no text."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        data = self.data[places + np.arange(len(places))].tobytes()
        bounds = np.concatenate([[0], ends])[offsets].tolist()
        return [_text(data[low:high]) for low, high in zip(bounds[:-1], bounds[1:])]


def _text(data: bytes) -> str | None:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


class _Coder:
    def __init__(self, data: bytes, threads: int, field: int, with_decoded: bool):
        self.data, self.threads, self.field, self.with_decoded = data, threads, field, with_decoded

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(self.threads)
        model, normalizer, single, joined, surfaces = _built(self.data)
        memory = _Parts(model, single, joined)
        plain = not model.charsmap and not model.single_spaces
        lead = MARK if model.dummy_prefix else ""
        split = _split(model)
        for batch in batches:
            rows = batch.column("_row")
            batch = pa.record_batch([rows, rows.flatten()[self.field]], names=["_row", "_text"])
            for chunk in chunks(batch, "_text", _SLICE_BYTES):
                texts = chunk.column("_text").to_pylist()
                if plain:
                    marked = [lead + x.replace(" ", MARK) if x else "" for x in texts]
                else:
                    marked = [normalizer.normalize_str(x) if x else "" for x in texts]
                parts = [split(x) if x else [] for x in marked]
                every = list(chain.from_iterable(parts))
                if len(memory.number) > REMEMBERED:
                    memory.forget(REMEMBERED // 2)
                new = list(set(every).difference(memory.number))
                if new:
                    memory.learn(new)
                places = np.fromiter(map(memory.number.__getitem__, every), np.int64, len(every))
                first = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
                values, offsets = self.tokens(memory, places, first)
                # decoded from what goes out, not from what came in
                back = surfaces.texts(values, offsets)
                for row in [n for n, x in enumerate(back) if x is None]:
                    own = values[offsets[row] : offsets[row + 1]].tolist()
                    back[row] = memory.single.decode(own, skip_special_tokens=False)
                if model.dummy_prefix:
                    back = [x.removeprefix(" ") for x in back]
                null = np.fromiter((x is None for x in texts), bool, len(texts))
                starts = pa.array(offsets, mask=np.append(null, False)) if null.any() else pa.array(offsets)
                same = np.fromiter((x == y for x, y in zip(back, texts)), bool, len(texts))
                columns = {
                    "_row": chunk.column("_row"),
                    "_ids": pa.ListArray.from_arrays(starts, pa.array(values)),
                    "_same": pa.array(same, mask=null),
                }
                if self.with_decoded:
                    columns["_back"] = pa.array(back, pa.string(), mask=null)
                yield pa.record_batch(columns)
        del memory
        release_memory()

    @staticmethod
    def tokens(memory: _Parts, places: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows, and where each row's begin, from the numbers of the parts."""
        if not len(places):
            return memory.ids[:0], np.zeros(len(first), np.int32)
        sizes = memory.sizes[places]
        ends = np.cumsum(sizes)
        values = memory.ids[np.repeat(memory.starts[places] - (ends - sizes), sizes) + np.arange(ends[-1])]
        return values, np.concatenate([[0], ends])[first].astype(np.int32)


def _split(model: Model):
    """Function that cuts a normalised text into its independent parts."""
    pattern, names = splitter(model), _names(model)
    if not pattern and not names:
        return lambda text: [text]
    cut = re.compile(pattern).findall if pattern else lambda text: [text]
    if not names:
        return cut
    inside = re.compile(names)

    def split(text: str) -> list[str]:
        out = []
        for part in cut(text):
            start = 0
            for found in inside.finditer(part):
                out.append(part[start : found.end()])
                start = found.end()
            out.append(part[start:])
        return out

    return split


def _names(model: Model) -> str | None:
    """Pattern of the first character of a piece's name that is not text (control and byte pieces), where the name
    itself stands in a text: unigram models would take it for the piece, so the text is cut behind it."""
    if model.kind != UNIGRAM:
        return None
    names = [text for text, _, kind in model.pieces if kind in (UNKNOWN, CONTROL, UNUSED, BYTE) and len(text) > 1]
    return "|".join(f"{re.escape(x[0])}(?={re.escape(x[1:])})" for x in names) or None


class _Decoder:
    def __init__(self, data: bytes, threads: int):
        self.data, self.threads = data, threads

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(self.threads)
        tokenizer = build_tokenizer(self.data)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column("_ids").to_pylist()
                back = tokenizer.decode_batch([x or [] for x in ids], skip_special_tokens=False)
                texts = pa.array([None if x is None else y for x, y in zip(ids, back)], pa.string())
                yield pa.record_batch([part.column("_row"), texts], names=["_row", "_back"])
