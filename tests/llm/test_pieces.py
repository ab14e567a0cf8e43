import random
import struct

import pytest
import sentencepiece
from conftest import prose

from tarmac.llm import pieces
from tarmac.llm.queries import PIECES, QUERIES


def field(number, value):
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def hand_made(kind, found, byte_fallback=True, dummy_prefix=1, single_spaces=0):
    """A model file written by hand, its pieces and scores given."""
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    listed += [(text, score, 1) for text, score in found]
    out = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in listed)
    trainer = field(3, kind) + field(4, len(listed)) + field(35, int(byte_fallback))
    trainer += field(40, 0) + field(41, 1) + field(42, 2) + field(43, (1 << 64) - 1)
    normal = field(1, b"identity") + field(3, dummy_prefix) + field(4, single_spaces) + field(5, 1)
    return out + field(2, trainer) + field(3, normal)


SCORED = [("▁", -2.0), ("a", -3.0), ("b", -3.1), ("▁a", -2.5), ("ab", -2.2), ("▁ab", -2.9), ("ba", -2.7), ("aba", -4.0), ("▁b", -3.3), ("é", -5.0)]


def odd_texts(seed, count):
    draw = random.Random(seed)
    parts = [" ", "  ", "a", "b", "ab", "aba", "the", "\n", "é", "梦", "\U0001f600", "<s>", "1", "\t", "▁", "<0x0A>", "   "]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(count)]


@pytest.mark.parametrize("single_spaces", [0, 1])
@pytest.mark.parametrize("dummy_prefix", [0, 1])
def test_unigram_parity(dummy_prefix, single_spaces):
    data = hand_made(pieces.UNIGRAM, SCORED, dummy_prefix=dummy_prefix, single_spaces=single_spaces)
    ours, theirs = pieces.build_tokenizer(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in odd_texts(1, 500):
        got = ours.encode(text, add_special_tokens=False).ids if text else []
        assert got == theirs.encode(text), text


def test_bpe_parity_on_the_public_model(documents):
    data = open(PIECES, "rb").read()
    ours, theirs = pieces.build_tokenizer(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = [t for _, t in documents] + odd_texts(2, 2000) + [" " * n + "x" for n in range(40)] + [" " * n for n in range(1, 40)]
    texts = [t for t in texts if t]
    assert [x.ids for x in ours.encode_batch(texts, add_special_tokens=False)] == theirs.encode(texts)
    for i in range(theirs.get_piece_size()):
        piece = theirs.id_to_piece(i)
        assert pieces.parse_model(data).pieces[i][0] == piece if i < 300 or i % 997 == 0 else True


@pytest.mark.parametrize("kind", [pieces.UNIGRAM, pieces.BPE])
def test_frames_equal_the_library(spark, tmp_path, kind):
    path = tmp_path / "m.model"
    path.write_bytes(hand_made(kind, SCORED))
    theirs = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = odd_texts(3, 300)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    rows = pieces.encode(df, str(path)).collect()
    for r in rows:
        assert list(r.token_ids) == theirs.encode(texts[r.id])
        assert r.round_trip == (r.decoded == texts[r.id])
        assert r.round_trip or "▁" in texts[r.id]
    back = pieces.decode(spark.createDataFrame(rows).select("id", "token_ids", "decoded"), str(path), out="again")
    assert all(r.again == r.decoded for r in back.collect())


def test_odd_rows(odd):
    out = pieces.encode(odd, PIECES)
    assert out.columns == [*odd.columns, "token_ids", "decoded", "round_trip"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.text is None:
            assert r.token_ids is None and r.decoded is None and r.round_trip is None
        else:
            assert r.decoded == r.text and r.round_trip and (len(r.token_ids) > 0) == (r.text != "")
    assert pieces.encode(odd.limit(0), PIECES).count() == 0
    decoded = pieces.decode(out.select("doc_id", "token_ids", "decoded"), PIECES).collect()
    assert all(r.text == r.decoded for r in decoded)


@pytest.mark.parametrize("wrong", ["reversed", "shifted", "next row"])
def test_wrong_ids_do_not_come_back(monkeypatch, wrong):
    import pyarrow as pa

    right = pieces._Coder.tokens

    def tokens(memory, places, first):
        values, offsets = right(memory, places, first)
        if wrong == "next row":
            return values, offsets[[0, *range(2, len(offsets)), len(offsets) - 1]]
        return values[::-1] if wrong == "reversed" else values[[*range(1, len(values)), 0]], offsets

    texts = [prose(i, 20) for i in range(8)]
    batch = pa.record_batch([pa.StructArray.from_arrays([pa.array(texts)], names=["text"])], names=["_row"])
    coder = pieces._Coder(open(PIECES, "rb").read(), 1, 0, True)
    same = [x for out in coder(iter([batch])) for x in out.column("_same").to_pylist()]
    assert all(same)
    monkeypatch.setattr(pieces._Coder, "tokens", staticmethod(tokens))
    out = pa.Table.from_batches(list(coder(iter([batch]))))
    assert not any(out["_same"].to_pylist()) and not set(out["_back"].to_pylist()) & {texts[0]}


def test_many_parts_are_forgotten(spark, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    texts = [prose(i, 30) for i in range(20)]
    theirs = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    assert all(list(r.token_ids) == theirs.encode(texts[r.id]) for r in pieces.encode(df, PIECES).collect())


def test_query(spark, folder, documents):
    import hashlib

    theirs = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        ids = theirs.encode(text)
        r = rows[doc_id]
        assert (r.n_tokens, r.round_trip) == (len(ids), True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_missing_or_large_model(spark, tmp_path, monkeypatch):
    (tmp_path / "m").write_bytes(b"x" * 100)
    monkeypatch.setattr(pieces, "MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        pieces.read_model(spark, str(tmp_path / "m"))
