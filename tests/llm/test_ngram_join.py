import math
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from conftest import WORDS, prose

from tarmac.llm import ngram_join
from tarmac.llm.words import Hasher


def shingles(text, n=5):
    w = (text or "").split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    classes = {}
    for i, (doc, _) in enumerate(rows):
        classes.setdefault(root(i), []).append(doc)
    return Counter((doc, min(classes[root(i)]), links[i]) for i, (doc, _) in enumerate(rows))


def near_copies(count, edits, seed, size=60):
    draw, base = random.Random(seed), prose(seed, size).split()
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(len(w))] = draw.choice(WORDS)
        out.append(" ".join(w))
    return out


def check(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_links(df).collect())
    assert got == brute(rows)


def test_small_groups(spark):
    check(spark, near_copies(9, 2, 1) + near_copies(6, 6, 2, 150) + [prose(i, 40) for i in range(20, 40)] + ["a b", "a  b", "a b c"])


def test_group_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    check(spark, near_copies(70, 2, 3) + near_copies(30, 3, 4) + [prose(5, 60)] * 12)


def test_chain_is_one_class(spark):
    w = prose(9, 200).split()
    texts = []
    for i in range(12):
        w = list(w)
        w[i * 10 + 3] = f"new{i}"
        texts.append(" ".join(w))
    check(spark, texts)


def test_layout_reaches_recall():
    for threshold, recall in ((0.8, 0.999), (0.7, 0.99), (0.9, 0.9), (1.0, 0.99)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall - 1e-12 and bands * rows <= 64
        assert math.isfinite(bands)


def test_odd_rows(odd):
    out = ngram_join.ngram_links(odd).collect()
    assert len(out) == odd.count()
    by = Counter((r.doc_id, r.class_id, r.n_links) for r in out)
    assert by[(1, 1, 2)] == 1 and by[(2, 1, 2)] == 2 and by[(2, 2, 0)] == 1
    assert by[(7, 7, 1)] == 1 and by[(8, 7, 1)] == 1
    assert by[(3, 3, 0)] == by[(4, 4, 0)] == by[(5, 5, 0)] == 1 and by[(None, None, 0)] == 2
    assert ngram_join.ngram_links(odd.limit(0)).count() == 0


def test_one_per_class(odd):
    kept = ngram_join.one_per_class(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 2, None, None, 3, 4, 5, 6, 7, 9])
    doubled = odd.unionByName(odd).where("doc_id = 6 OR doc_id = 3")
    assert Counter(r.doc_id for r in ngram_join.one_per_class(doubled).collect()) == Counter([6, 3, 3])


@pytest.fixture(scope="module")
def long_block():
    """Near copies among long texts, as the rows of two blocks of one band."""
    rng = random.Random(5)
    texts = [prose(900 + i, rng.randint(3_000, 9_000)) for i in range(150)]
    texts += [texts[i] + " " + prose(i, 300) for i in range(30)] + ["", "one two"]
    columns = {c: pa.array([0] * len(texts), pa.int32()) for c in ("low", "high", "block")}
    columns |= {"bucket": pa.array([1] * len(texts), pa.int64()), "node": pa.array(range(len(texts)), pa.int64())}
    columns |= {"n": pa.array([1 + i % 3 for i in range(len(texts))], pa.int64()), "bands": pa.array([[1] * 14] * len(texts), pa.list_(pa.int64()))}
    return texts, pa.record_batch(columns | {"_text": pa.array(texts)})


def test_memory_of_long_texts_in_a_block(long_block):
    texts, batch = long_block
    tracemalloc.start()
    out = [r for found in ngram_join._Blocks(5, 0.8)([batch]) for r in found.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sets = [shingles(t) for t in texts]
    links = Counter()
    for i in range(150):
        for j in range(150, 180):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1 + j % 3
                links[j] += 1 + i % 3
    assert {r["node"]: r["links"] for r in out} == links and len(links) == 60
    # hashing at once took forty bytes for each of text
    assert peak < 20 * sum(map(len, texts))


def test_sets_do_not_depend_on_chunks(long_block, monkeypatch):
    texts = pa.array([*long_block[0][:9], None, "", "a b", *long_block[0][-3:]])
    whole = ngram_join._sets(Hasher(), texts, 5)
    for size in (1, 50_000):
        monkeypatch.setattr(ngram_join.chunks, "__defaults__", (size,))
        assert all((a == b).all() for a, b in zip(whole, ngram_join._sets(Hasher(), texts, 5)))
    assert [len(x) for x in ngram_join._sets(Hasher(), texts[:0], 5)] == [0, 1]
