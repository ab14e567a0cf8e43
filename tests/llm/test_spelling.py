import random
import re
import zlib
from collections import Counter

import pytest
from conftest import WORDS, prose
from pyspark.sql import functions as F

from tarmac.llm import spelling


def vocabulary(rows, least=3, chars=5, every=97):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= chars and n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups(words):
    out = {}
    for w, n in words.items():
        mine = [x for x in words if near(w, x)]
        best = min(mine, key=lambda x: (-words[x], x), default=None)
        out[w] = [best if best and words[best] >= 2 * n else None, n, len(mine)]
    rows = set()
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, n_near, words[form] if form else None))
    return rows


def made(seed, count, letters="abcdé"):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.choice([5, 5, 6, 6, 7, 9]))) for _ in range(count)}
    return {w: int(3 * 1.6 ** draw.randrange(12)) for w in words}


@pytest.mark.parametrize("block", [spelling.BLOCK_WORDS, 40])
@pytest.mark.parametrize("kind", ["dense", "common half", "few"])
def test_groups_equal_brute_force(spark, block, kind):
    words = made(1, 700)
    if kind == "common half":
        words = {"zzzzz" + w[:5]: n for w, n in words.items()} | {w[:4] + "yyyyy": n for w, n in words.items()}
        words |= {"ÿ" * 60 + "a": 9, "ÿ" * 61: 4, "ÿ" * 62: 3, "ø" * 5: 3, "øøøøa": 7}
    if kind == "few":
        words = {"aaaaa": 3, "aaaaaa": 6, "baaaaaa": 12, "aaaab": 100, "zebra": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    got = {tuple(r) for r in spelling.spelling_groups(df, block_words=block).collect()}
    assert got == groups(words)


def test_pairs_come_once(spark):
    words = made(2, 300, "ab")
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [(r.word, r.near) for r in spelling.near_words(df, 30).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if near(a, b)}


def test_index_without_table(monkeypatch):
    words = sorted(made(3, 200))
    asked = [w[1:] for w in words] + ["qqqqq"]
    exact = [len(w) // 2 for w in asked]
    import numpy as np

    fast = spelling.FMIndex(words).one_error(asked, np.array(exact))
    monkeypatch.setattr(spelling, "TABLE_CELLS", 0)
    monkeypatch.setattr(spelling, "READ_THROUGH", 0)
    slow = spelling.FMIndex(words).one_error(asked, np.array(exact))
    want = {(i, j) for i, (a, e) in enumerate(zip(asked, exact)) for j, b in enumerate(words) if near(a, b) and b.endswith(a[len(a) - e :])}
    assert {*zip(*map(list, fast))} == {*zip(*map(list, slow))} and {*zip(fast[0].tolist(), fast[1].tolist())} >= want


def test_counts(spark, odd):
    text = " ".join(f"{w}Ü×÷ {w.upper()}, x{w}-{w}1{w}" for w in WORDS)
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(i, text) for i in range(40)] + [(None, "SOMEWORD someword someword")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    got = {r.word: r.n for r in spelling.word_counts(df).collect()}
    assert got == vocabulary(rows) and got["someword"] == 3
    assert {r.word: r.n for r in spelling.word_counts(df, slip_every=3, min_count=1).collect()} == vocabulary(rows, 1, every=3)


def test_counts_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED_WORDS", 5)
    rows = [(i, prose(i % 4, 300)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == vocabulary(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(spelling.word_counts(df)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_groups(spelling.word_counts(df), factor=1)
