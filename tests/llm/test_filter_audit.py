import re
from collections import Counter
from itertools import permutations

import pytest
from conftest import prose
from pyspark.sql import functions as F

from tarmac.llm import filter_audit
from tarmac.llm.filter_audit import Trie, _Ranges, common_length


def masks(rows):
    """(id, part, mask) of (id, text, part) rows, straight from the definition."""
    out = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = any((t or "") == text and j is not None and (i is None or j < i) for j, t, _ in rows)
        fails = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)), copy,
        ]
        out.append((i, part or "", sum(1 << k for k, x in enumerate(fails) if x)))
    return out


def as_counts(df):
    found = Counter()
    for r in df.collect():
        found[r.doc_id, r.part, r["mask"]] += r.n_rows
    return found


@pytest.fixture(scope="module")
def corpus():
    opening = prose(50, 400)
    rows = [(i, prose(i, 90 + i % 30), "en" if i % 3 else None) for i in range(60)]
    rows += [(100 + i, f"{opening} {prose(i % 7, 4)}", "de") for i in range(50)]
    rows += [(200 - i, prose(3, 50), "fr") for i in range(40)] + [(160, opening, "de"), (162, opening, "fr"), (5, "Same", "en"), (5, "Same", "en")]
    return rows + [(None, "Same", "en"), (None, None, "en"), (3, "", "en"), (7, "A#", None), (8, "ÀÉ é" * 40, "fr"), (None, "null id only", "en")]


@pytest.mark.parametrize("heavy", [filter_audit.HEAVY_BYTES, 600, 1])
def test_masks(spark, corpus, heavy):
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string").repartition(7)
    got = filter_audit.filter_masks(df, heavy_bytes=heavy)
    assert got.columns == ["doc_id", "part", "mask", "n_rows"]
    assert as_counts(got) == Counter(masks(corpus))


def test_small_tries_are_read_out_in_order(spark, corpus, monkeypatch):
    for name in ("TRIE_BYTES",):
        monkeypatch.setattr(filter_audit, name, 1500)
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string").repartition(3)
    assert as_counts(filter_audit.filter_masks(df)) == Counter(masks(corpus))


def test_heavy_prefixes_are_split_or_settled(spark, corpus):
    rows = spark.createDataFrame(corpus, "id long, text string, lang string").select("id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    ranges = filter_audit.heavy_prefixes(rows, 5_000)
    assert ranges.single and ranges.deeper
    sizes = Counter()
    for _, text, _ in corpus:
        sizes[ranges.key((text or "").encode())[0]] += len((text or "").encode())
    assert all(n <= 5_000 or key in ranges.single for key, n in sizes.items())


def test_rounds_for_near_copies(spark, monkeypatch):
    # a byte changed at another place in each: behind every change all later copies are still alike
    base = prose(60, 900)[:4000]
    rows = [(i, base[: 40 + 39 * i] + "~" + base[41 + 39 * i :], "en") for i in range(100)] + [(500, base, "en"), (501, base, "de")]
    rows += [(1000 + i, prose(i, 120), "fr") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    rounds = []
    keep = filter_audit.materialize
    monkeypatch.setattr(filter_audit, "materialize", lambda table: rounds.append(1) or keep(table))
    assert as_counts(filter_audit.filter_masks(df, heavy_bytes=9_000)) == Counter(masks(rows))
    assert 2 < len(rounds) <= 7


def test_odd_rows(spark, odd):
    given = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    named = odd.withColumn("mask", F.lit(1)).withColumn("key", F.lit("x")).withColumn("part", F.lit(1)).withColumn("id", F.lit(2))
    assert as_counts(filter_audit.filter_masks(named)) == Counter(masks(given))
    assert filter_audit.filter_masks(odd.limit(0)).count() == 0


def test_report(spark, corpus):
    ids = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 220, 2)] + [(3, 1, True), (3, 0, False), (None, 1, True), (9999, 1, True)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(5, None, 1)]
    counts = filter_audit.mask_counts(filter_audit.filter_masks(ids), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.interaction_report(counts).collect()}
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    found = masks(corpus)
    parts = {p for _, p, _ in found}
    assert len(got) == 600 * len(parts)
    removed = Counter()
    for part in parts:
        own = [(i, m) for i, p, m in found if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                gone = [x for x in left if x[1] & bit]
                left = [x for x in left if not x[1] & bit]
                r = got[part, "".join(order), step]
                assert (r.kept, r.removed, r.redundant) == (len(left), len(gone), sum(1 for x in own if x[1] & bit) - len(gone))
                assert r.unique_fails == sum(1 for x in own if x[1] == bit)
                assert r.good_lost == sum(1 for x in gone if x[0] in good) and r.toxic_lost == sum(1 for x in gone if x[0] in toxic)
                removed[part, name] += len(gone)
    assert all(r.shapley == removed[p, o[s - 1]] for (p, o, s), r in got.items())


def test_trie():
    trie, words = Trie(), [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abcabc", b"ab"]
    for w in words:
        node = trie.terminal(w)
        node[0] = (node[0] or []) + [w]
    assert sorted(trie.values()) == sorted([[w] for w in set(words) - {b"ab"}] + [[b"ab", b"ab"]])
    assert common_length(b"abcd", b"abxd") == 2 and common_length(b"", b"x") == 0 and common_length(b"ab", b"abc") == 2


def test_text_that_is_a_heavy_prefix():
    ranges = _Ranges()
    text = b"x" * 32
    ranges.deeper[filter_audit.prefix_key(text, 32)] = 90
    assert ranges.key(text)[0] != ranges.key(text + b"y")[0] and ranges.key(text)[1]
