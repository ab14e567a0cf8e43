import random
import re

import pytest
from conftest import WORDS, prose
from pyspark.sql import functions as F

from tarmac.llm import decontaminate
from tarmac.llm.queries import QUERIES


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def best(item, text):
    """Least edit distance of the item to any stretch of the text, and the first start among the best."""
    row = [(0, j) for j in range(len(text) + 1)]
    for x in item:
        new = [(row[0][0] + 1, row[0][1])]
        for j, y in enumerate(text, 1):
            step = (row[j - 1][0] + (x != y), row[j - 1][1])
            new.append(min(step, (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    return min(row)


def edited(draw, item, edits):
    w = item.split()
    for _ in range(edits):
        p, kind = draw.randrange(len(w) + 1), draw.random()
        if kind < 0.3:
            w.insert(p, draw.choice(WORDS))
        elif kind < 0.6:
            del w[min(p, len(w) - 1)]
        else:
            w[min(p, len(w) - 1)] = "changed"
    return " ".join(w)


def test_recall_and_exactness(spark):
    draw = random.Random(3)
    items = [(i, prose(1000 + i, draw.choice([8, 15, 20, 31, 32, 45, 70]))) for i in range(60)]
    docs, planted = [], {}
    for d in range(400):
        i, item = draw.choice(items)
        edits = draw.randint(0, len(item.split()) // 10 + 1)
        docs.append((d, f"{prose(d, draw.randint(0, 60))}. {edited(draw, item, edits)}\n{prose(5000 + d, draw.randint(0, 40))}"))
        planted[d] = (i, item)
    docs += [(d, prose(d + 9000, 120)) for d in range(400, 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    texts, by_item = {d: words(t) for d, t in docs}, dict(items)
    got = {(r.doc_id, r.item_id): r for r in found}
    assert len(got) == len(found)
    for (d, i), r in got.items():
        item = words(by_item[i])
        assert (r.edits, r.word_start) == best(item, texts[d]) and r.edits <= len(item) // 10 and r.n_item_words == len(item)
    expected = {
        (d, i) for d, (i, item) in planted.items() if best(words(item), texts[d])[0] <= len(item.split()) // 10
    }
    exact = {(d, i) for d, i in expected if best(words(by_item[i]), texts[d])[0] == 0}
    assert exact <= set(got)
    assert len(expected & set(got)) >= 0.95 * len(expected)


def test_case_and_punctuation(spark):
    item = "One two three, four five six -- seven eight NINE ten."
    docs = [(1, "x\tONE two\nthree four 'five' six seven; eight nine ten y"), (2, "one two three four"), (3, item)]
    items = spark.createDataFrame([(7, item), (8, "one two"), (9, None), (10, "..."), (11, "Ten")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.contaminated(df, items, min_words=8).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(1, 7, 0), (3, 7, 0)]
    # short items are looked up whole
    found = {(r.doc_id, r.item_id, r.edits, r.word_start) for r in decontaminate.contaminated(df, items).collect()}
    assert found == {(1, 7, 0, 1), (3, 7, 0, 0), (1, 8, 0, 1), (2, 8, 0, 0), (3, 8, 0, 0), (1, 11, 0, 10), (3, 11, 0, 9)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(df, items).collect()] == [2]


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    items = [(i, prose(i, 20)) for i in range(12)]
    docs = [(i, f"a b {text} c") for i, text in items]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(i, i) for i in range(12)]


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, prose(4, 90)), (2, prose(1, 60_000)), (2, prose(1, 60_000))], "item_id long, text string")
    found = decontaminate.contaminated(odd, items.where("item_id = 1")).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in found] == [(None, 1, 0)]
    named = odd
    for name in ("_row", "row", "own", "key", "cell", "met", "item_id", "_id", "_item", "_text", "hash"):
        named = named.withColumn(name, F.lit(1))
    kept = decontaminate.drop_contaminated(named, items.where("item_id = 1"))
    assert kept.columns == named.columns and kept.count() == odd.count() - 1
    assert decontaminate.contaminated(odd.limit(0), items.where("item_id = 1")).count() == 0
    assert decontaminate.contaminated(odd, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == odd.count()


def test_query(spark, folder, documents):
    import duckdb

    items = duckdb.execute(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    rows = QUERIES["op2_benchmark_decontamination"](spark, folder).collect()
    exact = {
        (d, i)
        for d, t in documents
        for i, item in items
        if len(words(item)) >= 8 and f" {' '.join(words(item))} " in f" {' '.join(words(t))} "
    }
    assert exact and {(r.doc_id, r.item_id) for r in rows if r.edits == 0} == exact


def clustered(draw, item, edits, where):
    """The item with ``edits`` neighbouring words removed, replaced or inserted at one place."""
    w, kind = item.split(), draw.randrange(3)
    at = {"start": 0, "middle": (len(w) - edits) // 2, "end": len(w) - edits}[where]
    new = [f"changed{draw.randrange(10**9)}" for _ in range(edits)]
    return " ".join(w[:at] + (new if kind else []) + w[at + (0 if kind == 2 else edits) :])


def pieces_meet(item, text, edits):
    """Exact reference: an item with k edits keeps one of k + 1 pieces whole."""
    length = len(item) // (edits + 1)
    grams = {tuple(text[j : j + length]) for j in range(len(text) - length + 1)}
    return any(tuple(item[p * length : (p + 1) * length]) in grams for p in range(edits + 1))


def test_recall_of_every_size_wherever_the_edits_lie(spark):
    draw = random.Random(11)
    sizes, places = [8, 10, 15, 20, 29, 40, 59, 100], ["start", "middle", "end", "any"]
    items = [(i, prose(2000 + i, size)) for i, size in enumerate(sizes * 6)]
    docs, planted = [], {}
    for d in range(len(items) * 32):
        i, item = items[d % len(items)]
        where = places[d // len(items) % 4]
        edits = len(item.split()) // 10
        changed = edited(draw, item, edits) if where == "any" else clustered(draw, item, edits, where)
        # every other text begins or ends with the item
        docs.append((d, f"{prose(d, draw.choice([0, 50]))}. {changed}\n{prose(7000 + d, draw.choice([0, 50]))}"))
        planted[d] = i, len(item.split()), where
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got, texts, by_item = {(r.doc_id, r.item_id): (r.edits, r.word_start) for r in found}, dict(docs), dict(items)
    assert len(got) == len(found)
    seen = {}
    for d, (i, size, where) in planted.items():
        item, text = words(by_item[i]), words(texts[d])
        assert pieces_meet(item, text, size // 10)
        if (d, i) in got:
            assert got[d, i] == best(item, text)
        seen.setdefault((size, where), []).append((d, i) in got)
    assert len(seen) == 32 and all(len(x) == 48 for x in seen.values())
    assert {k: sum(x) / 48 for k, x in seen.items() if sum(x) < 0.95 * 48} == {}


def test_simulated_recall():
    size, rounds = decontaminate.sampling_plan(15, 1, 0.97, 4)
    assert size == 4 and 1 <= rounds <= decontaminate.MAX_REPETITIONS
    assert decontaminate.sampling_plan(15, 1, 0.5, 4)[1] <= rounds
    # dense edits take smaller samples, and a large item those of one of the simulated size
    assert decontaminate.sampling_plan(16, 5, 0.97, 4)[0] < 4
    assert decontaminate.sampling_plan(60_000, 6_000, 0.97, 4) == decontaminate.sampling_plan(1000, 100, 0.97, 4)


def test_walk_samples_stay_in_their_text():
    import numpy as np

    hashes = np.random.default_rng(1).integers(0, 1 << 63, 60, np.int64).view(np.uint64)
    walk, end = decontaminate._Walk(0), np.repeat([20, 25, 60], [20, 5, 35])
    together = list(walk.samples(hashes, end, 4))
    for low, high in ((0, 20), (20, 25), (25, 60)):
        alone = walk.samples(hashes[low:high], np.full(high - low, high - low), 4)
        for (code, inside), (own, there) in zip(together, alone):
            assert (inside[low:high] == there).all() and (code[low:high][there] == own[there]).all()
    onward = walk.onward(hashes)
    assert ((onward > np.arange(60)) & (onward <= np.arange(60) + decontaminate.PERIOD) | (onward == 60)).all()


def test_places_are_verified_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "HELD_PLACES", 3)
    items = [(i, f"{prose(1, 12)} {prose(50 + i, 12)}") for i in range(8)]
    docs = [(i, f"a b {text} c {text}") for i, text in items]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.item_id, r.edits, r.word_start) for r in found if r.edits == 0) == [(i, i, 0, 2) for i in range(8)]


def test_many_edits_and_short_items(spark):
    draw = random.Random(17)
    items = [(i, prose(3000 + i, draw.choice([8, 9, 15, 16, 31, 33, 60]))) for i in range(30)]
    docs, planted = [], {}
    for d in range(150):
        i, item = draw.choice(items)
        changed = clustered(draw, item, int(len(item.split()) * 0.3 + 1e-9), ["start", "middle", "end"][d % 3])
        docs.append((d, f"{prose(d, 30)}. {changed}\n{prose(8000 + d, 30)}"))
        planted[d] = i
    df, by_item, texts = spark.createDataFrame(docs, "doc_id long, text string"), dict(items), dict(docs)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(df, wanted, max_edit_share=0.3, recall=0.999).collect()
    got = {(r.doc_id, r.item_id): (r.edits, r.word_start) for r in found}
    assert sum((d, i) in got for d, i in planted.items()) >= 0.98 * len(planted)
    for d, i in planted.items():
        assert (d, i) not in got or got[d, i] == best(words(by_item[i]), words(texts[d]))
    for share in (-0.1, 1.0):
        with pytest.raises(ValueError):
            decontaminate.contaminated(df, wanted, max_edit_share=share)
