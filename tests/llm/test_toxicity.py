import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import prose
from pyspark.sql import functions as F

from tarmac.llm import toxicity
from tarmac.llm.decontaminate import SEPARATORS
from tarmac.llm.words import Hasher

BAD = "vileword nastyword foulword".split()


def corpus(count):
    rows = []
    for i in range(count):
        w = prose(i, 80).split()
        bad = i % 5 == 0
        if bad:
            for k in range(3):
                w.insert(7 + 20 * k, BAD[(i + k) % 3])
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_probabilities_against_plain_counts(spark):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    pairs = (
        df.select(F.col("label").alias("c"), F.col("text").alias("_text"))
        .mapInArrow(toxicity._Pairs(), "c int, u long, v long, n long")
        .groupBy("u", "v")
        .agg(*[F.sum(F.when(F.col("c") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)])
    )
    words = df.select(F.col("text").alias("_text")).mapInArrow(toxicity._Words(), "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    model = toxicity._model(pairs, words, 4, 1.0, 0.5)
    counts = [Counter(), Counter()]
    total = Counter()
    for _, text, c in rows:
        w = text.split()
        total.update(w)
        counts[c].update(zip(["<s>", *w], w))
    def lower(c, v):
        before = sum(1 for (_, b) in counts[c] if b == v)
        by_word = Counter(b for (_, b) in counts[c])
        mass = sum(min(n, 1.0) for n in by_word.values())
        shared = (total[v] + 1) / (sum(total.values()) + len(total) + 1)
        return (max(before - 1.0, 0) + mass * shared) / sum(by_word.values())
    def probability(c, u, v):
        p = lower(c, v)
        both = counts[0] + counts[1]
        context = sum(n for (a, _), n in both.items() if a == u)
        if context:
            p = (max(both[u, v] - 0.5, 0) + sum(min(n, 0.5) for (a, _), n in both.items() if a == u) * p) / context
        own = sum(n for (a, _), n in counts[c].items() if a == u)
        if own:
            p = (max(counts[c][u, v] - 0.5, 0) + sum(min(n, 0.5) for (a, _), n in counts[c].items() if a == u) * p) / own
        return p
    text = rows[0][1] + " " + rows[1][1][:60]
    w = text.split()
    got = model.token_evidence(*Hasher(SEPARATORS).words(pa.array([text])))
    checked = 0
    for i, (u, v) in enumerate(zip(["<s>", *w], w)):
        known = [x for x in (u, v) if x != "<s>" and max(sum(1 for (_, b) in counts[c] if b == x) for c in (0, 1)) <= 1]
        if known:
            continue  # words below the discount are left to the shared counts
        assert got[i] == pytest.approx(math.log(probability(1, u, v) / probability(0, u, v)), abs=1e-9)
        checked += 1
    assert checked > 30


def test_best_window():
    model = toxicity.ToxicityModel.__new__(toxicity.ToxicityModel)
    model.window = 3
    draw = np.random.default_rng(2)
    sizes = [0, 2, 3, 7, 0, 1, 30]
    first = np.concatenate([[0], np.cumsum(sizes)])
    values = draw.normal(size=first[-1])
    model.token_evidence = lambda hashes, first: values
    got = model.evidence(np.zeros(first[-1], np.uint64), first)
    for i, n in enumerate(sizes):
        own = values[first[i] : first[i + 1]]
        want = 0 if n == 0 else own.mean() if n <= 3 else max(own[k : k + 3].mean() for k in range(n - 2))
        assert got[i] == pytest.approx(want)


def test_classifies_and_bounds_the_sample(spark):
    rows = corpus(600)
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(df.select("doc_id", "text"), df.where("doc_id % 3 != 1").select("doc_id", "label"))
    scored = toxicity.score(df, model).collect()
    wrong = [r for r in scored if (r.score >= 0.7) != (r.label == 1)]
    assert len(wrong) <= 6
    few = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "label"), max_documents=50)
    assert few.totals.max() < model.totals.max()
    with pytest.raises(ValueError):
        toxicity.fit(df.select("doc_id", "text"), df.where("label = 0").select("doc_id", "label"))


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0), (2, 1), (9, 0), (6, 0), (7, 1), (8, 1), (None, 1), (7, 0), (5, None), (4, 7)], "doc_id long, label int")
    model = toxicity.fit(odd.select("doc_id", "text"), labels, pair_discounts=(None, 1.0))
    scored = toxicity.score(odd, model)
    assert scored.columns == ["doc_id", "lang", "source", "n_chars", "node", "evidence", "score"]
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.evidence == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_counts_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_WORDS", 50)
    texts = [prose(i, 200) for i in range(10)]
    df = spark.createDataFrame([(t,) for t in texts], "_text string").coalesce(1)
    got = df.mapInArrow(toxicity._Words(), "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    assert sorted(r.n for r in got.collect()) == sorted(Counter(" ".join(texts).split()).values())


def test_held_out_accuracy(spark, folder):
    from tarmac.llm.queries import QUERIES

    folder = folder.replace("sf0.001", "sf0.1")
    rows = QUERIES["op10_toxicity"](spark, folder)
    held = rows.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    right = held.select(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    flagged = held.where("toxic = 0").select(F.avg("predicted")).first()[0]
    assert right >= 0.95 and flagged <= 0.01


def test_best_windows_share_no_word():
    draw = np.random.default_rng(4)
    sizes = [0, 2, 3, 7, 0, 1, 30, 4]
    first = np.concatenate([[0], np.cumsum(sizes)])
    values = draw.normal(size=first[-1])
    got = toxicity.best_means(values, first, 3, 3)
    for i, n in enumerate(sizes):
        own, left, means = values[first[i] : first[i + 1]], set(range(max(n - 2, 0))), []
        while left and len(means) < 3:
            at = max(left, key=lambda k: own[k : k + 3].mean())
            means.append(own[at : at + 3].mean())
            left -= set(range(at - 2, at + 3))
        for k in range(3):
            want = 0 if n == 0 else own.mean() if n <= 3 else np.mean(means[: k + 1])
            assert got[i, k] == pytest.approx(want)


def test_toxic_words_elsewhere_in_the_text_count():
    model = toxicity.ToxicityModel.__new__(toxicity.ToxicityModel)
    model.window, model.windows = 2, 3
    once, often = np.full(60, -1.0), np.full(60, -1.0)
    once[[5, 6]] = often[[5, 6, 25, 26, 45, 46]] = 3.0
    model.token_evidence = lambda hashes, first: np.concatenate([once, often])
    got = model.evidence(np.zeros(120, np.uint64), np.array([0, 60, 120]))
    assert got[1] > got[0] + 1


def test_held_out_recall(spark, folder):
    from tarmac.llm.queries import QUERIES

    folder = folder.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    held = QUERIES["op10_toxicity"](spark, folder).where("held_out").join(labels, "doc_id")
    by = held.groupBy("lang").agg(
        *[F.sum(((F.col("toxic") == c) & (F.col("predicted") == 1)).cast("int")).alias(f"flagged{c}") for c in (0, 1)],
        *[F.sum((F.col("toxic") == c).cast("int")).alias(f"of{c}") for c in (0, 1)],
    )
    found = {r.lang: r for r in by.collect()}
    assert sum(r.flagged1 for r in found.values()) >= 0.9 * sum(r.of1 for r in found.values()), found
    for r in found.values():
        assert r.flagged0 <= 0.01 * r.of0 and (r.of1 < 10 or r.flagged1 >= 0.8 * r.of1), found
    print(sorted(found.values()))


def test_evidence_of_fixed_expressions(spark):
    # "alpha beta" is counted above the pair discount, but alpha has one predecessor and few followers
    draw, rows = np.random.default_rng(6), []
    for i in range(120):
        w, bad = prose(i, 30).split(), i % 3 == 0
        if i % 6 == 0 or i % 30 == 1:
            w[10:10] = ["lead", "alpha", "beta" if draw.random() < 0.9 else "gamma"]
        rows.append((i, " ".join(w), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    pairs = (
        df.select(F.col("label").alias("c"), F.col("text").alias("_text"))
        .mapInArrow(toxicity._Pairs(), "c int, u long, v long, n long")
        .groupBy("u", "v")
        .agg(*[F.sum(F.when(F.col("c") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)])
    )
    corpus = df.select(F.col("text").alias("_text")).mapInArrow(toxicity._Words(), "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    taken, pair_taken = 4.0, 12.0
    model = toxicity._model(pairs, corpus, 1, taken, pair_taken)
    total, counts = Counter(), [Counter(), Counter()]
    for _, text, c in rows:
        total.update(text.split())
        counts[c].update(zip(["<s>", *text.split()], text.split()))
    both = counts[0] + counts[1]
    assert pair_taken < both["alpha", "beta"] < 4 * pair_taken

    def level(of, u, v, below):
        after = [n for (a, _), n in of.items() if a == u]
        return (max(of[u, v] - pair_taken, 0) + sum(min(n, pair_taken) for n in after) * below) / sum(after) if after else below

    def probability(c, u, v):
        before = Counter(b for _, b in counts[c])
        shared = (total[v] + 1) / (sum(total.values()) + len(total) + 1)
        below = (max(before[v] - taken, 0) + sum(min(n, taken) for n in before.values()) * shared) / sum(before.values())
        return level(counts[c], u, v, level(both, u, v, below))

    for _, text, _ in rows[:7]:
        w = text.split()
        got = model.token_evidence(*Hasher(SEPARATORS).words(pa.array([text])))
        for i, (u, v) in enumerate(zip(["<s>", *w], w)):
            assert got[i] == pytest.approx(math.log(probability(1, u, v) / probability(0, u, v)), abs=1e-9), (u, v)


def test_score_recomputed_by_hand(spark):
    """The query's score from the model's own tables: mean of the best windows, length and constant."""
    import numpy as np
    import pyarrow as pa

    texts = ["you idiot moron go away " * 3, "a calm and kind day in the park", "", "idiot"] * 6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("idiot" in t)) for i, t in enumerate(texts)] + [(999, 1)], "doc_id long, label int")
    model = toxicity.fit(docs, labels, pair_discounts=(0.5,), word_discount=0.5)
    assert model.pairs is not None
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    hasher = Hasher(SEPARATORS)
    for i, text in enumerate(texts):
        hashes, first = hasher.words(pa.array([text.lower()]))
        values = list(model.token_evidence(hashes, first)) if len(hashes) else []
        taken, means = set(), []
        for _ in range(model.windows):
            width = min(model.window, len(values))
            free = [j for j in range(len(values) - width + 1) if width and not taken & set(range(j, j + width))]
            if not free:
                break
            best = max(free, key=lambda j: np.mean(values[j : j + width]))
            means.append(np.mean(values[best : best + width]))
            taken |= set(range(best, best + width))
        z = model.slope * (np.mean(means) if means else 0.0) + model.length * np.log1p(len(values)) + model.offset
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
    assert min(got[i] for i, t in enumerate(texts) if "idiot" in t) > max(got[i] for i, t in enumerate(texts) if "idiot" not in t)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int")
    model = toxicity.fit(docs, labels)
    other = spark.createDataFrame([(5, "some words"), (6, None)], "doc_id long, text string")
    assert {r.score for r in toxicity.score(other, model).collect()} == {0.5}
