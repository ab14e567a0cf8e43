import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import prose

from tarmac.llm import boilerplate
from tarmac.llm.words import Hasher


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = len(lines) - len(set(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts(documents, odd):
    texts = [t for _, t in documents] + [r.text for r in odd.collect()]
    texts += ["a b c a b c", "a a a", "a a a a", "x\ny\nx\r\nx\n \n \n", "#*$%&|<>\n#*$%&|<>", "é é é\xa0é", "\n\n", "a\x0bb"]
    got = boilerplate.analyse(pa.array(texts), Hasher(), Hasher(b"\n"))[0]
    assert [tuple(r) for r in got.tolist()] == [base(t) for t in texts]


def brute_path(model, features):
    best, path = -np.inf, None
    for labels in itertools.product((1, 0), repeat=len(features)):
        score = model.opening[labels[0]] + sum(model.steps[a, b] for a, b in zip(labels, labels[1:]))
        score += sum(model.emissions[f].sum() for f, y in zip(features, labels) if y == 1)
        if score > best + 1e-12:
            best, path = score, labels
    return [y == 1 for y in path]


def random_lines(draw, lengths):
    sizes = [len(b) + 1 for b in boilerplate.BINS.values()]
    shift = np.cumsum([0, *sizes[:-1]])
    rows = np.repeat(np.arange(len(lengths)), lengths)
    return np.stack([draw.integers(n, size=len(rows)) for n in sizes], axis=1) + shift, rows


def test_best_path_is_the_best_of_all():
    draw = np.random.default_rng(1)
    for _ in range(20):
        model = boilerplate.LineModel(draw.normal(size=boilerplate.WIDTH), draw.normal(size=(2, 2)) * 2, draw.normal(size=2))
        lengths = draw.integers(1, 8, size=6)
        features, rows = random_lines(draw, lengths)
        rows = rows * 3  # texts without lines in between
        got = model.content(features, rows)
        for r in np.unique(rows):
            assert got[rows == r].tolist() == brute_path(model, features[rows == r])
    assert model.content(features[:0], rows[:0]).tolist() == []


def test_training_finds_the_likelihood_maximum():
    draw = np.random.default_rng(2)
    features, rows = random_lines(draw, draw.integers(1, 6, size=60))
    labels = (features[:, 2] % 2 == 0).astype(np.int64)

    def loss(model):
        total = 0.0
        for r in np.unique(rows):
            f, y = features[rows == r], labels[rows == r]
            def score(path):
                s = model.opening[path[0]] + sum(model.steps[a, b] for a, b in zip(path, path[1:]))
                return s + sum(model.emissions[x].sum() for x, p in zip(f, path) if p)
            total += np.logaddexp.reduce([score(p) for p in itertools.product((0, 1), repeat=len(f))]) - score(y)
        weights = np.concatenate([model.emissions, model.steps.reshape(-1), model.opening])
        return total + 0.5 * (weights**2).sum()

    model = boilerplate.train(features, rows, labels, rounds=600)
    at = loss(model)
    for k in range(0, boilerplate.WIDTH, 5):
        for step in (0.1, -0.1):
            moved = boilerplate.LineModel(model.emissions.copy(), model.steps, model.opening)
            moved.emissions[k] += step
            assert loss(moved) > at - 1e-3
    assert (model.content(features, rows) == (labels == 1)).mean() > 0.9


def junk(seed, n):
    return "\n".join(" | ".join(prose(seed + k, 12).upper().split()) for k in range(n))


def test_fit_and_judge(spark):
    rows = [(i, "\n".join(prose(i * 50 + k, 20) + "." for k in range(5)), 1) for i in range(60)]
    rows += [(1000 + i, prose(i, 6) + ".\n" + junk(i * 77, 6), 0) for i in range(40)]
    mixed = "\n".join(prose(9000 + k, 20) + "." for k in range(5)) + "\n" + junk(5, 30)
    df = spark.createDataFrame(rows + [(5000, mixed, None), (5001, prose(3, 49), None)], "doc_id long, text string, label int")
    model = boilerplate.fit(df.select("doc_id", "text"), df.select("doc_id", "label"), max_documents=30)
    got = {r.doc_id: r for r in boilerplate.judge(df, model).collect()}
    assert all(got[i].kept == (y == 1) for i, _, y in rows)
    assert not got[5000].kept and 0 < got[5000].content_share < 0.5
    assert got[5001].base_failed and not got[5001].kept
    with pytest.raises(ValueError):
        boilerplate.fit(df.select("doc_id", "text"), df.where("label = 1").select("doc_id", "label"))


def test_odd_rows(odd):
    model = boilerplate.LineModel(np.zeros(boilerplate.WIDTH), np.zeros((2, 2)), np.zeros(2))
    out = boilerplate.judge(odd, model)
    assert out.columns == [c for c in odd.columns if c != "text"] + [*boilerplate.COUNTS, "base_failed", "content_share", "kept"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and r.n_words == 0 and not r.kept for r in rows if r.doc_id in (3, 4, 5))
    assert [r.kept for r in rows if r.doc_id == 6] == [True]
    assert boilerplate.judge(odd.limit(0), model).count() == 0


def test_query(spark, folder, documents):
    from tarmac.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, folder).collect()}
    for doc_id, text in documents:
        n, chars, symbols, dup, repeat = want = base(text)
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n) and not (r.base_failed and r.kept)


def best_path(model, features):
    """Content or not of each line, by going through the labels of one text."""
    scores = [float(model.emissions[f].sum()) for f in features]
    paths = {0: (model.opening[0], []), 1: (model.opening[1] + scores[0], [])}
    for s in scores[1:]:
        # ties go to content before
        step = {y: max((paths[p][0] + model.steps[p, y], p) for p in (0, 1)) for y in (0, 1)}
        paths = {y: (step[y][0] + s * y, [*paths[step[y][1]][1], step[y][1]]) for y in (0, 1)}
    last = 1 if paths[1][0] >= paths[0][0] else 0
    return [*paths[last][1], last]


def test_verdict_of_the_query_recomputed(spark, folder, documents):
    import pyarrow as pa

    from tarmac.llm.queries import QUERIES
    from tarmac.llm.words import Hasher

    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = boilerplate.fit(docs.select("doc_id", "text"), labels.selectExpr("doc_id", "quality AS label"))
    rows = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, folder).collect()}
    for doc_id, text in documents:
        counts, _, words, features = boilerplate.analyse(pa.array([text], pa.string()), Hasher(), Hasher(b"\n"))
        path = best_path(model, features) if len(features) else []
        share = sum(w for w, y in zip(words.tolist(), path) if y) / max(int(counts[0, 0]), 1)
        assert rows[doc_id].content_share == pytest.approx(share)
        assert rows[doc_id].kept == (not rows[doc_id].base_failed and share >= 0.5)
