import hashlib
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest import prose  # noqa: F401  (tests/llm/conftest.py comes first on the path)

from tarmac.llm import substring


def brute(texts, width=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(spark, texts, width=35):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in substring.repeated_windows_removed(df, width=width).collect()}
    want = brute(texts, width)
    assert len(got) == len(texts)
    for i, (n, removed, kept) in enumerate(want):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (n, removed, kept), i
    return got


def test_passages_at_every_offset(spark):
    passage = prose(50, 35)
    texts = [prose(100 + i, i) + " " + passage + " " + prose(200 + i, 10) for i in range(25)]
    texts += [prose(300, 70), prose(301, 34), prose(302, 40) + " " + " ".join(prose(50, 35).split()[:34])]
    check(spark, texts)


def test_inside_one_text_and_overlapping(spark):
    part = prose(7, 60)
    loop = " ".join(["la la lu"] * 40)
    check(spark, [part + " x " + part, loop, prose(8, 35), prose(8, 35), prose(9, 36), "y " + prose(9, 36)])


def test_white_space_and_odd_texts(spark, odd):
    texts = [r.text for r in odd.collect()] + ["a\x0bb\x0cc\rd", "a b c", "\x1fa\x00b"]
    check(spark, texts)
    out = substring.repeated_windows_removed(odd)
    assert out.columns == [*odd.columns, "n_words", "n_removed", "kept_text"]
    assert out.count() == odd.count()
    assert substring.repeated_windows_removed(odd.limit(0)).count() == 0


def test_other_width(spark):
    check(spark, [prose(1, 50), prose(2, 9) + " " + prose(1, 50), prose(3, 80)], width=26)


def test_query_digest(spark, folder, documents):
    from tarmac.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op6_substring_dedup"](spark, folder).collect()}
    for (doc_id, _), (n, removed, kept) in zip(documents, brute([t for _, t in documents])):
        r = rows[doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_clashing_names(spark):
    from pyspark.sql import functions as F

    shared = prose(77, 40)
    df = spark.createDataFrame([(1, f"a {shared}"), (2, f"{shared} b")], "doc_id long, text string")
    for name in ("_k1", "_k2", "_removed", "_kept", "_at", "row", "n_removed"):
        df = df.withColumn(name, F.lit(9))
    out = substring.repeated_windows_removed(df)
    assert [c for c in df.columns if c != "n_removed"] + ["n_words", "n_removed", "kept_text"] == out.columns
    assert {(r.doc_id, r.n_removed, r.kept_text, r._k1) for r in out.collect()} == {(1, 40, "a", 9), (2, 40, "b", 9)}


def test_settled_places_travel_as_runs():
    keys = pa.record_batch({"_k1": pa.array([5, 6, 7], pa.int64()), "_k2": pa.array([1, 2, 3], pa.int64())})
    hashes = np.array([*range(100, 140), *range(100, 140), 7, 8, 100, 9], np.uint64)
    rows, at = np.repeat([0, 1, 2], [40, 42, 2]), np.array([*range(40), *range(10, 52), 3, 4])
    out = substring._occurrences(hashes, rows, at, keys).to_pylist()
    placed = sorted((r["_k1"], r["at"], r["length"], r["n"]) for r in out if r["at"] is not None)
    assert placed == [(5, 0, 40, 2), (6, 10, 40, 2), (6, 50, 1, 1), (6, 51, 1, 1), (7, 3, 1, 2), (7, 4, 1, 1)]
    assert sorted(r["hash"] for r in out if r["at"] is None) == list(range(100, 140))


def test_shuffle_files_of_written_steps_go(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        names = (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
        return {name for name in names if name.startswith("shuffle_")}

    part, before = prose(7, 60), files()
    texts = [f"{part} {prose(i, 9)}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = substring.repeated_windows_removed(df)
    for _ in range(40):
        if not files() - before:
            break
        time.sleep(0.25)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect())
    assert got == [(i, *want) for i, want in enumerate(brute(texts))]
