import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tarmac.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append((i is None, i or 0, n))
    out = []
    for text, members in groups.items():
        first = min(members)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for none, i, n in members:
            out.append((None if none else i, None if first[0] else first[1], len(members), n == first[2], digest))
    return sorted(map(repr, out))


def test_odd_rows(spark, odd):
    given = [(r.doc_id, r.text) for r in odd.collect()]
    got = exact_dedup.exact_copies(odd, digest_all=True)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(given)


def test_white_space_same_prefix_and_length(spark):
    start = "x" * 80
    rows = [(9, "a \n b"), (4, "a\tb"), (5, " a b"), (7, start + "1"), (8, start + "2"), (6, start + "1"), (3, "a b"), (2, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_copies(df, digest_all=True, prefix_chars=4)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_settled_texts_are_not_hashed(spark):
    df = spark.createDataFrame([(1, "one"), (2, "three"), (3, "other"), (4, "other")], "doc_id long, text string")
    digests = {r.doc_id: r.text_sha256 for r in exact_dedup.exact_copies(df).collect()}
    assert digests[1] is None and digests[2] is None and digests[3] == digests[4] is not None


def test_drop_keeps_columns_and_one_of_equal_rows(spark, odd):
    named = odd.withColumn("keep_id", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("digest", F.lit(2)).withColumn("cell", F.lit(3))
    out = exact_dedup.drop_exact_copies(named)
    assert out.columns == named.columns
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.text) for r in out.select("doc_id", "text").collect() if r.text)
    assert [i for i, _ in got] == [1, 2, 5, 6, 7, 9, 99]
    # null, null and empty are one text: the smallest id stays
    assert [r.doc_id for r in out.where("text IS NULL OR text = ''").collect()] == [3]
    assert exact_dedup.drop_exact_copies(named.limit(0)).count() == 0


def test_text_ids_and_large_group(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
    )
    out = exact_dedup.exact_copies(df).where("group_size > 1").collect()
    assert len(out) == 1000 and {r.keep_id for r in out} == {"k00000"} and sum(r.kept for r in out) == 1
