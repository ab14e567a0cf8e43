"""The whole pipeline on documents with planted cases, and each stage on odd rows."""

import duckdb
import pytest
from conftest import prose
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm.queries import PIECES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory, folder):
    """The given documents with a copy, a near copy, an item, a toxic text and a repeated line added."""
    path = tmp_path_factory.mktemp("corpus")
    folder = folder.replace("sf0.001", "sf0.01")
    items = spark.createDataFrame([(1, prose(900, 40)), (2, prose(901, 25))], "item_id long, text string")
    items.write.parquet(f"{path}/benchmark.parquet")
    clean = [(100_000 + i, "\n".join(prose(7000 + 10 * i + k, 60) for k in range(4))) for i in range(20)]
    near = clean[0][1].split("\n")
    near = "\n".join(" ".join("replacement" if i == 3 else w for i, w in enumerate(x.split())) for x in near)
    bad = "idiot moron scum worthless stupid loser"
    rows = clean + [
        (100_100, clean[0][1]),
        (100_101, near),
        (100_102, f"{prose(800, 50)}\n{prose(801, 9)} {prose(900, 40).title()}, {prose(802, 30)}"),
        (100_103, f"{prose(803, 30)} {bad} {prose(804, 30)} {bad}"),
        (100_104, f"{clean[1][1].splitlines()[0]}\n{prose(805, 60)}"),
        (100_105, None),
        (100_106, ""),
    ]
    extra = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.read.parquet(f"{folder}/documents.parquet").unionByName(extra).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return str(path), dict(rows), [i for i, _ in clean]


def test_run(spark, planted):
    path, texts, clean = planted
    out = corpus_pipeline.run(spark, path)
    assert out.columns == [*COLUMNS, "token_ids", "round_trip"]
    got = {r.doc_id: r for r in out.where("doc_id >= 100000").collect()}
    assert set(clean) | {100_104, 100_105, 100_106} <= set(got)
    assert not {100_100, 100_102} & set(got)
    assert all(got[i].text == texts[i] and got[i].n_chars == len(texts[i]) for i in clean)
    assert got[100_104].text == prose(805, 60) and got[100_104].n_chars == len(prose(805, 60))
    assert 100_101 not in got
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in got.values():
        assert r.token_ids == (None if r.text is None else theirs.encode(r.text))


def test_toxic_stage_keeps_clean_documents(spark, folder):
    folder = folder.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    labels = duckdb.execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    clean, toxic = [i for i, y in labels if y == 0], [i for i, y in labels if y == 1]
    assert len(kept & set(clean)) >= 0.995 * len(clean)
    assert len(kept & set(toxic)) <= 0.12 * len(toxic)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, odd, folder, name):
    folder = folder.replace("sf0.001", "sf0.01")
    given = spark.read.parquet(f"{folder}/documents.parquet").unionByName(odd, allowMissingColumns=True)
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = given if name == "toxicity" else odd
    # columns with the names that operators give their own
    for clash in ("row", "id", "text_hash", "_row", "_id", "_hash", "_lost", "_some", "_k1", "_k2", "_removed", "_kept", "own", "key", "met", "hash", "n", "label", "evidence"):
        docs = docs.withColumn(clash, F.lit(5))
    out = stage(spark, docs, folder)
    assert out.columns[: len(docs.columns)] == docs.columns
    ids = [r.doc_id for r in out.where("doc_id IS NULL OR doc_id < 10").select("doc_id").collect()]
    assert {3, 4, 5, 6, 9} <= set(ids) and None in ids
    assert stage(spark, docs.limit(0), folder).count() == 0


def test_stages_and_registration():
    import __spark_entry__

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece",
    ]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
