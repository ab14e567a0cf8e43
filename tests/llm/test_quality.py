import numpy as np
import pyarrow as pa
import pytest
from conftest import prose
from pyspark.sql import functions as F

from tarmac.llm import quality
from tarmac.llm.words import Hasher


def test_statistics_of_known_texts():
    texts = pa.array(["Ab ab. Ab ab.\nx1 | y#\nx1 | y#", "", None, " \n "])
    got = quality.statistics(texts, Hasher(), Hasher(b"\n"))
    row = dict(zip(quality.STATISTICS, got[0]))
    near = lambda part, whole: np.log(part / whole + 0.01)
    assert row["words"] == pytest.approx(np.log1p(10)) and row["line_words"] == pytest.approx(np.log1p(10 / 3))
    assert row["distinct_words"] == pytest.approx(near(5, 10)) and row["top_word"] == pytest.approx(near(2, 10))
    assert row["repeated_lines"] == pytest.approx(near(1, 3)) and row["bars"] == pytest.approx(near(2, 10))
    assert row["sentence_ends"] == pytest.approx(near(2, 10)) and row["capitals"] == pytest.approx(near(2, 12))
    assert np.isfinite(got).all() and (got[1] == got[2]).all()


def test_density_is_the_normal_one():
    draw = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    covariance = np.eye(d) + 0.3
    model = quality.QuadraticModel(
        np.log([0.3, 0.7]), draw.normal(size=(2, d)), np.stack([np.linalg.cholesky(covariance), np.eye(d)])
    )
    x = draw.normal(size=(5, d))
    for c, cov in ((0, covariance), (1, np.eye(d))):
        gap = x - model.means[c]
        want = -0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1]
        assert np.allclose(model.log_densities(x)[:, c], want + model.priors[c])
    assert ((model.scores(x) >= 0) & (model.scores(x) <= 1)).all()


def test_fit_shrinks_and_scores(spark):
    rows = [(i, prose(i, 60 + i % 90), 1) for i in range(120)]
    rows += [(1000 + i, " | ".join(prose(i, 30).upper().split()) + " ###" * 20, 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    x = quality.with_statistics(df).cache()
    model = quality.fit(x.where("doc_id % 3 != 0"))
    values = np.array([r.x for r in x.where("doc_id % 3 != 0 AND label = 1").collect()])
    assert np.allclose(model.means[1], values.mean(axis=0))
    for r in quality.score(x, model).collect():
        assert (r.score > 0.5) == (r.label == 1)
    single = quality.fit(x.where("label = 1 OR doc_id = 1000"))
    assert np.isfinite(single.factors).all()
    with pytest.raises(ValueError):
        quality.fit(x.where("label = 1"))


def test_odd_rows(odd):
    x = quality.with_statistics(odd)
    assert x.columns == [c for c in odd.columns if c != "text"] + ["x"]
    model = quality.QuadraticModel(np.zeros(2), np.zeros((2, 12)), np.stack([np.eye(12), 2 * np.eye(12)]))
    rows = quality.score(x, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(quality.with_statistics(odd.limit(0)), model).count() == 0


def test_fold_is_the_crc(spark):
    import zlib

    got = spark.range(100).select("id", quality.fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_held_out_accuracy(spark, folder):
    from tarmac.llm.queries import QUERIES

    folder = folder.replace("sf0.001", "sf0.01")
    rows = QUERIES["op5_quality_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id")
    assert rows.count() == 1000
    assert held.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] >= 0.97


def test_score_of_the_query_recomputed(spark, folder):
    """Fit and scores of the query from the statistics of its rows, by general inverses."""
    import duckdb
    import zlib

    import numpy as np

    from tarmac.llm.queries import QUERIES

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    x = {r.doc_id: np.array(r.x) for r in quality.with_statistics(docs).collect()}
    labels = dict(duckdb.execute(f"SELECT doc_id, quality FROM '{folder}/labels.parquet' WHERE quality IN (0, 1)").fetchall())
    learned = {i: y for i, y in labels.items() if i in x and zlib.crc32(str(i).encode()) % 5}
    d, parts = len(next(iter(x.values()))), []
    for c in (0, 1):
        rows = np.array([x[i] for i, y in learned.items() if y == c])
        parts.append((len(rows), rows.mean(axis=0), (rows - rows.mean(axis=0)).T @ (rows - rows.mean(axis=0))))
    n = sum(p[0] for p in parts)
    pooled = sum(p[2] for p in parts) / n
    densities = []
    for count, mean, scatter in parts:
        own = 0.9 * scatter / count + 0.1 * pooled
        own = 0.95 * own + 0.05 * max(np.trace(own) / d, 1e-6) * np.eye(d)
        inverse, size = np.linalg.inv(own), np.linalg.slogdet(own)[1]
        densities.append({i: -0.5 * (v - mean) @ inverse @ (v - mean) - 0.5 * size + np.log(count / n) for i, v in x.items()})
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, folder).collect()}
    assert set(got) == set(x)
    for i, r in got.items():
        want = 1 / (1 + np.exp(np.clip(densities[0][i] - densities[1][i], -700, 700)))
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
