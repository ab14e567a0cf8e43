import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.operators import knn


def brute(points, keys, queries, qkeys, k, exclude_self):
    out = set()
    for q, qk in zip(queries, qkeys):
        d = np.sqrt(((points - q) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((keys, d)) if not (exclude_self and keys[i] == qk)][:k]
        out |= {(qk, keys[i], rank + 1, round(float(d[i]), 9)) for rank, i in enumerate(order)}
    return out


def frame(spark, points):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, features array<double>").repartition(6)


def result(df):
    return {(r[0], r.neighbor, r["rank"], round(r.dist, 9)) for r in df.collect()}


def make(kind):
    rng = np.random.default_rng(3)
    if kind == "uniform":
        return rng.normal(size=(700, 3))
    if kind == "lattice":  # many equal distances
        return rng.integers(0, 5, size=(500, 2)).astype(float)
    # a third of the points are one copy, another third sits in one dense spot
    return np.vstack([np.zeros((250, 2)), rng.normal(scale=1e-3, size=(250, 2)), rng.normal(size=(250, 2)) * 50])


@pytest.mark.parametrize("kind", ["uniform", "lattice", "hot"])
@pytest.mark.parametrize("tiled", [False, True])
def test_equals_brute_force(spark, kind, tiled):
    points = make(kind)
    df = frame(spark, points)
    keys = np.arange(len(points))
    options = {"broadcast_cells": 0, "tile_rows": 64} if tiled else {}
    got = result(knn.knn_join(df, df, 4, "id", "id", exclude_self=True, **options))
    assert got == brute(points, keys, points, keys, 4, True)


def test_two_tables_and_large_k(spark):
    base, asked = make("uniform")[:90], make("uniform")[600:640]
    b, q = frame(spark, base), frame(spark, asked)
    for options in ({}, {"broadcast_cells": 0, "tile_rows": 16}):
        got = result(knn.knn_join(q, b, 100, "id", "id", **options))
        assert got == brute(base, np.arange(90), asked, np.arange(40), 100, False)


def test_empty_base_and_bad_k(spark):
    df = frame(spark, np.zeros((2, 2)))
    assert knn.knn_join(df, df.where("id < 0"), 3, "id", "id").count() == 0
    with pytest.raises(ValueError):
        knn.knn_join(df, df, 0, "id", "id")


def test_text_keys(spark):
    df = frame(spark, make("lattice")[:40]).withColumn("id", F.concat(F.lit("k"), F.col("id").cast("string")))
    edges = knn.knn_join(df, df, 2, "id", "id", exclude_self=True)
    assert edges.count() == 80 and edges.where("id = neighbor").count() == 0


def test_vote_tie_goes_to_smaller_label(spark):
    train = spark.createDataFrame(
        [(1, [0.0], 7), (2, [1.0], 3)], "id long, features array<double>, label int"
    )
    test = spark.createDataFrame([(9, [0.1])], "id long, features array<double>")
    assert knn.knn_classify(train, test, "id", "label", 2).first().prediction == 3


def test_tree_visits_few_pairs(spark):
    """In three dimensions a query visits some leaves of its surroundings, whatever the number of rows."""
    pairs = {}
    for n in (1000, 8000):
        points = np.random.default_rng(5).normal(size=(n, 3))
        df = frame(spark, points)
        q, b = df.select(F.col("id").alias("qk"), F.col("features").alias("qv")), df.select(F.col("id").alias("bk"), F.col("features").alias("bv"))
        tree = knn.PivotTree.build(b, 3, 64, 100_000)
        leaves = {r.leaf: r.n for r in tree.points.groupBy("leaf").agg(F.sum(F.size("bks")).alias("n")).collect()}
        assert max(leaves.values()) <= 64 and sum(leaves.values()) == n
        _, visits = tree.search(q, 4, "qk long, bk long, dist double")
        seen = [(r.qk, r.leaf) for v in visits for r in v.collect()]
        assert len(seen) == len(set(seen))
        pairs[n] = sum(leaves[leaf] for _, leaf in seen)
        assert pairs[n] < 40 * n * np.log2(n)
    assert pairs[8000] < 8 * pairs[1000] * np.log2(8000) / np.log2(1000)


@pytest.mark.parametrize("cells", [0, 60, 600])
def test_tree_too_large_to_broadcast(spark, cells):
    points = make("uniform")
    df = frame(spark, points)
    got = result(knn.knn_join(df, df, 4, "id", "id", exclude_self=True, broadcast_cells=cells, tile_rows=16))
    assert got == brute(points, np.arange(len(points)), points, np.arange(len(points)), 4, True)


def test_copies_fewer_points_than_neighbors_and_outliers(spark):
    base = np.vstack([np.zeros((300, 2)), np.ones((300, 2)), [[1e9, -1e9]], np.geomspace(1e-6, 1e6, 90)[:, None] * [1, -1]])
    b, q = frame(spark, base), frame(spark, base[::50])
    options = {"broadcast_cells": 0, "tile_rows": 8}
    got = result(knn.knn_join(q, b, 7, "id", "id", **options))
    assert got == brute(base, np.arange(len(base)), base[::50], np.arange(len(base[::50])), 7, False)
    assert knn.knn_join(q.where("id < 0"), b, 7, "id", "id", **options).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "lattice", "hot"])
def test_many_parts(spark, kind, monkeypatch):
    """Queries meet whole parts of a bounded size, the first and those within the bound found there, not single leaves."""
    monkeypatch.setattr(knn, "PART_KEYS", 60)
    points = make(kind)
    df, keys = frame(spark, points), np.arange(len(points))
    cells = points.size - 1
    q, b = df.select(F.col("id").alias("qk"), F.col("features").alias("qv")), df.select(F.col("id").alias("bk"), F.col("features").alias("bv"))
    got = result(knn.knn_join(df, df, 4, "id", "id", exclude_self=True, broadcast_cells=cells, tile_rows=8))
    assert got == brute(points, keys, points, keys, 4, True)
    if kind == "uniform":
        tree = knn.PivotTree.build(b, 3, 8, cells)
        parts = [r.n for r in tree.points.groupBy("door").agg(F.sum(F.size("bks")).alias("n")).collect()]
        assert len(parts) > 8 and max(parts) <= 60
        _, (first, more) = tree.search(q, 4, "qk long, bk long, dist double")
        assert first.select("qk").distinct().count() == len(points)
        met = more.select("qk", F.substring_index("leaf", ".", 1).alias("door")).distinct().count()
        assert met < len(points) * len(parts) / 2


def test_broadcast_base_is_not_compared_whole():
    """The work for a query in a broadcast base grows with the logarithm of its rows, not with the rows."""
    pairs = {}
    for n in (4000, 64000):
        points = np.random.default_rng(5).normal(size=(n, 2))
        leaf = knn.kd_leaves(points, np.ones(n), 64)
        size = np.bincount(leaf)
        assert size.max() <= 64
        base = knn.Leaves(points, np.arange(n), leaf)
        asked = points[:500]
        pairs[n] = 0
        for q, key, dist, _, visited in base.search(asked, 5):
            pairs[n] += size[visited].sum()
            for i in np.unique(q):
                want = np.sqrt(((points - asked[i]) ** 2).sum(axis=1))
                assert key[q == i].tolist() == np.lexsort((np.arange(n), want))[:5].tolist()
                assert np.allclose(dist[q == i], np.sort(want)[:5])
        assert pairs[n] < 500 * 64 * 12
    assert pairs[64000] < 2 * pairs[4000]


@pytest.mark.parametrize("cells", [None, 100])
def test_missing_numbers(spark, cells):
    points = make("uniform")[:60]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [(90, [None, 1.0, 2.0]), (91, [0.0, float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    options = {"broadcast_cells": cells, "tile_rows": 16} if cells else {}
    got = result(knn.knn_join(df, df, 3, "id", "id", exclude_self=True, **options))
    assert got == brute(points, np.arange(60), points, np.arange(60), 3, True)
    with pytest.raises(ValueError):
        knn.knn_join(df, df.unionByName(spark.createDataFrame([(92, None)], df.schema)), 3, "id", "id", **options)
