"""Correlation and components of wide tables: column blocks and products with a table of cells."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tarmac.operators import profile, reduce


def wide(spark, rows, columns, seed=3, rank=None):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(rows, columns))
    if rank:
        x = draw.normal(size=(rows, rank)) * np.geomspace(9, 1, rank) @ draw.normal(size=(rank, columns)) + 0.1 * x
    names = [f"c{i}" for i in range(columns)]
    return x, names, pd.DataFrame(x, columns=names)


@pytest.mark.parametrize("block, held", [(7, 6 * 8 * 49 * 2), (40, 1), (43, 64 << 20)])
def test_blocks_give_the_same_cells(spark, monkeypatch, block, held):
    monkeypatch.setattr(profile, "BLOCK_COLUMNS", block)
    monkeypatch.setattr(profile, "HELD_BYTES", held)
    x, names, frame = wide(spark, 300, 43)
    x[np.random.default_rng(1).random(x.shape) < 0.1] = np.nan
    x[:, 42] = 7.25
    frame = pd.DataFrame(x, columns=names)
    frame["g"] = [str(i % 3) for i in range(300)]
    df = spark.createDataFrame(frame.astype(object).where(lambda f: f.notna(), None), ", ".join([f"{c} double" for c in names] + ["g string"])).repartition(3)
    for by, part in [(None, frame), ("g", frame[frame.g == "1"])]:
        got = profile.corr_pairs(df, names, by).toPandas()
        got = got[got.g == "1"] if by else got
        assert len(got) == 43 * 44 // 2 and not got.duplicated(["x", "y"]).any()
        want, known = part[names].corr(), part[names].notna().astype(int)
        both = known.T @ known
        assert all(r.n == both.loc[r.x, r.y] for r in got.itertuples())
        assert all(abs(r.r - want.loc[r.x, r.y]) < 1e-9 for r in got.itertuples() if "c42" not in (r.x, r.y))


def test_passes_cover_all_pairs_within_memory():
    for columns in (1, 384, 385, 5000):
        passes = profile.column_tiles(columns)
        pairs = sum(len(a) * (len(a) + 1) // 2 if a == b else len(a) * len(b) for tiles in passes for a, b in tiles)
        assert pairs == columns * (columns + 1) // 2
        for tiles in passes:
            assert sum(6 * 8 * len(a) * len(b) for a, b in tiles) <= profile.HELD_BYTES
    assert len(profile.column_tiles(384)) == 1


def test_a_task_of_five_thousand_columns_stays_within_its_bound():
    draw = np.random.default_rng(2)
    tiles = profile.column_tiles(5000)[3]
    used = sorted({i for tile in tiles for block in tile for i in block})
    names = [f"c{i}" for i in range(5000)]
    batches = [pa.record_batch([pa.array(draw.normal(size=200)) for _ in used], names=[names[i] for i in used]) for _ in range(4)]
    sums = profile._PairSums(names, np.zeros(5000), [], tiles)
    tracemalloc.start()
    cells = sum(out.num_rows for out in sums(iter(batches)))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert cells == sum(len(a) * (len(a) + 1) // 2 if a == b else len(a) * len(b) for a, b in tiles)
    # sums, those of one batch's tile, and a batch's blocks as matrices: a full matrix of four kinds would be 800 MB
    assert peak < profile.HELD_BYTES * 2.5


@pytest.mark.parametrize("rank", [6, None])
def test_components_of_a_wide_table(spark, monkeypatch, rank):
    monkeypatch.setattr(reduce, "DENSE_COLUMNS", 10)
    monkeypatch.setattr(profile, "BLOCK_COLUMNS", 25)
    x, names, frame = wide(spark, 400, 60, rank=rank)
    x[:, 59] = 4.5
    frame = pd.DataFrame(x, columns=names)
    frame["id"] = range(400)
    df = spark.createDataFrame(frame).repartition(3)
    z = (x[:, :59] - x[:, :59].mean(0)) / x[:, :59].std(0)
    values, axes = np.linalg.eigh(np.cov(z.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    got = reduce.pca(df, names, ["id"], k=3).orderBy("id").toPandas()
    for j in range(3):
        want = z @ axes[:, j]
        sign = np.sign(want @ got[f"pc{j + 1}"].to_numpy())
        assert np.allclose(sign * got[f"pc{j + 1}"], want, atol=1e-5 * np.abs(want).max())
        assert axes[np.abs(axes[:, j]).argmax(), j] * sign > 0
    shares = reduce.pca_variance(df, names, 0.6).orderBy("component").toPandas()
    assert np.allclose(shares["ratio"], (values / 59)[: len(shares)], atol=1e-7)
    assert shares["selected"].sum() == int((np.cumsum(values / 59) < 0.6).sum()) + 1


def test_too_many_components(spark, monkeypatch):
    for name, value in (("DENSE_COLUMNS", 10), ("MOST_COMPONENTS", 8)):
        monkeypatch.setattr(reduce, name, value)
    _, names, frame = wide(spark, 300, 40)
    with pytest.raises(ValueError):
        reduce.pca_variance(spark.createDataFrame(frame), names, 0.9)


def test_several_passes_over_many_columns(spark, monkeypatch):
    monkeypatch.setattr(reduce, "DENSE_COLUMNS", 100)
    monkeypatch.setattr(profile, "BLOCK_COLUMNS", 100)
    monkeypatch.setattr(profile, "HELD_BYTES", 1 << 20)
    x, names, frame = wide(spark, 40, 300, rank=3)
    assert len(profile.column_tiles(300)) > 1
    z = (x - x.mean(0)) / x.std(0)
    values = np.linalg.svd(z, compute_uv=False) ** 2 / 40
    got = reduce.pca_variance(spark.createDataFrame(frame), names, 0.5).orderBy("component").toPandas()
    assert np.allclose(got["ratio"], values[: len(got)] / 300, atol=1e-8)
