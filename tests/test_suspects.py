"""Row fingerprints, frequent-value summaries and versioned checkpoints."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.operators import clean, profile
from tarmac.sources import tables as io

SCHEMA = "a long, b string, c double, d boolean, e date, f array<int>"


def rows(seed, n):
    draw = random.Random(seed)
    pick = [None, 1, 2], [None, "", "x"], [None, 0.0, -0.0, float("nan"), 2.5], [None, True], [None], [None, [1], [2]]
    return [tuple(draw.choice(p) for p in pick) for _ in range(n)] + [(i, "only", 1.0, True, None, [i]) for i in range(50)]


def whole(df):
    return Counter(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


@pytest.mark.parametrize("mark", ["own", "colliding", "one"])
def test_duplicates_with_any_fingerprint(spark, monkeypatch, mark):
    marks = {"own": clean.fingerprint, "colliding": lambda df: F.struct((F.xxhash64("a") % 7).alias("m")), "one": lambda df: F.struct(F.lit(1).alias("m"))}
    given = clean.suspected_copies
    monkeypatch.setattr(clean, "suspected_copies", lambda df: given(df, marks[mark]))
    df = spark.createDataFrame(rows(1, 400), SCHEMA).repartition(5)
    df = df.union(df.limit(0))
    got, want = clean.remove_duplicates(df), df.distinct()
    assert got.columns == df.columns and whole(got) == whole(want)
    assert profile.duplicate_count(df).first()[0] == 450 - want.count()
    assert profile.duplicate_count(df.limit(0)).first()[0] == 0


def test_rows_without_a_copy_are_not_compared(spark):
    df = spark.createDataFrame([(i, "x", 1.0, True, None, [1]) for i in [*range(300), 7, 7]], SCHEMA)
    alone, suspects = clean.suspected_copies(df)
    assert alone.count() >= 295 and {7} <= {r.a for r in suspects.collect()} and suspects.count() + alone.count() == 302


def test_nulls_do_not_slip_into_each_other(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None)], "a long, b long")
    assert df.select(clean.fingerprint(df)).distinct().count() == 3


@pytest.mark.parametrize("most", [1024, 3, 1])
def test_modes_with_any_number_of_counters(spark, monkeypatch, most):
    monkeypatch.setattr(clean, "FREQUENT_VALUES", most)
    draw = random.Random(4)
    given = [
        (
            draw.choice([7, 7, 7, 7, draw.randrange(500)]),  # stands out
            draw.randrange(400),  # does not
            draw.choice(["b", "a"]),
            draw.choice([True, False, True]),
            draw.choice([-1.5, 2.5, 2.5]),
            None,
        )
        for _ in range(900)
    ] + [(None,) * 6] * 3
    df = spark.createDataFrame(given, "p long, q long, s string, t boolean, d double, n string").repartition(6)
    got = clean.column_modes(df, df.columns)
    for i, name in enumerate(df.columns):
        counts = Counter(r[i] for r in given if r[i] is not None)
        want = min(counts, key=lambda v: (-counts[v], v)) if counts else None
        assert got[name] == want, name


def test_a_column_without_a_clear_mode_falls_back(spark, monkeypatch):
    monkeypatch.setattr(clean, "FREQUENT_VALUES", 2)
    df = spark.createDataFrame([(i % 50, 1 if i % 4 else 2) for i in range(500)] + [(None, None)], "q long, p long")
    types = {f.name: f.dataType for f in df.schema.fields}
    found, rest = clean._frequent_modes(df, ["q", "p"], types)
    assert found == {"p": "1"} and rest == ["q"]


def test_summary_keeps_its_bound():
    draw = random.Random(2)
    values = [str(int(draw.paretovariate(0.8))) for _ in range(5000)]
    batches = [pa.record_batch([pa.array(values[i : i + 250])], names=["c0"]) for i in range(0, 5000, 250)]
    (out,) = clean._Summaries(["c0"], 40)(iter(batches))
    found = dict(zip(out.column("text").to_pylist(), out.column("n").to_pylist()))
    lost, counts = found.pop(None), Counter(values)
    assert len(found) <= 40 and lost <= 5000 / 40
    assert all(found.get(v, 0) <= n <= found.get(v, 0) + lost for v, n in counts.items())


def test_checkpoint_survives_a_run_that_stops_between_the_writes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    with pytest.raises(ValueError):
        io.load_checkpoint(spark, path)
    first = io.save_checkpoint(spark.range(3), path, {"step": 1})

    def stop(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(io.json, "dumps", stop)
        with pytest.raises(RuntimeError):
            io.save_checkpoint(spark.range(9), path, {"step": 2})
    table, fitted = io.load_checkpoint(spark, path)
    assert table.count() == 3 and fitted == {"step": 1}
    second = io.save_checkpoint(table.withColumn("x", F.lit("y")), path, {"step": 3})
    table, fitted = io.load_checkpoint(spark, path)
    assert table.columns == ["id", "x"] and fitted == {"step": 3}
    assert io.load_checkpoint(spark, path, first)[1] == {"step": 1}
    third = io.save_checkpoint(spark.range(1), path)
    assert [v["version"] for v in io._versions(spark, path)] == [third, second]
    with pytest.raises(ValueError):
        io.load_checkpoint(spark, path, first)


def test_checkpoint_with_lost_rows_is_an_error(spark, tmp_path):
    path = str(tmp_path / "c")
    version = io.save_checkpoint(spark.range(100).repartition(4), path)
    folder = tmp_path / "c" / f"version={version}" / "table"
    next(folder.glob("*.parquet")).unlink()
    with pytest.raises(ValueError):
        io.load_checkpoint(spark, path)
