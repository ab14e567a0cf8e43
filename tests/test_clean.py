import math

import pytest
from pyspark.sql import functions as F

from tarmac.operators import clean
from tarmac.operators.quantiles import column_quantiles, exact_quantiles
from tarmac.sources import tables as io
from tarmac.sources.flights import flight_schema


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_missing_flag_drops_row(spark):
    df = frame(spark, [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, None, 0.0), (4, 0.0, None)], "id int, a double, b double")
    assert [r.id for r in clean.drop_flagged(df, ["a", "b"]).collect()] == [1]


def test_delay_classes_at_their_edges(spark):
    df = frame(spark, [(v,) for v in (-5.0, 14.9, 15.0, 30.0, 30.1, None)], "d double")
    got = {r.d: r.c for r in clean.classify_delay(df, "d", "c").collect()}
    assert got == {
        -5.0: "On-time", 14.9: "On-time", 15.0: "Short delay", 30.0: "Short delay",
        30.1: "Long delay", None: "Unknown",
    }


def test_clip_keeps_null(spark):
    df = frame(spark, [(-3.0,), (2.0,), (None,)], "d double")
    assert sorted(clean.clip_delay(df, "d").toPandas()["d"].fillna(99)) == [0.0, 2.0, 99.0]
    assert clean.clipped_count(df, "d").first()[0] == 1


def test_fill_strategies(spark):
    df = frame(spark, [(1.0, "b"), (2.0, "a"), (2.0, None), (1.0, "a"), (None, "b")], "x double, s string")
    assert clean.fill_missing(df, "mode").where("x is null or s is null").count() == 0
    filled = clean.fill_missing(df, "mode").groupBy("x", "s").count().collect()
    # ties go to the smaller value
    assert {(r.x, r.s): r["count"] for r in filled} == {(1.0, "b"): 2, (2.0, "a"): 2, (1.0, "a"): 1}
    assert clean.fill_missing(df, "median").agg(F.max("x")).first()[0] == 2.0
    assert clean.fill_missing(df, "mean").where("x = 1.5").count() == 1
    assert clean.fill_missing(df, "constant", 7).where("x = 7").count() == 1
    assert clean.fill_missing(df, "constant", "z").where("s = 'z'").count() == 1


def test_whole_numbers_stay_whole_without_gaps(spark):
    df = frame(spark, [(1, 2), (3, None)], "a int, b int")
    assert clean.fill_missing(df, "mean").dtypes == [("a", "int"), ("b", "double")]


@pytest.mark.parametrize("strategy,value", [("best", None), ("constant", None)])
def test_bad_fill(spark, strategy, value):
    with pytest.raises(ValueError):
        clean.fill_missing(frame(spark, [(1,)], "a int"), strategy, value)


def test_bad_missing_method(spark):
    df = frame(spark, [(1,)], "a int")
    for method, value in (("keep", None), ("fill", None)):
        with pytest.raises(ValueError):
            clean.handle_missing(df, method, value)


def test_required_columns(spark):
    df = frame(spark, [(1,)], "a int")
    for call in (
        lambda: clean.drop_flagged(df, ["z"]),
        lambda: clean.clip_delay(df, "z"),
        lambda: clean.feature_matrix(df, "z"),
        lambda: clean.drop_columns(df, ["z"], ignore_missing=False),
        lambda: clean.feature_matrix(frame(spark, [("t", "s")], "t string, s string"), "t"),
    ):
        with pytest.raises(ValueError):
            call()


def test_outlier_and_gap_become_mean_of_the_rest(spark):
    df = frame(spark, [(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "x double")
    got = sorted(r.x for r in clean.replace_outliers_iqr(df, ["x"]).collect())
    assert got == [1.0, 2.0, 2.5, 2.5, 3.0, 4.0]
    assert sorted(r.x for r in clean.treat_outliers_and_missing(df, ["x"]).collect()) == got


def test_quantiles_interpolate(spark):
    df = frame(spark, [(float(v),) for v in (1, 2, 4, 9)], "x double")
    assert column_quantiles(df, ["x"], [0.25]).first()["quantiles"][0] == 1.75


def test_narrowed_quantiles_equal_plain_ones(spark):
    # one value holds a third of the rows, one group is small, one is large
    rows = [("a", float((i * 7919) % 1009)) for i in range(3000)] + [("a", 5.0)] * 1500
    rows += [("b", float(i)) for i in range(10)] + [("c", None)]
    df = frame(spark, rows, "g string, value double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    plain = {r.g: list(r.quantiles) for r in exact_quantiles(df, ["g"], "value", probs).collect()}
    tight = {
        r.g: list(r.quantiles) for r in exact_quantiles(df, ["g"], "value", probs, direct_rows=0, sort_rows=40).collect()
    }
    sorted_only = exact_quantiles(df, ["g"], "value", probs, direct_rows=0).collect()
    assert {r.g: list(r.quantiles) for r in sorted_only}["a"] == pytest.approx(plain["a"])
    assert set(plain) == set(tight) == {"a", "b"}
    for g in plain:
        assert tight[g] == pytest.approx(plain[g], abs=1e-9)
    wide = column_quantiles(df, ["value"], probs, ["g"], direct_rows=0, sort_rows=40)
    assert {r.g: list(r.quantiles) for r in wide.collect()}["a"] == pytest.approx(plain["a"])


def test_nan_is_missing_and_csv_keeps_types(spark, tmp_path):
    df = frame(spark, [(1, 2.5, "x"), (2, math.nan, None)], "a int, b double, c string")
    clean_df = io.normalise_missing(df)
    assert clean_df.where("b is null").count() == 1
    io.write_csv(clean_df, str(tmp_path / "out"))
    back = io.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert back.dtypes == df.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, clean_df.collect()))
    assert io.read_csv(spark, str(tmp_path / "out"), nrows=1).count() == 1


def test_csv_schema_by_name(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("ARR_DELAY,EXTRA,FL_DATE\n5.0,q,2020-01-02\n,r,2020-01-03\n")
    df = io.read_csv(spark, str(path), flight_schema())
    assert df.dtypes == [("ARR_DELAY", "double"), ("EXTRA", "string"), ("FL_DATE", "date")]
    assert df.where("ARR_DELAY is null").count() == 1


def test_checkpoint_keeps_fitted_values(spark, tmp_path):
    df = spark.range(5)
    io.save_checkpoint(df, str(tmp_path / "c"), {"mean": 2.0})
    table, fitted = io.load_checkpoint(spark, str(tmp_path / "c"))
    assert table.count() == 5 and fitted == {"mean": 2.0}


def test_duplicates_treat_null_as_equal(spark):
    from tarmac.operators.profile import duplicate_count

    df = frame(spark, [(1, None), (1, None), (2, "a")], "a int, b string")
    assert duplicate_count(df).first()[0] == 1
    assert clean.remove_duplicates(df).count() == 2


def test_modes_in_one_job(spark):
    rows = [(1, "b", 2.5, True, None), (1, "a", 2.5, None, None), (10, "a", None, True, None), (10, "b", -1.0, False, None), (None, None, -1.0, False, None)]
    df = spark.createDataFrame(rows, "i long, s string, d double, b boolean, n int")
    assert clean.column_modes(df, ["i", "s", "d", "b", "n"]) == {"i": 1, "s": "a", "d": -1.0, "b": False, "n": None}
    assert clean.column_modes(df.na.drop(), ["i"]) == {}


def test_malformed_cells(spark, tmp_path):
    from pyspark.sql import types as T

    from tarmac.sources import tables

    path = str(tmp_path / "x.csv")
    with open(path, "w") as out:
        out.write("i,t\n1,a\nfoo,b\n,c\n")
    schema = T.StructType([T.StructField("i", T.IntegerType())])
    assert [r.i for r in tables.read_csv(spark, path, schema).collect()] == [1, None, None]
    kept = tables.read_csv(spark, path, schema, malformed="keep").collect()
    assert [r.malformed_cells for r in kept] == [{}, {"i": "foo"}, {}]
    with pytest.raises(Exception, match="malformed cell in column i: foo"):
        tables.read_csv(spark, path, schema, malformed="fail").collect()
    with pytest.raises(ValueError):
        tables.read_csv(spark, path, schema, malformed="other")
