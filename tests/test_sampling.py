from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.operators import balance, sampling
from tarmac.functions.expr import hash_key


def classes(spark, **sizes):
    rows, key = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((key, label, float(key % 17)))
            key += 1
    return spark.createDataFrame(rows, "id long, label string, x double")


def test_rank_does_not_depend_on_partitions_or_prefix(spark):
    df = classes(spark, a=300, b=40)
    base = sorted(map(tuple, sampling.hash_rank(df, ["id"], by=["label"]).collect()))
    for parts, prefix in ((1, 1), (7, 2), (13, 3)):
        again = sampling.hash_rank(df.repartition(parts), ["id"], by=["label"], prefix_len=prefix)
        assert sorted(map(tuple, again.collect())) == base
    ranks = sorted(r[3] for r in base if r[1] == "a")
    assert ranks == list(range(1, 301))


def test_split_is_exact_and_stable(spark):
    df = classes(spark, a=70, b=31)
    one = {r.id: r.split for r in sampling.train_test_split(df, ["id"]).collect()}
    two = {r.id: r.split for r in sampling.train_test_split(df.repartition(9), ["id"]).collect()}
    assert one == two and Counter(one.values())["test"] == 21  # ceil of a fifth
    other = {r.id: r.split for r in sampling.train_test_split(df, ["id"], seed=7).collect()}
    assert other != one


def test_stratified_split_keeps_total_and_shares(spark):
    df = classes(spark, a=50, b=30, c=7)
    got = Counter((r.label, r.split) for r in sampling.train_test_split(df, ["id"], stratify="label").collect())
    assert sum(n for (_, s), n in got.items() if s == "test") == 18
    assert abs(got["a", "test"] - 50 * 18 / 87) < 1 and abs(got["c", "test"] - 7 * 18 / 87) < 1


def test_folds_differ_by_one_row_at_most(spark):
    df = classes(spark, a=53, b=12)
    got = Counter((r.label, r.fold) for r in sampling.stratified_kfold(df, "label", ["id"], 5).collect())
    for label in "ab":
        sizes = [got[label, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_narrow_slivers_give_the_same_cut(spark):
    df = classes(spark, a=500).withColumn("one", F.lit(0))
    digest = hash_key(["id"], 42)
    counts = sampling.digest_counts(df, ["id"], digest, ["one"])
    targets = spark.createDataFrame([(0, 0, 100), (0, 1, 333)], "one int, cut int, target long")
    wide = sampling.rank_cuts(df, counts, targets, ["id"], digest, ["one"]).collect()
    tight = sampling.rank_cuts(df, counts, targets, ["id"], digest, ["one"], sliver_rows=0).collect()
    assert wide == tight


def test_argument_errors(spark):
    df = classes(spark, a=3)
    for call in (
        lambda: sampling.train_test_split(df, ["id"], 1.5),
        lambda: sampling.train_test_split(df, ["nope"]),
        lambda: sampling.stratified_kfold(df, "label", ["id"], 1),
        lambda: sampling.stratified_kfold(df, "label", ["id"], 5),
        lambda: sampling.shuffle_split(df, ["id"], 2, 0.0),
        lambda: balance.balance(df, "x", "id", "magic"),
    ):
        with pytest.raises(ValueError):
            call()


def test_sample_larger_than_table_keeps_all(spark):
    assert sampling.sample_n(classes(spark, a=9), 50, ["id"]).count() == 9


def test_hold_out_flags_equal_shuffle_split(spark):
    df = classes(spark, a=40)
    flags = sampling.hold_out_flags(df, ["id"], 3)
    long = sampling.shuffle_split(df, ["id"], 3)
    want = {(r.split, r.id) for r in long.collect() if r.part == "test"}
    got = {(i, r.id) for r in flags.collect() for i in range(3) if r[f"held_{i}"]}
    assert got == want and len(want) == 3 * 15


@pytest.mark.parametrize("sizes", [(10, 3), (3, 10), (5, 0)])
def test_balancing_both_ways_and_empty_class(spark, sizes):
    late, on_time = sizes
    rows = [(i, 5.0, float(i)) for i in range(late)] + [(100 + i, 0.0, float(i)) for i in range(on_time)]
    df = spark.createDataFrame(rows, "id long, delay double, x double")
    for method in ("undersample", "oversample", "positive_zero"):
        got = Counter(r.delay > 0 for r in balance.balance(df, "delay", "id", method).collect())
        if on_time == 0:
            assert got == {True: late}
        elif method == "undersample":
            assert got == {True: 3, False: 3}
        elif method == "oversample":
            assert got == {True: 10, False: 10}
        else:
            assert got == {True: late, False: late}


def test_many_draws_from_one_hot_class(spark):
    needs = spark.createDataFrame([("a", 3, 250_001)], "label string, size long, need long")
    slots = sampling.draw_slots(needs, ["label"], 1)
    assert slots.count() == 250_001 and slots.select("slot").distinct().count() == 250_001
    drawn = sampling.draw_with_replacement(classes(spark, a=3), needs, ["label"], ["id"], 1)
    per_row = [r["count"] for r in drawn.groupBy("id").count().collect()]
    assert sum(per_row) == 250_001 and min(per_row) > 82_000


def test_synthetic_points_lie_between_neighbours(spark):
    rows = [(i, "big", float(i), i, "t") for i in range(60)]
    rows += [(100 + i, "small", 10.0 * i, 3 * i, f"s{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "id long, label string, x double, n int, tag string")
    out = balance.smote(df, "label", "id")
    assert dict(out.dtypes)["n"] == "int"
    assert Counter(r.label for r in out.collect()) == {"big": 60, "small": 60}
    for r in out.where("is_synthetic").collect():
        assert 0.0 <= r.x <= 110.0 and abs(r.x - 10.0 * (r.id - 100)) <= 50.0
        assert r.tag == f"s{r.id - 100}"


def test_synthetic_rows_need_complete_and_enough_rows(spark):
    gap = spark.createDataFrame([(1, "a", None), (2, "b", 1.0)], "id long, label string, x double")
    few = spark.createDataFrame([(i, "a" if i else "b", float(i)) for i in range(9)], "id long, label string, x double")
    for df in (gap, few):
        with pytest.raises(ValueError):
            balance.smote(df, "label", "id")


def test_folds_of_copies_are_even(spark):
    rows = [(i, "rare" if i < 40 else "common") for i in range(840)]
    df = spark.createDataFrame(rows, "id long, kind string")
    full = sampling.oversample(df, "kind", ["id"], copy_col="copy")
    assert full.count() == full.select("id", "copy").distinct().count() == 1600
    folded = sampling.stratified_kfold(full, "kind", ["id", "copy"], 5)
    sizes = [r["count"] for r in folded.groupBy("kind", "fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
    keyed = sampling.unique_key(full, "id", "copy")
    assert keyed.select("id").distinct().count() == 1600
    few = sampling.balance_positive_zero(
        df.select("id", F.when(F.col("kind") == "rare", 0).otherwise(5).alias("t")), "t", ["id"], copy_col="copy"
    )
    assert few.count() == few.select("id", "copy").distinct().count() == 1600


def test_draws_are_not_broadcast(spark):
    """The blocks that draws are made from are tiny, the draws are not."""
    rows = [(i, 0 if i < 40 else 5, "rare" if i < 40 else "common") for i in range(840)]
    df = spark.createDataFrame(rows, "id long, t int, kind string")
    for drawn in (sampling.balance_positive_zero(df, "t", ["id"]), sampling.oversample(df, "kind", ["id"])):
        assert len(drawn.collect()) == 1600
        plan = drawn._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert any("SortMergeJoin" in line and "__rank" in line for line in plan.splitlines())
        assert not any("BroadcastHashJoin" in line and "__rank" in line.split("Join", 1)[1].split("Inner")[0] for line in plan.splitlines())


def test_smote_draws_are_not_broadcast(spark):
    rows = [(i, "rare" if i < 40 else "common", float(i * 7 % 101)) for i in range(840)]
    full = balance.smote(spark.createDataFrame(rows, "id long, kind string, x double"), "kind", "id")
    assert len(full.collect()) == 1600
    plan = full._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert any("SortMergeJoin" in line and "__rank" in line for line in plan.splitlines())


@pytest.mark.parametrize("have", [[7 * 10**9], [10**12, 3, 5 * 10**11 + 1, 10**10 + 7], [6, 3, 1]])
def test_shares_of_very_large_tables(spark, have):
    from fractions import Fraction
    from math import ceil

    sizes = spark.createDataFrame(list(enumerate(have)), "kind int, have long")
    got = {r.kind: r.target for r in sampling.split_shares(sizes, "kind", 0.2).collect()}
    n, wanted = sum(have), ceil(sum(have) * 0.2)
    exact = [Fraction(h * wanted, n) for h in have]
    want = [int(x) for x in exact]
    for i in sorted(range(len(have)), key=lambda i: (int(exact[i]) - exact[i], i))[: wanted - sum(want)]:
        want[i] += 1
    assert [got[i] for i in range(len(have))] == want and sum(want) == wanted
