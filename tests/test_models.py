import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.operators import models
from tarmac.plans import flights as plan
from tarmac.contract.tables import flights


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(150):
        c = i % 3
        x, y = rng.normal(loc=(4 * c, -3 * c), scale=0.7)
        rows.append((i, "uvw"[c], float(x), float(y), 1.0))
    return spark.createDataFrame(rows, "id long, cls string, x double, y double, ARR_DELAY double")


def test_metrics_known_answer(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1), (2, 0)], "label int, prediction int")
    row = models.classification_metrics(df).first()
    f0, f1 = 2 * 2 / (3 + 3), 2 * 1 / (1 + 2)
    assert row.accuracy == pytest.approx(0.6) and row.f1_weighted == pytest.approx((3 * f0 + f1) / 5)


def test_assembled_table_leaves_out_targets(blobs):
    table = models.assemble(blobs, "cls", "id")
    assert table.first().features.size == 2
    assert {r.label for r in table.select("label").distinct().collect()} == {0.0, 1.0, 2.0}
    with pytest.raises(ValueError):
        models.assemble(blobs.select("id", "cls"), "cls", "id")


def test_candidates_beat_the_baseline(blobs):
    chosen = models.candidate_models("id")
    quick = {
        n: chosen[n]
        for n in ("Baseline (majority class)", "Logistic Regression", "k-Nearest Neighbors (kNN)", "Decision Tree")
    }

    def broken(train, test, n):
        raise RuntimeError("no luck")

    table = models.compare_models(blobs, "cls", "id", models={**quick, "Broken": broken}).collect()
    assert table[-1].model == "Broken" and table[-1].cv_accuracy_mean is None and "no luck" in table[-1].message
    scores = {r.model: r.cv_accuracy_mean for r in table}
    assert scores["Baseline (majority class)"] == pytest.approx(1 / 3, abs=0.01)
    assert all(scores[n] > 0.9 for n in list(quick)[1:])
    ranked = [r.cv_accuracy_mean for r in table[:-1]]
    assert ranked == sorted(ranked, reverse=True)


def test_strategy_table(blobs):
    only = {"Decision Tree": models.strategy_models("id")["Decision Tree"]}
    row = models.validation_strategies(blobs, "cls", "id", bootstrap_n=3, models=only).first()
    assert row.split_accuracy > 0.9 and row.cv_accuracy_mean > 0.9 and row.bootstrap_accuracy_mean > 0.9
    assert 0 <= row.cv_accuracy_std < 0.2


def test_comparison_of_separable_ensembles(blobs):
    chosen = models.candidate_models("id")
    data = models.assemble(blobs, "cls", "id")
    train, test = data.where("id % 5 <> 0").cache(), data.where("id % 5 = 0").cache()
    for name in ("Random Forest", "Linear SVM"):
        row = models.classification_metrics(chosen[name](train, test, 120)).first()
        assert row.accuracy > 0.9


@pytest.mark.parametrize("method", ["smote", "oversample", "undersample", "positive_zero"])
def test_whole_cleaning_flow(spark, folder, method):
    cleaned, summary = plan.load_and_clean(flights(spark, folder), "FLIGHT_ID", method)
    late = cleaned.where("ARR_DELAY > 0").count()
    assert late > 0
    if method != "smote":
        assert cleaned.where("ARR_DELAY = 0").count() == late
    assert cleaned.where("DISTANCE is null or CRS_ELAPSED_TIME is null or ARR_DELAY < 0").count() == 0
    assert "CANCELLED" not in cleaned.columns and "FL_NUMBER" not in cleaned.columns
    row = summary.first()
    assert row.rows_in - row.rows_out == row.rows_removed


def test_engineered_table_is_numeric(spark, folder):
    cleaned, _ = plan.load_and_clean(flights(spark, folder), "FLIGHT_ID", "undersample")
    from tarmac.operators.clean import classify_delay

    out, params = plan.engineer(classify_delay(cleaned, "ARR_DELAY"))
    kinds = dict(out.dtypes)
    assert kinds["DELAY_CLASS"] == "int" and kinds["ROUTE"] == "double"
    assert kinds["AIRLINE_1-URGENT"] == "double" and "TIME_PERIOD" not in kinds
    assert params.where("feature = 'DISTANCE'").count() == 1
    reports = plan.named_tests(flights(spark, folder))
    assert set(reports) == {"delay_by_airline", "delay_by_time_of_day"}


def test_hold_outs_are_scored_in_one_pass(spark):
    """Scores of all hold-outs come from one table of counts, not from a scan of all predictions for each."""
    from pyspark.ml.functions import array_to_vector

    rows = [(i, float(i % 3), [float(i % 7), 1.0]) for i in range(400)]
    data = spark.createDataFrame(rows, "id long, label double, x array<double>").withColumn("features", array_to_vector("x"))

    class Remainder:
        def predict(self, rows, keep):
            found = rows.select(*keep, "x", "out", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("model"))
            held = found.where(F.expr("shiftright(out, model) & 1") == 1)
            return held.select(*keep, F.col("model").cast("int"), F.expr("x[0] % 3").alias("prediction"))

    fitter = models._Together(lambda rows, classes, many: Remainder())
    taken = {}
    for many in (2, 8):
        flags = [F.col("id") % 11 == m for m in range(many)]
        spark.sparkContext.setJobGroup(f"hold-outs {many}", "")
        got = fitter.scores(data, flags)
        taken[many] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"hold-outs {many}"))
        spark.sparkContext.setJobGroup("others", "")
        for score, flag in zip(got, flags, strict=True):
            row = models.classification_metrics(data.where(flag).withColumn("prediction", F.expr("x[0] % 3"))).first()
            assert score == (row["accuracy"], pytest.approx(row["f1_weighted"]))
    assert taken[8] <= taken[2] + 1
