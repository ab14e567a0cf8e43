"""Classifier assessment: split strategies, cross-validation and a ranked comparison.

Splits are columns of one assembled table. Linear models and boosted trees of all folds are fitted in the same scans.
Trees and forests of different folds are independent Spark jobs, so a few driver threads submit them together;
rows never pass through the driver, only sums and confusion counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from statistics import fmean, pstdev

from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import numeric_columns, require_columns
from tarmac.operators import fits
from tarmac.operators.encode import apply_labels, fit_labels
from tarmac.operators.knn import knn_classify
from tarmac.operators.sampling import (
    hold_out_flags,
    sample_n,
    stratified_kfold,
    train_test_split,
)

#: Rows of each fold's training part that the model comparison fits on unless told otherwise. All rows are scored.
COMPARISON_ROWS = 50_000
HOLD_OUT = 0.368
#: Hold-outs whose models are fitted in the same scans.
MODELS_TOGETHER = 60

# A fitter takes (train, test, n_train) and returns test rows with label and prediction.
Fitter = Callable[[DataFrame, DataFrame, int], DataFrame]


def assemble(
    df: DataFrame, target: str, key: str, also_exclude: Sequence[str] = ("ARR_DELAY",)
) -> DataFrame:
    """``(key, label, features)``: alphabetical label codes and a vector without missing values."""
    require_columns(df, [target, key])
    names = numeric_columns(df, exclude=[target, key, *also_exclude])
    if not names:
        raise ValueError("no numeric feature columns")
    known = df.where(F.col(target).isNotNull())
    coded = apply_labels(known, target, fit_labels(known, target), "label")
    filled = coded.select(
        key,
        F.col("label").cast("double").alias("label"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names],
    )
    return VectorAssembler(inputCols=names, outputCol="features").transform(filled).select(
        key, "label", "features"
    )


# --- metrics ----------------------------------------------------------------------------------


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``."""
    return predictions.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted F1 as one row."""
    return _metrics(confusion(predictions, label, prediction))


def _metrics(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``classification_metrics`` of the rows of ``confusion``, for each ``by``."""
    sides = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"),
                         F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("prediction").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"),
                         F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    per_class = sides.groupBy(*by, "c").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit")
    )
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("hit"), F.col("support") + F.col("called")), F.lit(0.0))
    return per_class.groupBy(*by).agg(
        F.sum("support").alias("n"),
        F.try_divide(F.sum("hit").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
        F.try_divide(F.sum(F.col("support") * f1), F.sum("support").cast("double")).alias("f1_weighted"),
    )


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Every test row gets the most frequent training label, the smallest one on a tie."""
    best = (
        train.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(label))
        .first()
    )
    if best is None:
        raise ValueError("no labelled training rows")
    kind = train.schema[label].dataType
    return test.withColumn("prediction", F.lit(best[label]).cast(kind))


# --- candidates -------------------------------------------------------------------------------


def _estimator(make: Callable[[int], object]) -> Fitter:
    def fit(train: DataFrame, test: DataFrame, n_train: int) -> DataFrame:
        model = make(n_train).fit(train)
        return model.transform(test).select("label", "prediction")

    return fit


class _Together:
    """A fitter whose models of several hold-outs are fitted in the same scans (``operators/fits``)."""

    def __init__(self, fit: Callable[[DataFrame, int, int], object]):
        self.fit = fit

    def __call__(self, train: DataFrame, test: DataFrame, n_train: int) -> DataFrame:
        model = self.fit(fits.prepared(train), _classes(train), 1)
        asked = fits.prepared(test, F.lit(1), ["label"])
        return model.predict(asked, ["label"]).select("label", "prediction")

    def held_out(self, data: DataFrame, flags: Sequence[Column]) -> DataFrame:
        """``label``, ``prediction`` and ``model`` (number of the flag) of every row that a flag holds out."""
        rows = fits.prepared(data, fits.held_out(list(flags)), ["label"])
        return self.fit(rows, _classes(data), len(flags)).predict(rows, ["label"])

    def scores(self, data: DataFrame, flags: Sequence[Column]) -> list[tuple[float, float]]:
        """(accuracy, weighted F1) of each hold-out."""
        # rows are counted as they are predicted; only the counts of all hold-outs are kept
        cells = self.held_out(data, flags).groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        rows = {r["model"]: (r["accuracy"], r["f1_weighted"]) for r in _metrics(cells, ["model"]).collect()}
        return [rows.get(m, (None, None)) for m in range(len(flags))]


def _classes(data: DataFrame) -> int:
    most = data.agg(F.max("label")).first()[0]
    if most is None:
        raise ValueError("no labelled training rows")
    return int(most) + 1


def _logistic(iterations: int) -> Fitter:
    return _Together(lambda rows, classes, models: fits.fit_linear(rows, fits.Softmax, classes, models, iterations))


def _tree(depth: int, seed: int) -> Fitter:
    return _estimator(lambda n: DecisionTreeClassifier(maxDepth=depth, seed=seed))


def _forest(trees: int, seed: int, depth: int) -> Fitter:
    return _estimator(lambda n: RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed))


def _boosting(rounds: int) -> Fitter:
    return _Together(lambda rows, classes, models: fits.fit_boosted(rows, classes, models, rounds, depth=3, rate=0.1))


def _linear_svm(iterations: int) -> Fitter:
    return _Together(lambda rows, classes, models: fits.fit_linear(rows, fits.SquaredHinge, classes, models, iterations))


def _nearest(k: int, key: str) -> Fitter:
    def fit(train: DataFrame, test: DataFrame, n_train: int) -> DataFrame:
        as_array = vector_to_array(F.col("features"))
        fitted = knn_classify(
            train.withColumn("__a", as_array), test.withColumn("__a", as_array), key, "label", k, "__a"
        )
        return test.select(key, "label").join(fitted, key).select("label", "prediction")

    return fit


def _baseline(train: DataFrame, test: DataFrame, n_train: int) -> DataFrame:
    return majority_baseline(train, test).select("label", "prediction")


def candidate_models(key: str, seed: int = 42, forest_depth: int = 30) -> dict[str, Fitter]:
    """The seven models of the comparison table."""
    # Model names and effort settings.
    return {
        "Baseline (majority class)": _baseline,
        "Logistic Regression": _logistic(1000),
        "k-Nearest Neighbors (kNN)": _nearest(5, key),
        "Decision Tree": _tree(10, seed),
        "Random Forest": _forest(100, seed, forest_depth),
        "Gradient Boosting": _boosting(100),
        "Linear SVM": _linear_svm(2000),
    }


def strategy_models(key: str, seed: int = 42, forest_depth: int = 30) -> dict[str, Fitter]:
    """The three models on which split strategies are compared."""
    # Model names and effort settings.
    return {
        "Logistic Regression": _logistic(500),
        "Decision Tree": _tree(8, seed),
        "Random Forest": _forest(50, seed, forest_depth),
    }


# --- validation -------------------------------------------------------------------------------


def _score(fitter: Fitter, train: DataFrame, test: DataFrame, n_train: int) -> tuple[float, float]:
    row = classification_metrics(fitter(train, test, n_train)).first()
    return row["accuracy"], row["f1_weighted"]


def _mean_std(values: Sequence[float]) -> tuple[float, float]:
    return round(fmean(values), 4), round(pstdev(values), 4)


def cross_validate(
    folded: DataFrame, fitter: Fitter, k: int, threads: int = 4, fold: str = "fold"
) -> list[tuple[float, float]]:
    """(accuracy, weighted F1) per fold; each fold is fitted once."""
    if isinstance(fitter, _Together):
        return fitter.scores(folded, [F.col(fold) == i for i in range(k)])
    n = folded.count()

    def one(i: int) -> tuple[float, float]:
        train, test = folded.where(F.col(fold) != i), folded.where(F.col(fold) == i)
        return _score(fitter, train.drop(fold), test.drop(fold), n * (k - 1) // k)

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(one, range(k)))


def validation_strategies(
    df: DataFrame,
    target: str,
    key: str,
    cv_folds: int = 5,
    bootstrap_n: int = 20,
    seed: int = 42,
    threads: int = 8,
    models: dict[str, Fitter] | None = None,
) -> DataFrame:
    """One row per model: single split, stratified folds, repeated hold-outs."""
    data = assemble(df, target, key)
    data = stratified_kfold(data, "label", [key], cv_folds, seed)
    data = train_test_split(data, [key], 0.2, seed, stratify="label")
    data = hold_out_flags(data, [key], bootstrap_n, HOLD_OUT, seed)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        models = models or strategy_models(key, seed)
        plain = [key, "label", "features"]
        tasks, scored = [], []
        flags = [
            ("split", F.col("split") == "test"),
            *[("cv", F.col("fold") == i) for i in range(cv_folds)],
            *[("hold", F.col(f"held_{i}")) for i in range(bootstrap_n)],
        ]
        for name, fitter in models.items():
            if isinstance(fitter, _Together):
                for start in range(0, len(flags), MODELS_TOGETHER):
                    part = flags[start : start + MODELS_TOGETHER]
                    found = fitter.scores(data, [flag for _, flag in part])
                    scored += [(name, kind, score) for (kind, _), score in zip(part, found)]
                continue
            tasks.append((name, "split", fitter, F.col("split") == "test", 0.8))
            tasks += [(name, "cv", fitter, F.col("fold") == i, 1 - 1 / cv_folds) for i in range(cv_folds)]
            tasks += [(name, "hold", fitter, F.col(f"held_{i}"), 1 - HOLD_OUT) for i in range(bootstrap_n)]

        def run(task):
            name, kind, fitter, is_test, train_share = task
            train, test = data.where(~is_test).select(*plain), data.where(is_test).select(*plain)
            return name, kind, _score(fitter, train, test, max(1, int(n * train_share)))

        with ThreadPoolExecutor(threads) as pool:
            scored += list(pool.map(run, tasks))
    finally:
        data.unpersist()
    rows = []
    for name in models:
        def of(kind: str) -> list[tuple[float, float]]:
            return [s for m, t, s in scored if m == name and t == kind]

        accuracy, f1 = of("split")[0]
        rows.append(
            (
                name,
                round(accuracy, 4),
                round(f1, 4),
                *_mean_std([a for a, _ in of("cv")]),
                *_mean_std([a for a, _ in of("hold")]),
            )
        )
    return df.sparkSession.createDataFrame(
        rows,
        "model string, split_accuracy double, split_f1_weighted double, cv_accuracy_mean double, "
        "cv_accuracy_std double, bootstrap_accuracy_mean double, bootstrap_accuracy_std double",
    )


def compare_models(
    df: DataFrame,
    target: str,
    key: str,
    cv_folds: int = 5,
    max_samples: int | None = COMPARISON_ROWS,
    seed: int = 42,
    threads: int = 8,
    models: dict[str, Fitter] | None = None,
) -> DataFrame:
    """Ranked table of all candidates under stratified cross-validation.

    With ``max_samples`` the models of a fold are fitted on at most that many rows outside it, drawn at random; the
    rows of the fold are all scored. A model that fails keeps a row with empty scores and the message.
    """
    data = assemble(df, target, key)
    data = stratified_kfold(data, "label", [key], cv_folds, seed).persist(StorageLevel.MEMORY_AND_DISK)
    models = models or candidate_models(key, seed)
    try:
        n_train = data.count() * (cv_folds - 1) // cv_folds
        fitted_on = [data.where(F.col("fold") != i) for i in range(cv_folds)]
        sampled = bool(max_samples) and n_train > max_samples
        if sampled:
            n_train = max_samples
            fitted_on = [sample_n(part, max_samples, [key], seed) for part in fitted_on]

        together = [] if sampled else [name for name, fitter in models.items() if isinstance(fitter, _Together)]
        done = []
        for name in together:
            try:
                found = models[name].scores(data, [F.col("fold") == i for i in range(cv_folds)])
                done += [(name, score, None) for score in found]
            except Exception as error:
                done.append((name, None, str(error)))

        def run(task: tuple[str, int]):
            name, i = task
            train, test = fitted_on[i], data.where(F.col("fold") == i)
            try:
                return name, _score(models[name], train.drop("fold"), test.drop("fold"), n_train), None
            except Exception as error:  # one failing model must not hide the others
                return name, None, str(error)

        with ThreadPoolExecutor(threads) as pool:
            done += list(pool.map(run, [(name, i) for name in models if name not in together for i in range(cv_folds)]))
    finally:
        data.unpersist()
    rows = []
    for name in models:
        scores = [s for m, s, _ in done if m == name]
        errors = [e for m, _, e in done if m == name and e is not None]
        if errors:
            rows.append((name, None, None, None, None, False, errors[0]))
        else:
            accuracy, f1 = _mean_std([a for a, _ in scores]), _mean_std([f for _, f in scores])
            rows.append((name, *accuracy, *f1, True, None))
    table = df.sparkSession.createDataFrame(
        rows,
        "model string, cv_accuracy_mean double, cv_accuracy_std double, cv_f1_weighted_mean double, "
        "cv_f1_weighted_std double, recommended boolean, message string",
    )
    return table.orderBy(F.desc_nulls_last("cv_accuracy_mean"), "model")


def run_model_selection(
    df: DataFrame,
    target: str,
    key: str,
    cv_folds: int = 5,
    bootstrap_n: int = 20,
    max_samples: int | None = COMPARISON_ROWS,
    seed: int = 42,
    threads: int = 8,
) -> dict[str, DataFrame]:
    """Both tables, with the same folds, seed and threads."""
    common = {"cv_folds": cv_folds, "seed": seed, "threads": threads}
    return {
        "validation_strategies": validation_strategies(df, target, key, bootstrap_n=bootstrap_n, **common),
        "model_comparison": compare_models(df, target, key, max_samples=max_samples, **common),
    }
