"""Synthetic minority rows between near neighbours, and the choice of balancing method."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import numeric_columns, require_columns
from tarmac.functions.expr import hash_key, unit_interval
from tarmac.operators.knn import knn_join, vector
from tarmac.operators.sampling import (
    balance_positive_zero,
    class_counts,
    draw_slots,
    hash_rank,
    oversample,
    undersample,
)
from tarmac.session import parameter_table


def smote(
    df: DataFrame,
    label: str,
    key: str,
    columns: Sequence[str] | None = None,
    k: int = 5,
    seed: int = 42,
    copy_col: str | None = None,
    **knn_options,
) -> DataFrame:
    """Fill every smaller class with points between a random row and one of its k neighbours.

    Numeric columns are interpolated with one random step per new row; all other columns, and the key,
    are those of the base row. ``is_synthetic`` marks the new rows. Missing numbers are an error. With
    ``copy_col`` the new rows of a class are numbered from 1, given rows have 0, and the key together with
    it is unique.
    """
    require_columns(df, [label, key])
    columns = list(columns) if columns is not None else numeric_columns(df, exclude=[label, key])
    if not columns:
        raise ValueError("no numeric columns to interpolate")
    work = df.where(F.col(label).isNotNull())
    gaps = work.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    if any(gaps.values()):
        raise ValueError(f"missing values in {[c for c, n in gaps.items() if n]}; impute first")
    needs = parameter_table(
        class_counts(work, label)
        .withColumnRenamed("n", "size")
        .withColumn("need", F.max("size").over(Window.partitionBy(F.lit(0))) - F.col("size"))
        .where(F.col("need") > 0)
    )
    short = needs.collect()
    original = work.withColumn("is_synthetic", F.lit(False))
    if copy_col:
        original = original.withColumn(copy_col, F.lit(0).cast("long"))
    if not short:
        return original
    if min(r["size"] for r in short) <= k:
        raise ValueError(f"a class to fill needs more than {k} rows")
    out = original
    for r in short:
        minority = work.where(F.col(label) == F.lit(r[label]))
        need = needs.where(F.col(label) == F.lit(r[label]))
        out = out.unionByName(_synthetic(minority, need, label, key, columns, k, seed, copy_col, knn_options))
    return out


def _synthetic(
    minority: DataFrame,
    need: DataFrame,
    label: str,
    key: str,
    columns: list[str],
    k: int,
    seed: int,
    copy_col: str | None,
    knn_options: dict,
) -> DataFrame:
    points = vector(minority, columns, "__v")
    neighbors = knn_join(points, points, k, key, key, "__v", exclude_self=True, **knn_options).select(
        F.col(key).alias("__base"), F.col("neighbor").alias("__other"), F.col("rank").alias("__k")
    )
    slots = draw_slots(need, [label], seed).select(
        "slot",
        (F.floor(unit_interval(F.col("digest")) * F.col("size")) + 1).alias("__rank"),
        (F.floor(unit_interval(hash_key([label, "slot", F.lit("neighbor")], seed)) * F.lit(k)) + 1).alias("__k"),
        unit_interval(hash_key([label, "slot", F.lit("step")], seed)).alias("__u"),
    )
    bases = hash_rank(points, [key], seed, output="__rank").withColumn("__base", F.col(key))
    others = points.select(F.col(key).alias("__other"), F.col("__v").alias("__w"))
    joined = (
        slots.hint("merge").join(bases, "__rank").join(neighbors, ["__base", "__k"]).join(others, "__other")
    )
    between = {
        c: (F.col("__v")[i] + F.col("__u") * (F.col("__w")[i] - F.col("__v")[i]))
        for i, c in enumerate(columns)
    }
    types = {f.name: f.dataType for f in minority.schema.fields}
    return joined.select(
        *[
            between[c].cast(types[c]).alias(c) if c in between else F.col(c)
            for c in minority.columns
        ],
        F.lit(True).alias("is_synthetic"),
        *([(F.col("slot") + 1).cast("long").alias(copy_col)] if copy_col else []),
    )


def balance(
    df: DataFrame, target: str, key: str, method: str = "smote", seed: int = 42, copy_col: str | None = None
) -> DataFrame:
    """Even out delayed (target > 0) and on-time rows. ``copy_col`` as in ``oversample``.

    ``smote``, ``oversample`` and ``undersample`` work on the two classes; ``positive_zero`` keeps all
    delayed rows and draws as many zero rows. A table with one empty class is returned unchanged.
    """
    if method not in ("smote", "oversample", "undersample", "positive_zero"):
        raise ValueError("method must be 'smote', 'oversample', 'undersample' or 'positive_zero'")
    require_columns(df, [target, key])
    if method == "positive_zero":
        return balance_positive_zero(df, target, [key], seed, copy_col)
    delayed = F.when(F.col(target) > 0, F.lit(1)).otherwise(F.lit(0))
    marked = df.withColumn("__delayed", delayed)
    if class_counts(marked, "__delayed").count() < 2:
        return df.withColumn(copy_col, F.lit(0).cast("long")) if copy_col else df
    if method == "undersample":
        out = undersample(marked, "__delayed", [key], seed)
        out = out.withColumn(copy_col, F.lit(0).cast("long")) if copy_col else out
    elif method == "oversample":
        out = oversample(marked, "__delayed", [key], seed, copy_col)
    else:
        columns = numeric_columns(df, exclude=[key])
        out = smote(marked, "__delayed", key, columns, seed=seed, copy_col=copy_col).drop("is_synthetic")
    return out.drop("__delayed")
