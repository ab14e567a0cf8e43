"""Average ranks with ties, from value counts.

Equal values share a rank, so rows are first counted per (feature, value, label): copies of one hot
value collapse before the shuffle. The running number of rows before each distinct value gives its
rank. A feature too long for one task is cut into value ranges whose offsets are known from a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.quantiles import (
    GROUP_ROWS,
    range_boundaries,
    range_offsets,
    with_range,
)
from tarmac.session import parameter_table


def value_positions(long: DataFrame, label: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(feature, value, total, before)``: rows equal to and below each distinct value.

    With ``label`` a row for each label that occurs at the value, its rows ``c``, and ``leads`` on one of them.
    """
    keep = [label] if label else []
    long = long.select("feature", "value", *keep)
    # -0.0 and 0.0 are one value
    long = long.withColumn("value", F.col("value") + F.lit(0.0))
    bounds = range_boundaries(long, ["feature"], "value", group_rows)
    if bounds is None:
        ranged = long.withColumn("range_id", F.lit(0))
    else:
        ranged = with_range(long, ["feature"], "value", bounds)
    counted = ranged.groupBy("feature", "range_id", "value", *keep).agg(
        F.count(F.lit(1)).alias("c")
    )
    within = Window.partitionBy("feature", "range_id").orderBy("value")
    up_to = F.sum("c").over(within.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    if label:
        same = Window.partitionBy("feature", "range_id", "value")
        placed = counted.withColumns(
            {"total": F.sum("c").over(same), "leads": F.row_number().over(same.orderBy(label)) == 1}
        ).withColumn("before", up_to - F.col("total"))
    else:
        placed = counted.withColumn("before", up_to - F.col("c")).withColumnRenamed("c", "total")
    if bounds is None:
        return placed.drop("range_id")
    offsets = parameter_table(range_offsets(ranged, ["feature"])).drop("upto")
    return (
        placed.join(offsets, ["feature", "range_id"])
        .withColumn("before", F.col("before") + F.col("rows_before"))
        .drop("range_id", "rows_before")
    )


def rank_sums(long: DataFrame, label: str = "label", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(feature, label, n, rank_sum, n_total, tie_sum)``; tie_sum is the sum of t^3 - t over ties."""
    ranked = value_positions(long, label, group_rows).withColumn(
        "avg_rank", F.col("before") + (F.col("total") + F.lit(1)) / F.lit(2.0)
    )
    t = F.col("total").cast("double")
    # one row per (value, label); only the leading one of a value carries its tie term
    sums = ranked.groupBy("feature", label).agg(
        F.sum("c").alias("n"),
        F.sum(F.col("c") * F.col("avg_rank")).alias("rank_sum"),
        F.sum(F.when(F.col("leads"), t * t * t - t).otherwise(0.0)).alias("__tie"),
    )
    per_feature = Window.partitionBy("feature")
    return sums.select(
        "feature",
        label,
        "n",
        "rank_sum",
        F.sum("n").over(per_feature).alias("n_total"),
        F.sum("__tie").over(per_feature).alias("tie_sum"),
    )
