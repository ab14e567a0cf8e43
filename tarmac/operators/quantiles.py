"""Exact quantiles, and value ranges for ranking, that stay distributed at any group size.

A quantile needs the values at one or two positions of the sorted group. While the largest group is
counted to fit one task, the built-in exact aggregate finds them in one pass. Larger groups are narrowed: the group's span is cut into equal cells, a count per cell tells which cell
holds a position, and that cell becomes the next span. Every pass is a scan whose partial counts alone
are shuffled. What is left is counted per value and sorted. A value that fills a cell by itself needs no
sorting at all, so a hot value is harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import as_double, melt, wide_to_long
from tarmac.session import parameter_table

#: Distinct values of one group that a single ranking task may sort.
GROUP_ROWS = 2_000_000
#: Most ranges a group is split into.
MAX_RANGES = 4096
#: Largest group whose distinct values one task may hold; the built-in aggregate does those in one pass.
DIRECT_ROWS = 1_000_000
#: Rows of one span that are sorted rather than narrowed further.
SORT_ROWS = 50_000
CELLS = 4096
MAX_PASSES = 12
#: Boundaries the driver may hold in all.
_DRIVER_BOUNDS = 4_000_000


def group_sizes(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return long.groupBy(*keys).agg(F.count(value).alias("n"))


def range_boundaries(
    long: DataFrame, keys: Sequence[str], value: str, group_rows: int = GROUP_ROWS
) -> DataFrame | None:
    """``(keys, n, bounds)`` of the groups above ``group_rows``; None when there are none.

    The table is fixed once, because approximate quantiles may differ from run to run and every later
    step has to see the same boundaries. It holds at most rows / group_rows groups.
    """
    large = group_sizes(long, keys, value).where(F.col("n") > group_rows)
    most = large.agg(F.max("n")).first()[0]
    if most is None:
        return None
    ranges = 2
    while ranges < MAX_RANGES and ranges * group_rows < 2 * most:
        ranges *= 2
    large = parameter_table(large)
    levels = [i / ranges for i in range(1, ranges)]
    found = F.array_sort(
        F.array_distinct(F.percentile_approx(value, levels, max(10_000, 10 * ranges)))
    )
    # padded to a power of two less one, the shape the lookup halves
    padded = F.slice(
        F.concat(found, F.array_repeat(F.lit(float("inf")), ranges - 1)), 1, ranges - 1
    )
    bounds = (
        long.join(large, list(keys), "left_semi")
        .groupBy(*keys)
        .agg(F.count(value).alias("n"), padded.alias("bounds"))
    )
    return parameter_table(bounds, max(1, _DRIVER_BOUNDS // ranges))


def with_range(long: DataFrame, keys: Sequence[str], value: str, bounds: DataFrame) -> DataFrame:
    """Add ``range_id``, the number of boundaries below the value, by halving.

    Groups without boundaries form a single range.
    """
    width = bounds.select(F.max(F.size("bounds"))).first()[0] + 1
    limits = bounds.select(*[F.col(k).alias(f"__{k}") for k in keys], "bounds")
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"__{k}"))
    out = long.join(limits, match, "left").withColumn("range_id", F.lit(0))
    step = width // 2
    while step:
        below = F.get("bounds", F.col("range_id") + F.lit(step - 1)) < F.col(value)
        out = out.withColumn("range_id", F.col("range_id") + F.when(below, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return out.drop("bounds", *[f"__{k}" for k in keys])


def range_offsets(ranged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and up to the end of every range."""
    order = Window.partitionBy(*keys).orderBy("range_id")
    return (
        ranged.groupBy(*keys, "range_id")
        .agg(F.count(F.lit(1)).alias("in_range"))
        .withColumn("upto", F.sum("in_range").over(order))
        .select(*keys, "range_id", (F.col("upto") - F.col("in_range")).alias("rows_before"), "upto")
    )


def extents(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """``(keys..., n, lo, hi)`` of every group."""
    return long.groupBy(*keys).agg(
        F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )


def exact_quantiles(
    long: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    extent: DataFrame | None = None,
    direct_rows: int = DIRECT_ROWS,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """``(keys..., quantiles array)`` with linear interpolation between order statistics.

    Rows with a missing key belong to no group. ``extent`` may pass on the groups' ``(n, lo, hi)``.
    """
    keys = list(keys)
    long = long.select(*keys, F.col(value).alias("v")).na.drop()
    extent = parameter_table(extents(long, keys, "v") if extent is None else extent)
    if (extent.agg(F.max("n")).first()[0] or 0) <= direct_rows:
        return long.groupBy(*keys).agg(F.percentile("v", _levels(probs)).alias("quantiles"))
    places = F.array(*[f((F.col("n") - 1) * F.lit(float(p))) for p in probs for f in (F.floor, F.ceil)])
    wanted = extent.select(*keys, "n", F.explode(F.array_distinct(places)).alias("pos"))
    brackets = extent.select(
        *keys, "n", "lo", "hi", F.lit(0).cast("long").alias("before"), F.col("n").alias("c")
    )
    crowded = (F.col("c") > sort_rows) & (F.col("lo") < F.col("hi"))
    for _ in range(MAX_PASSES):
        if brackets.where(crowded).isEmpty():
            break
        brackets = parameter_table(
            brackets.where(~crowded).unionByName(
                _narrowed(long, keys, brackets.where(crowded), wanted)
            )
        )
    order = Window.partitionBy(*keys, "before").orderBy("v")
    counted = (
        long.join(brackets.drop("c"), keys)
        .where(F.col("v").between(F.col("lo"), F.col("hi")))
        .groupBy(*keys, "n", "before", "v")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("last", F.col("before") + F.sum("c").over(order))
        .withColumn("first", F.col("last") - F.col("c"))
    )
    return _picked(counted, keys, probs)


def _narrowed(long: DataFrame, keys: list[str], brackets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The cells of each bracket that hold a wanted position, as new brackets."""
    share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    cell = F.least(F.floor(share * F.lit(float(CELLS))), F.lit(CELLS - 1))
    order = Window.partitionBy(*keys, "before").orderBy("cell")
    cells = (
        long.join(brackets.select(*keys, "lo", "hi", "before"), keys)
        .where(F.col("v").between(F.col("lo"), F.col("hi")))
        .groupBy(*keys, "before", cell.alias("cell"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .withColumn("upto", F.col("before") + F.sum("c").over(order))
        .withColumn("before", F.col("upto") - F.col("c"))
    )
    return (
        cells.join(wanted, keys)
        .where((F.col("before") <= F.col("pos")) & (F.col("pos") < F.col("upto")))
        .select(*keys, "n", "lo", "hi", "before", "c")
        .distinct()
    )


def _picked(counted: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles from ``(keys..., v, first, last, n)``: the value v holds positions first to last - 1."""
    aggregates = [F.max("n").alias("n")]

    def holder(position: Column) -> Column:
        return F.max(F.when((F.col("first") <= position) & (position < F.col("last")), F.col("v")))

    at = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    for i, a in enumerate(at):
        aggregates += [holder(F.floor(a)).alias(f"l{i}"), holder(F.ceil(a)).alias(f"h{i}")]
    between = [
        F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * (a - F.floor(a)) for i, a in enumerate(at)
    ]
    return counted.groupBy(*keys).agg(*aggregates).select(*keys, F.array(*between).alias("quantiles"))


def _levels(probs: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(p)) for p in probs])


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    extent: DataFrame | None = None,
    direct_rows: int = DIRECT_ROWS,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """``(by..., feature, quantiles)`` of several columns at once; small groups need no long form."""
    by = list(by)
    work = as_double(df, columns, by)
    if by:
        work = work.na.drop(subset=by)
    if extent is None:
        known = F.array_max(F.array(*[F.count(F.col(c)) for c in columns]))
        largest = work.groupBy(*by).agg(known.alias("n")).agg(F.max("n")).first()[0] or 0
    else:
        largest = extent.agg(F.max("n")).first()[0] or 0
    if largest > direct_rows:
        return exact_quantiles(
            melt(df, columns, by), [*by, "feature"], "value", probs, extent, direct_rows, sort_rows
        )
    wide = work.groupBy(*by).agg(
        *[F.percentile(c, _levels(probs)).alias(f"__q{i}") for i, c in enumerate(columns)]
    )
    fields = {c: {"quantiles": F.col(f"__q{i}")} for i, c in enumerate(columns)}
    return wide_to_long(wide, by, fields).where(F.col("quantiles").isNotNull())
