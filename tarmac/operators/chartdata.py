"""The numbers behind histograms, box plots, density curves, fits and scatter samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import as_double, melt, require_columns, wide_to_long
from tarmac.functions.expr import hash_key
from tarmac.operators.quantiles import column_quantiles
from tarmac.operators.sampling import sample_n
from tarmac.session import parameter_table


def _extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, low, high)`` over the whole table."""
    work = as_double(df, columns)
    wide = work.agg(
        *[f(c).alias(f"{p}{i}") for i, c in enumerate(columns) for f, p in ((F.min, "l"), (F.max, "h"))]
    )
    extent = wide_to_long(
        wide, [], {c: {"low": F.col(f"l{i}"), "high": F.col(f"h{i}")} for i, c in enumerate(columns)}
    )
    return parameter_table(extent.where(F.col("low").isNotNull()))


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = 30, by: str | None = None
) -> DataFrame:
    """Equal-width bins from min to max with the last one closed; empty bins are kept.

    Groups share the edges of the whole table. A constant column gets width 1 around its value.
    """
    keep = [by] if by else []
    if by:
        df = df.where(F.col(by).isNotNull())
    edges = []
    for r in _extent(df, columns).collect():
        flat = r["low"] == r["high"]
        low = r["low"] - 0.5 if flat else r["low"]
        edges.append((r["feature"], low, 1.0 / bins if flat else (r["high"] - r["low"]) / bins))
    edges = df.sparkSession.createDataFrame(edges, "feature string, low double, width double")
    slot = F.least(F.floor((F.col("value") - F.col("low")) / F.col("width")), F.lit(bins - 1))
    counted = (
        melt(df, columns, keep)
        .join(F.broadcast(edges), "feature")
        .groupBy(*keep, "feature", slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if by:
        # one list of all edges rides along with every group
        groups = df.select(by).distinct()
        listed = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.asDict().items()]) for r in edges.collect()])
        edges = groups.select(by, F.inline(listed))
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counted, [*keep, "feature", "bin"], "left").select(
        *keep,
        "feature",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_from"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def box_stats(
    df: DataFrame, columns: Sequence[str], by: str | None = None, k: float = 1.5
) -> DataFrame:
    """Quartiles, whiskers at the most extreme value within k IQR, and the number of fliers."""
    keep = [by] if by else []
    if by:
        df = df.where(F.col(by).isNotNull())
    long = melt(df, columns, keep)
    keys = [*keep, "feature"]
    q = F.col("quantiles")
    quartiles = parameter_table(
        column_quantiles(df, columns, [0.25, 0.5, 0.75], keep).select(
            *keys, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")
        )
    )
    reach = k * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        long.join(quartiles, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("fliers"),
        )
    )


def strip_sample(
    df: DataFrame, column: str, by: str, n: int, key_cols: Sequence[str], seed: int = 42
) -> DataFrame:
    """At most n random points per group for a strip plot."""
    known = df.where(F.col(by).isNotNull() & F.col(column).isNotNull())
    return sample_n(known, n, key_cols, seed, by=[by]).select(by, *key_cols, column)


def pair_sample(
    df: DataFrame, columns: Sequence[str], n: int | None, key_cols: Sequence[str], seed: int = 42
) -> DataFrame:
    """Columns of a scatter or pair plot, on a random sample when n is given."""
    chosen = df if n is None else sample_n(df, n, key_cols, seed)
    return chosen.select(*key_cols, *columns)


#: Bandwidths beyond which a kernel is left out: there it is below 1e-15.
KERNEL_REACH = 9.0


def expansion_terms(tolerance: float) -> int:
    """Least number of terms with which the expansion of a Gaussian kernel around a point at most half a bandwidth from
    the value is off by at most ``tolerance``, wherever it is read.

    With t the value's and s the place's distance from the centre in units of sqrt(2) bandwidths, the kernel is the sum
    of t^m / m! * H_m(s) * exp(-s^2) over all m. By Cramer's inequality term m is at most 1.09 * (sqrt(2) |t|)^m /
    sqrt(m!), and sqrt(2) |t| is at most 1/2.
    """
    terms = 1
    while True:
        first = 1.09 * 0.5**terms / math.sqrt(math.factorial(terms))
        if first / (1 - 0.5 / math.sqrt(terms + 1)) <= tolerance:
            return terms
        terms += 1


def kde(
    df: DataFrame,
    columns: Sequence[str],
    grid: int = 200,
    by: str | None = None,
    ridge: bool = False,
    bins: int | None = None,
    tolerance: float = 1e-13,
) -> DataFrame:
    """Gaussian density on a grid, bandwidth n^(-1/5) times the sample standard deviation.

    Values are gathered into cells one bandwidth wide. A cell is a row of sums of powers of its values' distances from
    its middle, so tasks sum up what they read and hand on a row per cell, however many values there are. The
    kernels of a cell are read from these sums at the grid points within ``KERNEL_REACH`` bandwidths. Kernels
    have height 1 here, and each is off by at most ``tolerance`` (``expansion_terms``); the density by as much over
    bandwidth * sqrt(2 pi). ``bins`` first moves values to the middles of that many equal-width cells. ``ridge``
    widens the grid by three bandwidths on both sides.
    """
    keep = [by] if by else []
    if by:
        df = df.where(F.col(by).isNotNull())
    keys = [*keep, "feature"]
    long = melt(df, columns, keep)
    shape = parameter_table(
        long.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.stddev_samp("value").alias("sd"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .where((F.col("n") > 1) & (F.col("sd") > 0))
        .withColumn("bandwidth", F.pow(F.col("n"), F.lit(-0.2)) * F.col("sd"))
    )
    margin = 3 * F.col("bandwidth") if ridge else F.lit(0.0)
    start, stop = F.col("low") - margin, F.col("high") + margin
    step = (stop - start) / F.lit(float(grid - 1))
    sums = _cell_sums(long.join(shape, keys), keys, bins, expansion_terms(tolerance))
    middle = F.col("low") + (F.col("cell") + 0.5) * F.col("bandwidth")
    reach = KERNEL_REACH * F.col("bandwidth")
    first = F.greatest(F.lit(0.0), F.ceil((middle - reach - start) / step).cast("double")).cast("int")
    last = F.least(F.lit(grid - 1.0), F.floor((middle + reach - start) / step).cast("double")).cast("int")
    spread = (
        sums.join(shape, keys)
        .withColumn("middle", middle)
        .withColumn("grid_point", F.explode(F.when(first <= last, F.sequence(first, last))))
    )
    s = (start + F.col("grid_point") * step - F.col("middle")) / (F.col("bandwidth") * F.sqrt(F.lit(2.0)))
    read = spread.groupBy(*keys, "grid_point").agg(F.sum(_read_expansion("sums", s)).alias("mass"))
    frame = shape.withColumn("grid_point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    scale = F.col("n") * F.col("bandwidth") * F.sqrt(F.lit(2.0) * F.pi())
    return frame.join(read, [*keys, "grid_point"], "left").select(
        *keys,
        "grid_point",
        (start + F.col("grid_point") * step).alias("x"),
        # what is left of the expansion far from all values may be below zero by its error
        F.greatest(F.lit(0.0), F.coalesce("mass", F.lit(0.0)) / scale).alias("density"),
        "bandwidth",
    )


def _cell_sums(long: DataFrame, keys: Sequence[str], bins: int | None, terms: int) -> DataFrame:
    """``keys``, ``cell`` and ``sums``: for m = 0, 1, ... the sum of t^m / m! over the cell's values."""
    value = F.col("value")
    if bins:
        width = (F.col("high") - F.col("low")) / bins
        value = F.col("low") + (F.least(F.floor((value - F.col("low")) / width), F.lit(bins - 1)) + 0.5) * width
    place = (value - F.col("low")) / F.col("bandwidth")
    cell = F.floor(place)
    placed = long.select(*keys, cell.alias("cell"), ((place - cell - 0.5) / F.sqrt(F.lit(2.0))).alias("t"))
    powers = [F.sum(F.pow("t", F.lit(float(m))) / float(math.factorial(m))).alias(f"s{m}") for m in range(1, terms)]
    counted = placed.groupBy(*keys, "cell").agg(F.count(F.lit(1)).cast("double").alias("s0"), *powers)
    return counted.select(*keys, "cell", F.array(*[f"s{m}" for m in range(terms)]).alias("sums"))


def _read_expansion(sums: str, s: Column) -> Column:
    """Sum over m of sums[m] * H_m(s) * exp(-s^2), with H_(m+1) = 2 s H_m - 2 m H_(m-1)."""
    begin = F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("now"), F.lit(0.0).alias("before"), F.lit(0.0).alias("m"))

    def add(a: Column, c: Column) -> Column:
        return F.struct(
            (a["total"] + c * a["now"]).alias("total"),
            (2.0 * s * a["now"] - 2.0 * a["m"] * a["before"]).alias("now"),
            a["now"].alias("before"),
            (a["m"] + 1.0).alias("m"),
        )

    return F.aggregate(sums, begin, add, lambda a: a["total"]) * F.exp(-s * s)


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line; null on a constant x."""
    require_columns(df, [x, y])
    work = as_double(df, [x, y]).na.drop()
    return work.agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
    )


def linear_fit_ci(
    df: DataFrame,
    x: str,
    y: str,
    key_cols: Sequence[str],
    replicates: int = 1000,
    grid: int = 100,
    level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """Bootstrap band of the line: ``(grid_point, x, fit, low, high)``.

    Each row enters each replicate with a Poisson(1) weight drawn from its key's digest. A task keeps
    five running sums per replicate and emits only those, so the shuffle is replicates x tasks rows.
    """
    require_columns(df, [x, y, *key_cols])
    work = as_double(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), [x, y], key_cols)
    digest = F.conv(F.substring(hash_key(key_cols, seed), 1, 15), 16, 10).cast("long")
    centre = work.agg(F.avg(x).alias("x"), F.avg(y).alias("y"), F.min(x).alias("l"), F.max(x).alias("h")).first()
    if centre["x"] is None:
        raise ValueError("no complete rows")
    names = ["sw", "sx", "sy", "sxx", "sxy"]

    def partial_sums(batches):
        total = np.zeros((replicates, 5))
        steps = np.cumsum(np.cumprod(np.concatenate([[1.0], 1.0 / np.arange(1, 19)])) * np.exp(-1.0))
        streams = np.arange(1, replicates + 1, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15)
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                u = part["digest"].to_numpy("uint64")[None, :] + streams[:, None]
                # 64-bit finaliser: one independent uniform per (replicate, row)
                u = (u ^ (u >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                u = (u ^ (u >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                u = (u ^ (u >> np.uint64(31))) >> np.uint64(11)
                weight = np.searchsorted(steps, u * 2.0**-53, side="right").astype("float64")
                a = part["x"].to_numpy() - centre["x"]
                b = part["y"].to_numpy() - centre["y"]
                total += weight @ np.column_stack([np.ones_like(a), a, b, a * a, a * b])
        yield pd.DataFrame(total, columns=names).assign(replicate=np.arange(replicates))

    schema = ", ".join(f"{c} double" for c in names) + ", replicate int"
    sums = (
        work.select(digest.alias("digest"), F.col(x).alias("x"), F.col(y).alias("y"))
        .mapInPandas(partial_sums, schema)
        .groupBy("replicate")
        .agg(*[F.sum(c).alias(c) for c in names])
    )
    slope = F.try_divide(
        F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy"),
        F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx"),
    )
    lines = sums.withColumn("slope", slope).withColumn(
        "mid", F.try_divide(F.col("sy") - F.col("slope") * F.col("sx"), F.col("sw"))
    )
    step = (centre["h"] - centre["l"]) / (grid - 1)
    at = F.lit(centre["l"]) + F.col("grid_point") * F.lit(step)
    fitted = F.lit(centre["y"]) + F.col("mid") + F.col("slope") * (at - F.lit(centre["x"]))
    tail = (1 - level) / 2
    band = (
        lines.withColumn("grid_point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .groupBy("grid_point")
        .agg(F.percentile(fitted, F.array(F.lit(tail), F.lit(1 - tail))).alias("band"))
    )
    line = linear_fit(df, x, y).first()
    best = F.lit(line["intercept"]).cast("double") + F.lit(line["slope"]).cast("double") * at
    return band.select(
        "grid_point",
        at.alias("x"),
        best.alias("fit"),
        F.col("band")[0].alias("low"),
        F.col("band")[1].alias("high"),
    )
