"""Weighted rendezvous hashing of records over shards, in built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import materialize

#: Cells over which the places of all shards are counted; the broadcast table has a row for each at most.
CELLS = 1 << 16
#: Slots that one row is written out to at once.
RUN = 100_000


def shard_score(key: Column, shard: int | Column, weight: float | Column) -> Column:
    """Score of a key for a shard: an exponential variable with rate ``weight``, drawn from a digest of both."""
    name = shard if isinstance(shard, Column) else F.lit(shard)
    digest = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("null")), name.cast("string")).cast("binary"))
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**13))
    return -F.ln(unit) / weight


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the least score; a tie goes to the lower number. Shards of weight 0 get nothing."""
    live = [
        F.struct(shard_score(key, shard, F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard"))
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    if not live or min(weights) < 0:
        raise ValueError("weights must not be negative, and one must be positive")
    return F.array_min(F.array(*live))["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], shard_col: str = "shard") -> DataFrame:
    """Add the shard of each row: a projection, without a shuffle.

    The key and the weights alone decide. A shard's share of keys is its share of the weights; a new shard
    takes keys only into itself, a removed one gives away only its own. Rows with one key stay together, a
    null key is a key like any other, and an existing column named ``shard_col`` is replaced.
    """
    return df.withColumn(shard_col, best_shard(F.col(key), weights))


def assign_slots(df: DataFrame, by: Sequence[str], shard_col: str = "shard") -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... by a digest of the columns ``by``, as column ``slot``.

    Returns ``shard_col``, ``by`` and ``slot``. Rows equal in ``by`` are counted before they are shuffled and
    written out again in the end, so one value that fills a third of the table is one row until then. A
    shard's rows are dealt to cells, ranges of the digest; counts per cell give each cell its first slot, and rows
    are sorted within a cell only. A value's copies are written out in runs of at most ``RUN`` slots, which are dealt out
    before. An empty table gives no rows.
    """
    # 52 bits, so that the cell is exact in floating point; nulls count as the word
    names = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by]
    order = F.conv(F.substring(F.md5(F.concat_ws("|", *names).cast("binary")), 1, 13), 16, 10).cast("long")
    counted = df.groupBy(shard_col, *by).agg(F.count("*").alias("_copies"))
    counted = materialize(counted.withColumn("_order", order))
    shards = max(1, counted.select(shard_col).distinct().count())
    cells = max(1, CELLS // shards)
    cell = F.floor(F.col("_order").cast("double") / F.lit(float(16**13)) * F.lit(float(cells)))
    sizes = counted.groupBy(shard_col, cell.alias("_cell")).agg(F.sum("_copies").alias("_size"))
    before = Window.partitionBy(shard_col).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(shard_col, "_cell", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    inside = (
        Window.partitionBy(shard_col, "_cell")
        .orderBy("_order", *by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        counted.withColumn("_cell", cell)
        .withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
        .join(F.broadcast(firsts), [shard_col, "_cell"])
    )
    start = F.col("_first") + F.col("_before")
    end = start + F.col("_copies") - 1
    runs = placed.select(shard_col, *by, F.explode(F.sequence(start, end, F.lit(RUN))).alias("_from"), end.alias("_end"))
    if counted.where(F.col("_copies") > RUN).limit(1).count():
        runs = runs.repartition(shard_col, "_from")
    slots = F.sequence(F.col("_from"), F.least(F.col("_from") + RUN - 1, "_end"))
    return runs.select(shard_col, *by, F.explode(slots).alias("slot"))


def write_shards(df: DataFrame, path: str, key: str, weights: Sequence[float]) -> None:
    """Write each shard to its own folder ``shard=N``; each task writes to the shards of its rows."""
    assign_shards(df, key, weights).write.partitionBy("shard").parquet(path)
