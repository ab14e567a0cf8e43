"""Native column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits of a digest fill a double's mantissa exactly (52 bits).
_UNIT_HEX_DIGITS = 13


def hash_key(key_cols: Sequence[str | Column], seed: int | str | Column) -> Column:
    """Hex digest of the key columns and a seed: a random order that no partitioning can change."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in key_cols]
    salt = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws("|", *parts, salt.cast("string")).cast("binary"))


def unit_interval(digest: Column) -> Column:
    """Uniform number in [0, 1) from a hex digest."""
    return F.conv(F.substring(digest, 1, _UNIT_HEX_DIGITS), 16, 10).cast("double") / F.lit(
        float(16**_UNIT_HEX_DIGITS)
    )


def cut(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; anything outside is null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("cut needs exactly one label per bin")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (column > F.lit(low)) & (column <= F.lit(high))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def clip_lower(column: Column, bound: float) -> Column:
    """Raise values below ``bound`` to it; null stays null."""
    return F.when(column < F.lit(bound), F.lit(bound).cast("double")).otherwise(column)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for an unknown condition)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def nan_as_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def rounded(column: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero, for reports that are compared across engines."""
    return F.round(column.cast("double"), digits) + F.lit(0.0)
