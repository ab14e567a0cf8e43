"""Exact copies found by progressive refinement: length, then prefix hash, then full hash, each for what is left only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import FILTER_CELLS
from tarmac.session import materialize

#: Characters of a normalised text that the second level looks at.
PREFIX_CHARS = 64
_ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: str = "text") -> Column:
    """The text with every run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
    digest_all: bool = False,
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """Each row's group of equal texts, and whether the row is the one that stays.

    1. One pass counts texts by length, and inside a length by the hash of a prefix. These counts are of two
       numbers a text, are summed before the shuffle, and never hold text.
    2. A group of one text at either level is settled. What is left is marked by a table of at most
       ``FILTER_CELLS`` numbers; a mark set by chance only sends a row to the next level.
    3. A second pass hashes the full content (SHA-256) of marked rows only, and equal digests are equal texts.
       Settled rows go straight to the result; marked ones meet their group's least id by a join on the digest.
       A group is one row after partial sums, however many copies it has.

    :param keep: columns to return besides the added ones, ``id_col`` alone by default. Columns with the name of an
        added one are left out.
    :param digest_all: also hash the texts that are settled; otherwise their ``text_sha256`` is null.
    :return: ``keep``, ``keep_id`` (id of the row that stays), ``group_size`` (long), ``kept`` (boolean) and
        ``text_sha256`` (lowercase hex of the normalised text), one row per row. The row with the smallest id stays,
        a null id being larger than any other; of rows equal in id and text, any one. Null texts count as empty,
        empty texts are copies of each other, an empty table gives no rows.
    """
    keep = [c for c in (keep if keep is not None else [id_col]) if c not in _ADDED]
    whole = df.select(F.struct(F.col(id_col).alias("id"), F.struct(*keep).alias("row")).alias("r"), normalised(text).alias("t"))
    size, prefix = F.octet_length("t"), F.xxhash64(F.substring("t", 1, prefix_chars))
    by_prefix = whole.groupBy(size.alias("size"), prefix.alias("prefix")).agg(F.count("*").alias("n"))
    cell = F.pmod(F.xxhash64("size", "prefix"), F.lit(FILTER_CELLS))
    open_cells = materialize(by_prefix.where("n > 1").select(cell.alias("cell")).distinct())
    placed = whole.withColumn("cell", F.pmod(F.xxhash64(size, prefix), F.lit(FILTER_CELLS)))
    # at most FILTER_CELLS numbers, whatever the size of the table
    marked = placed.join(F.broadcast(open_cells.withColumn("open", F.lit(True))), "cell", "left")
    is_open = F.coalesce(F.col("open"), F.lit(False))
    digest = F.sha2(F.col("t").cast("binary"), 256)
    marked = marked.select(
        "r", is_open.alias("open"), (digest if digest_all else F.when(is_open, digest)).alias("digest"),
        F.monotonically_increasing_id().alias("no"),
    )
    # written once, so that the numbers of rows stay as they are
    marked = materialize(marked)
    order = F.struct(F.col("r.id").isNull().alias("none"), F.col("r.id").alias("id"), F.col("no").alias("no"))
    groups = marked.where("open").groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    groups = materialize(groups.where("n > 1"))
    alone = marked.where("NOT open").select(
        "r.row.*", F.col("r.id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("digest").alias("text_sha256"),
    )
    met = F.col("n").isNotNull()
    together = marked.where("open").join(groups, "digest", "left").select(
        "r.row.*",
        F.when(met, F.col("first.id")).otherwise(F.col("r.id")).alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        F.when(met, F.col("no") == F.col("first.no")).otherwise(F.lit(True)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return alone.unionByName(together)


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without the copies: of equal texts the row with the smallest id. Columns stay as they are."""
    packed = df.select(F.struct(*df.columns).alias("whole"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    return exact_copies(packed, "id", "text", ["whole"]).where("kept").select("whole.*")
