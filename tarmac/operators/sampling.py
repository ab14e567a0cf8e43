"""Reproducible random selection of exact size.

Rows are put in a random order by a digest of their key columns and a seed, so the choice depends on
neither partitioning nor engine. To take the first n rows of that order the table is not sorted and
not shuffled: digests are counted by prefix, the prefix that holds the n-th row is looked up, only
that sliver is ranked, and the resulting cut point is compared with every row in a projection.
A class that holds most of the table costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import require_columns
from tarmac.functions.expr import hash_key, unit_interval
from tarmac.session import parameter_table

_PREFIX = 3  # digest digits counted per pass: 4,096 prefixes per stratum
_SLIVER_ROWS = 1_000_000  # rows of one prefix that a task may rank
_RANK_ROWS = 500_000  # aimed rows per ranking task
_DRAW_BLOCK = 100_000  # draws generated per row of the block table


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def hash_rank(
    df: DataFrame,
    key_cols: Sequence[str],
    seed: int = 42,
    by: Sequence[str] = (),
    output: str = "hash_rank",
    prefix_len: int | None = None,
) -> DataFrame:
    """Exact 1-based random rank of every row, per stratum when ``by`` is given.

    A stratum is spread over 16^prefix_len ranking tasks; ranks inside a prefix are shifted by the
    number of rows under smaller prefixes.
    """
    require_columns(df, [*key_cols, *by])
    by = list(by)
    keyed = df.withColumn("__h", hash_key(key_cols, seed))
    if prefix_len is None:
        rows = df.count()
        prefix_len = 1
        while 16**prefix_len * _RANK_ROWS < rows:
            prefix_len += 1
    keyed = keyed.withColumn("__p", F.substring("__h", 1, prefix_len))
    running = Window.partitionBy(*by).orderBy("__p") if by else Window.partitionBy(F.lit(0)).orderBy("__p")
    offsets = (
        keyed.groupBy(*by, "__p")
        .agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__before", F.sum("__c").over(running) - F.col("__c"))
        .drop("__c")
    )
    offsets = parameter_table(offsets).select(
        *[F.col(b).alias(f"__by_{b}") for b in by], F.col("__p").alias("__q"), "__before"
    )
    match = F.col("__p") == F.col("__q")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    within = Window.partitionBy(*by, "__p").orderBy("__h", *key_cols)
    return (
        keyed.withColumn("__r", F.row_number().over(within))
        .join(offsets, match)
        .withColumn(output, (F.col("__r") + F.col("__before")).cast("long"))
        .select(*df.columns, output)
    )


def digest_counts(df: DataFrame, key_cols: Sequence[str], digest: Column, by: Sequence[str]) -> DataFrame:
    """``(by..., p, c)``: rows per digest prefix and stratum; null labels form no stratum."""
    keyed = df.select(*by, digest.alias("h")).na.drop(subset=list(by))
    return parameter_table(
        keyed.groupBy(*by, F.substring("h", 1, _PREFIX).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    )


def stratum_sizes(counts: DataFrame, by: Sequence[str], output: str = "n") -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("c").alias(output))


def _locate(counts: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The prefix that holds each target rank, and the rank wanted inside it."""
    order = Window.partitionBy(*by).orderBy("p")
    keys = list(dict.fromkeys([*by, "cut"]))
    return parameter_table(
        counts.withColumn("upto", F.sum("c").over(order))
        .withColumn("before", F.col("upto") - F.col("c"))
        .join(targets, list(by))
        .where((F.col("before") < F.col("target")) & (F.col("target") <= F.col("upto")))
        .select(*keys, "p", (F.col("target") - F.col("before")).alias("need"), "c")
    )


def rank_cuts(
    df: DataFrame,
    counts: DataFrame,
    targets: DataFrame,
    key_cols: Sequence[str],
    digest: Column,
    by: Sequence[str],
    sliver_rows: int = _SLIVER_ROWS,
) -> DataFrame:
    """Cut points of the digest order.

    ``targets`` holds ``(by..., cut, target)``; the result ``(by..., cuts)`` lists, by ascending cut,
    the digest and keys of the row with rank ``target``. A prefix with more than ``sliver_rows`` rows
    is split by further digits before it is ranked.
    """
    by = list(by)
    keyed = df.select(*by, *key_cols, digest.alias("h")).na.drop(subset=by)
    length = _PREFIX
    located = _locate(counts, targets, by)
    while length < 30 and (located.agg(F.max("c")).first()[0] or 0) > sliver_rows:
        inside = keyed.withColumn("p", F.substring("h", 1, length)).join(
            located.select(*by, "cut", "p"), [*by, "p"]
        )
        length += _PREFIX
        finer = parameter_table(
            inside.groupBy(*by, "cut", F.substring("h", 1, length).alias("p")).agg(
                F.count(F.lit(1)).alias("c")
            )
        )
        located = _locate(
            finer, located.select(*by, "cut", F.col("need").alias("target")), [*by, "cut"]
        )
    ranked = Window.partitionBy(*by, "cut").orderBy("h", *key_cols)
    cut_rows = (
        keyed.withColumn("p", F.substring("h", 1, length))
        .join(located, [*by, "p"])
        .withColumn("rn", F.row_number().over(ranked))
        .where(F.col("rn") == F.col("need"))
    )
    return parameter_table(
        cut_rows.groupBy(*by).agg(
            F.array_sort(F.collect_list(F.struct("cut", F.struct("h", *key_cols).alias("at")))).alias(
                "cuts"
            )
        )
    )


def cuts_passed(
    df: DataFrame,
    cuts: DataFrame,
    key_cols: Sequence[str],
    digest: Column,
    by: Sequence[str],
    output: str,
) -> DataFrame:
    """Add how many cut points lie strictly before each row; null where the stratum has none."""
    limits = cuts.select(*[F.col(b).alias(f"__by_{b}") for b in by], "cuts")
    match = F.lit(True)
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    here = F.struct(digest.alias("h"), *[F.col(c) for c in key_cols])
    return (
        df.withColumn("__here", here)
        .join(limits, match, "left")
        .withColumn(
            output, F.size(F.filter("cuts", lambda c: c["at"] < F.col("__here"))).cast("int")
        )
        .withColumn(output, F.when(F.col("cuts").isNotNull(), F.col(output)))
        .drop("__here", "cuts", *[f"__by_{b}" for b in by])
    )


def _take(
    df: DataFrame,
    counts: DataFrame,
    sizes: DataFrame,
    key_cols: Sequence[str],
    digest: Column,
    by: Sequence[str],
    output: str,
) -> DataFrame:
    """Flag the first ``target`` rows of every stratum; ``sizes`` is ``(by..., target)``."""
    targets = sizes.where(F.col("target") > 0).withColumn("cut", F.lit(0))
    cuts = rank_cuts(df, counts, targets, key_cols, digest, by)
    return cuts_passed(df, cuts, key_cols, digest, by, "__passed").withColumn(
        output, F.coalesce(F.col("__passed") == 0, F.lit(False))
    ).drop("__passed")


def sample_n(
    df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42, by: Sequence[str] = ()
) -> DataFrame:
    """Uniform sample of exactly n rows (all rows when there are fewer), per group when ``by`` is set."""
    require_columns(df, [*key_cols, *by])
    strata = list(by) or ["__all"]
    work = df if by else df.withColumn("__all", F.lit(0))
    digest = hash_key(key_cols, seed)
    counts = digest_counts(work, key_cols, digest, strata)
    sizes = stratum_sizes(counts, strata, "have").select(
        *strata, F.least(F.col("have"), F.lit(n).cast("long")).alias("target")
    )
    chosen = _take(work, counts, sizes, key_cols, digest, strata, "__in")
    return chosen.where("__in").select(*df.columns)


def train_test_split(
    df: DataFrame,
    key_cols: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    stratify: str | None = None,
    output: str = "split",
) -> DataFrame:
    """Add 'train' or 'test'; exactly ceil(n * test_size) rows are test.

    With ``stratify`` that total is shared out in proportion to the class sizes, whole rows first and
    the remainder by largest fraction (ties by label); rows without a label go to 'train'.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    require_columns(df, [*key_cols, *([stratify] if stratify else [])])
    stratum = stratify or "__all"
    work = df if stratify else df.withColumn("__all", F.lit(0))
    digest = hash_key(key_cols, seed)
    counts = digest_counts(work, key_cols, digest, [stratum])
    sizes = split_shares(stratum_sizes(counts, [stratum], "have"), stratum, test_size)
    flagged = _take(work, counts, sizes, key_cols, digest, [stratum], "__test")
    return flagged.withColumn(
        output, F.when(F.col("__test"), F.lit("test")).otherwise(F.lit("train"))
    ).select(*df.columns, output)


def split_shares(sizes: DataFrame, stratum: str, test_size: float) -> DataFrame:
    """``(stratum, target)``: test rows of each stratum out of its ``have`` rows, ceil(all * ``test_size``) in total, in
    proportion, whole rows first and the remainder by largest fraction (ties by stratum). The products are decimals,
    which hold sizes up to 10^18."""
    everything = Window.partitionBy(F.lit(0))
    n = F.col("n").cast("decimal(19,0)")
    share = F.col("have").cast("decimal(19,0)") * F.col("n_test").cast("decimal(19,0)")
    return (
        sizes.withColumn("n", F.sum("have").over(everything))
        .withColumn("n_test", F.ceil(F.col("n") * F.lit(test_size)))
        .withColumn("rest", share % n)
        .withColumn("whole", F.try_divide(share - F.col("rest"), n).cast("decimal(19,0)").cast("long"))
        .withColumn("left_over", F.col("n_test") - F.sum("whole").over(everything))
        .withColumn("place", F.row_number().over(everything.orderBy(F.desc("rest"), F.asc(stratum))))
        .select(
            stratum,
            (F.col("whole") + F.when(F.col("place") <= F.col("left_over"), 1).otherwise(0)).alias("target"),
        )
    )


def stratified_kfold(
    df: DataFrame,
    label: str,
    key_cols: Sequence[str],
    k: int = 5,
    seed: int = 42,
    output: str = "fold",
) -> DataFrame:
    """Add a fold number 0..k-1; fold sizes differ by at most one row within every class."""
    if k < 2:
        raise ValueError("k must be at least 2")
    require_columns(df, [*key_cols, label])
    digest = hash_key(key_cols, seed)
    counts = digest_counts(df, key_cols, digest, [label])
    sizes = parameter_table(stratum_sizes(counts, [label]))
    largest = sizes.agg(F.max("n")).first()[0]
    if largest is not None and largest < k:
        raise ValueError("k is larger than every class")
    targets = sizes.select(
        label, F.col("n"), F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("cut")
    ).select(label, "cut", F.ceil(F.col("cut") * F.col("n") / F.lit(k)).alias("target"))
    cuts = rank_cuts(df, counts, targets, key_cols, digest, [label])
    return cuts_passed(df, cuts, key_cols, digest, [label], output)


def shuffle_split(
    df: DataFrame,
    key_cols: Sequence[str],
    n_splits: int = 20,
    test_size: float = 0.368,
    seed: int = 42,
) -> DataFrame:
    """``(split, key..., part)`` for repeated hold-outs drawn without replacement."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    require_columns(df, key_cols)
    rows = df.select(*key_cols, F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split"))
    digest = hash_key(key_cols, F.col("split") + F.lit(seed))
    counts = digest_counts(rows, key_cols, digest, ["split"])
    sizes = stratum_sizes(counts, ["split"]).select(
        "split", F.ceil(F.col("n") * F.lit(test_size)).alias("target")
    )
    held = _take(rows, counts, sizes, key_cols, digest, ["split"], "held")
    return held.select(
        "split", *key_cols, F.when(F.col("held"), F.lit("test")).otherwise(F.lit("train")).alias("part")
    )


def hold_out_flags(
    df: DataFrame,
    key_cols: Sequence[str],
    n_splits: int,
    test_size: float = 0.368,
    seed: int = 42,
    prefix: str = "held_",
) -> DataFrame:
    """Add one boolean per hold-out, True on its test rows; the same draws as ``shuffle_split``."""
    rows = df.select(*key_cols, F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split"))
    digest = hash_key(key_cols, F.col("split") + F.lit(seed))
    counts = digest_counts(rows, key_cols, digest, ["split"])
    targets = stratum_sizes(counts, ["split"]).select(
        "split", F.lit(0).alias("cut"), F.ceil(F.col("n") * F.lit(test_size)).alias("target")
    )
    cuts = rank_cuts(rows, counts, targets, key_cols, digest, ["split"])
    # a cut is one row per split; as text and keys it becomes a literal of the projection
    by_split = {r["split"]: r["cuts"][0]["at"] for r in cuts.collect()}
    flags = {}
    for i in range(n_splits):
        here = F.struct(hash_key(key_cols, F.lit(i + seed)).alias("h"), *[F.col(c) for c in key_cols])
        at = by_split[i]
        limit = F.struct(
            F.lit(at["h"]).alias("h"),
            *[F.lit(at[c]).cast(df.schema[c].dataType).alias(c) for c in key_cols],
        )
        flags[f"{prefix}{i}"] = here <= limit
    return df.withColumns(flags)


def undersample(df: DataFrame, label: str, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Every class cut down to the size of the smallest one; rows without a label are left out."""
    require_columns(df, [*key_cols, label])
    digest = hash_key(key_cols, seed)
    counts = digest_counts(df, key_cols, digest, [label])
    smallest = stratum_sizes(counts, [label]).select(
        label, F.min("n").over(Window.partitionBy(F.lit(0))).alias("target")
    )
    return _take(df, counts, smallest, key_cols, digest, [label], "__in").where("__in").drop("__in")


def draw_slots(needs: DataFrame, by: Sequence[str], seed: int) -> DataFrame:
    """One row per wanted draw, ``(by..., size, slot, digest)``, from ``(by..., size, need)``.

    Draws are produced from blocks so that one class with a huge need is spread over many tasks. The planner takes
    the size of the blocks for that of the draws, and a hint on ``needs`` reaches them too: whoever joins them hints
    ``merge``, or all draws are broadcast.
    """
    blocks = (
        needs.where(F.col("need") > 0)
        .select(
            *by,
            "size",
            "need",
            F.explode(
                F.sequence(F.lit(0).cast("long"), F.col("need") - 1, F.lit(_DRAW_BLOCK).cast("long"))
            ).alias("start"),
        )
        .repartition(*by, "start")
    )
    return blocks.select(
        *by,
        "size",
        F.explode(
            F.sequence("start", F.least(F.col("start") + _DRAW_BLOCK - 1, F.col("need") - 1))
        ).alias("slot"),
    ).withColumn("digest", hash_key([*by, "slot"], seed))


def draw_with_replacement(
    df: DataFrame,
    needs: DataFrame,
    by: Sequence[str],
    key_cols: Sequence[str],
    seed: int,
    copy_col: str | None = None,
) -> DataFrame:
    """``need`` uniform draws with replacement from every stratum of ``df``.

    ``copy_col`` numbers the draws of a row from 1, so that the key columns and it are unique together.
    """
    rank = F.floor(unit_interval(F.col("digest")) * F.col("size")) + 1
    # counted per block of draws, so that the copies of one row are made by many tasks
    picks = (
        draw_slots(needs, by, seed)
        .groupBy(*by, rank.alias("__rank"), F.floor(F.col("slot") / _DRAW_BLOCK).alias("__block"))
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    ranked = hash_rank(df, key_cols, seed, by, "__rank")
    number = (F.col("__block") * F.lit(_DRAW_BLOCK) + F.col("__copy")).cast("long")
    numbered = [number.alias(copy_col)] if copy_col else []
    return (
        picks.hint("merge").join(ranked, [*by, "__rank"])
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
        .select(*df.columns, *numbered)
    )


def unique_key(df: DataFrame, key: str, copy_col: str) -> DataFrame:
    """Make ``key`` unique among copies: as text, followed by the copy's number where it is not 0."""
    text = F.col(key).cast("string")
    own = F.when(F.col(copy_col) > 0, F.concat_ws("#", text, F.col(copy_col).cast("string"))).otherwise(text)
    return df.withColumn(key, own)


def oversample(
    df: DataFrame, label: str, key_cols: Sequence[str], seed: int = 42, copy_col: str | None = None
) -> DataFrame:
    """Every class filled up to the size of the largest one with random copies of its own rows.

    Copies repeat the key columns. With ``copy_col`` a number is added, 0 for the rows themselves, and the key
    columns together with it are unique; pass both to whatever selects rows afterwards.
    """
    require_columns(df, [*key_cols, label])
    work = df.where(F.col(label).isNotNull())
    needs = parameter_table(
        class_counts(work, label)
        .withColumnRenamed("n", "size")
        .withColumn("need", F.max("size").over(Window.partitionBy(F.lit(0))) - F.col("size"))
    )
    short = needs.where(F.col("need") > 0)
    minority = work.join(short.select(label), label, "left_semi")
    originals = work.withColumn(copy_col, F.lit(0).cast("long")) if copy_col else work
    return originals.unionByName(draw_with_replacement(minority, short, [label], key_cols, seed, copy_col))


def balance_positive_zero(
    df: DataFrame, target: str, key_cols: Sequence[str], seed: int = 42, copy_col: str | None = None
) -> DataFrame:
    """Keep every positive row and as many zero rows, drawn with replacement when zeros are fewer.

    Without positive or without zero rows all rows are returned. ``copy_col`` as in ``oversample``; where zeros
    are drawn with replacement, every drawn row is a numbered copy.
    """

    def own(rows: DataFrame) -> DataFrame:
        return rows.withColumn(copy_col, F.lit(0).cast("long")) if copy_col else rows

    require_columns(df, [*key_cols, target])
    sizes = df.agg(
        F.count_if(F.col(target) > 0).alias("positive"), F.count_if(F.col(target) == 0).alias("zero")
    ).first()
    if not sizes["positive"] or not sizes["zero"]:
        return own(df)
    positive = own(df.where(F.col(target) > 0))
    zero = df.where(F.col(target) == 0)
    if sizes["zero"] >= sizes["positive"]:
        return positive.unionByName(own(sample_n(zero, sizes["positive"], key_cols, seed)))
    stratum = zero.withColumn("__all", F.lit(0))
    needs = df.sparkSession.createDataFrame(
        [(0, sizes["zero"], sizes["positive"])], "__all int, size long, need long"
    )
    drawn = draw_with_replacement(stratum, needs, ["__all"], key_cols, seed, copy_col).drop("__all")
    return positive.unionByName(drawn)
