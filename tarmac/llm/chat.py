"""Conversations as budgeted training windows with a loss mask, in built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import materialize

#: Turns of a conversation whose prefix sums one task computes; longer conversations are split over tasks.
BLOCK_TURNS = 256
# Fixed values of the template: what a control string becomes inside a text. The backslash comes first and is
# undone last, so that every backslash in an escaped text belongs to one of these.
_ESCAPES = [("\\", "\\s"), ("</turn", "\\e"), ("<turn", "\\t")]
_ROLE_ESCAPES = [*_ESCAPES, (">", "\\g"), ("\n", "\\n")]
OPEN, BETWEEN, CLOSE = "<turn ", ">\n", "</turn>\n"


def _replace(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    """The text with the template's control strings (and the backslash) replaced; ``unescape`` undoes it."""
    return _replace(text, _ESCAPES)


def unescape(text: Column) -> Column:
    return _replace(text, [(new, old) for old, new in reversed(_ESCAPES)])


def token_estimate(text: Column) -> Column:
    """Tokens of a turn: one for every four bytes, rounded up, and four for its markers."""
    return F.ceil(F.octet_length(text) / F.lit(4)).cast("long") + 4


def format_windows(
    df: DataFrame,
    budget: int = 1024,
    history_turns: int = 2,
    history_tokens: int = 256,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens=token_estimate,
) -> DataFrame:
    """Cut every conversation into windows of whole turns and format them.

    Turns are taken in order of ``turn``, then role and text; null turns come first, a null text or role is
    empty, a null conversation id is a conversation, and repeated rows are turns of their own. If the first
    turn's role is ``system``, it opens every window. Prefix sums of tokens choose the spans: with half =
    (budget - system tokens - history_tokens) / 2, turns whose prefix sums end in the same stretch of ``half``
    tokens share a window, so their sum is at most twice that; a turn longer than ``half`` has a window
    of its own, the only kind that can exceed the budget. Up to ``history_turns`` turns before a window, of
    ``history_tokens`` at most, are repeated in front of it. Every assistant text is under the loss mask in
    the window where it is new and masked where it is repeated.

    Prefix sums are taken within blocks of turns and put together from the blocks' sums, so no task needs a
    whole conversation, and each window is put together from its own turns.

    :return: ``conv_id``, ``window`` (the place of its first new turn in the conversation), ``formatted``,
        ``n_context`` (repeated turns at its start), ``n_new``, ``n_tokens`` and ``loss`` (array of ``start``, counted
        from 1, and ``length`` in code points of ``formatted``). An empty table gives no rows.
    """
    turns = df.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text")))
    opening = turns.groupBy("conv").agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("first"))
    system = opening.where("first.role = 'system'").select(
        "conv", F.col("first.text").alias("system"), F.col("first.tokens").alias("system_tokens")
    )
    placed = materialize(_placed(turns, system, budget - history_tokens))
    body = placed.where("NOT opens")
    windows = body.groupBy("conv", "cell", "large").agg(
        F.min("place").alias("window"),
        F.sum("tokens").alias("tokens"),
        F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("new"),
    )
    starts = body.groupBy("conv", "cell", "large").agg(F.min("place").alias("window")).select("conv", "window")
    before = starts.withColumn("back", F.explode(F.sequence(F.lit(1), F.lit(max(1, history_turns))))).select(
        "conv", "window", "back", (F.col("window") - F.col("back")).alias("place")
    )
    earlier = before.where(F.col("back") <= history_turns).alias("b").join(
        body.alias("t"),
        F.col("b.conv").eqNullSafe(F.col("t.conv")) & (F.col("b.place") == F.col("t.place")),
    ).select("b.conv", "b.window", "b.back", "t.place", "t.role", "t.text", "t.tokens")
    so_far = F.sum("tokens").over(Window.partitionBy("conv", "window").orderBy("back"))
    history = (
        earlier.withColumn("so_far", so_far)
        .where(F.col("so_far") <= history_tokens)
        .groupBy("conv", "window")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("old"),
            F.sum("tokens").alias("old_tokens"),
        )
    )
    joined = (
        windows.alias("w")
        .join(
            history.alias("h"),
            F.col("w.conv").eqNullSafe(F.col("h.conv")) & (F.col("w.window") == F.col("h.window")),
            "left",
        )
        .select("w.conv", "w.window", "w.tokens", "w.new", "h.old", "h.old_tokens")
    )
    # a conversation of nothing but its system turn has one window as well
    both = joined.alias("w").join(system.alias("s"), F.col("w.conv").eqNullSafe(F.col("s.conv")), "full")
    no_turns = F.expr("CAST(array() AS array<struct<place: bigint, role: string, text: string>>)")
    led = F.when(
        F.col("s.system").isNotNull(),
        F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit("system").alias("role"), F.col("s.system").alias("text"))),
    ).otherwise(no_turns)
    new, old = F.coalesce("w.new", no_turns), F.coalesce("w.old", no_turns)
    first = F.coalesce(F.col("w.window"), F.lit(1)) == F.size(led)
    shaped = both.select(
        F.coalesce("w.conv", "s.conv").alias("conv"),
        F.when(first, F.lit(0)).otherwise(F.col("w.window")).cast("long").alias("window"),
        F.concat(led, old, new).alias("turns"),
        F.when(first, F.lit(0)).otherwise(F.size(led) + F.size(old)).alias("n_context"),
        (F.coalesce("w.tokens", F.lit(0)) + F.coalesce("w.old_tokens", F.lit(0)) + F.coalesce("s.system_tokens", F.lit(0))).alias("n_tokens"),
    )
    return _formatted(shaped).withColumnRenamed("conv", conv_id)


def _placed(turns: DataFrame, system: DataFrame, room: int) -> DataFrame:
    """Each turn with its place in the conversation and the stretch of tokens that its prefix sum ends in."""
    order = ["turn", "role", "text"]
    sized = (
        turns.alias("t")
        .join(system.alias("s"), F.col("t.conv").eqNullSafe(F.col("s.conv")), "left")
        .select(
            "t.*",
            F.col("s.conv").isNotNull().alias("led"),
            F.greatest(F.lit(1), F.floor((F.lit(room) - F.coalesce("s.system_tokens", F.lit(0))) / 2)).alias("half"),
        )
        .withColumn("block", F.floor(F.col("turn") / F.lit(BLOCK_TURNS)))
        .withColumn("big", (F.col("tokens") > F.col("half")).cast("int"))
    )
    # a conversation without a system turn still has a first block; its first turn is then an ordinary one
    sums = sized.groupBy("conv", "block").agg(
        F.count("*").alias("turns"), F.sum("tokens").alias("tokens"), F.sum("big").alias("bigs")
    )
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "conv",
        "block",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("turns", "tokens", "bigs")],
    )
    inside = Window.partitionBy("conv", "block").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        sized.withColumn("place", F.row_number().over(inside) - 1)
        .withColumn("end", F.sum("tokens").over(running))
        .withColumn("bigs", F.sum("big").over(running))
    )
    end = F.col("o.tokens_before") + F.col("n.end")
    bigs = F.col("o.bigs_before") + F.col("n.bigs")
    return (
        numbered.alias("n")
        .join(
            offsets.alias("o"),
            F.col("n.conv").eqNullSafe(F.col("o.conv")) & F.col("n.block").eqNullSafe(F.col("o.block")),
        )
        .select(
            "n.conv",
            (F.col("o.turns_before") + F.col("n.place")).alias("place"),
            "n.role",
            "n.text",
            "n.tokens",
            F.floor((end - 1) / F.col("n.half")).alias("cell"),
            # odd at a large turn, even between two of them
            (bigs * 2 - F.col("n.big")).alias("large"),
            "n.led",
        )
        .withColumn("opens", F.col("led") & (F.col("place") == 0))
        .drop("led")
    )


def _formatted(shaped: DataFrame) -> DataFrame:
    head = F.transform(
        "turns", lambda t: F.concat(F.lit(OPEN), _replace(t["role"], _ROLE_ESCAPES), F.lit(BETWEEN))
    )
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    texts = shaped.withColumns({"heads": head, "bodies": bodies})
    sizes = F.zip_with("heads", "bodies", lambda h, b: F.length(h) + F.length(b) + len(CLOSE))
    starts = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.aggregate(F.slice("sizes", F.lit(1), i - 1), F.lit(1), lambda a, b: a + b),
    )
    spans = F.transform(
        F.col("turns"),
        lambda t, i: F.struct(
            (t["role"] == "assistant").alias("target"),
            (i >= F.col("n_context")).alias("new"),
            (F.get("starts", i) + F.length(F.get("heads", i))).alias("start"),
            F.length(F.get("bodies", i)).alias("length"),
        ),
    )
    loss = F.transform(
        F.filter(spans, lambda s: s["target"] & s["new"]), lambda s: F.struct(s["start"], s["length"])
    )
    lines = F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(CLOSE)))
    return (
        texts.withColumn("sizes", sizes)
        .withColumn("starts", starts)
        .select(
            "conv",
            "window",
            F.array_join(lines, "").alias("formatted"),
            "n_context",
            (F.size("turns") - F.col("n_context")).alias("n_new"),
            "n_tokens",
            loss.alias("loss"),
        )
    )


def read_windows(windows: DataFrame, conv_id: str = "conv_id", keep: Sequence[str] = ()) -> DataFrame:
    """What the formatted windows say, read from ``formatted`` and ``loss`` alone: ``conv_id``, ``window``, ``turns`` (array of
    role and text, those that are new in the window, unescaped), ``loss_text`` (the texts under the mask) and the columns ``keep``."""
    parts = F.slice(F.split("formatted", CLOSE, -1), F.col("n_context") + 1, F.col("n_new"))

    def turn(part: Column) -> Column:
        pair = F.split(part, BETWEEN, 2)
        name = F.substring(pair[0], len(OPEN) + 1, 1 << 30)
        name = _replace(name, [(new, old) for old, new in reversed(_ROLE_ESCAPES)])
        return F.struct(name.alias("role"), unescape(pair[1]).alias("text"))

    under = F.transform("loss", lambda s: unescape(F.col("formatted").substr(s["start"], s["length"])))
    return windows.select(
        conv_id,
        "window",
        F.transform(parts, turn).alias("turns"),
        F.array_join(under, "").alias("loss_text"),
        *keep,
    )
