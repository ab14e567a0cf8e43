"""Near-duplicate lines by a segment-partition edit join, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import graph
from tarmac.llm.common import probable_members
from tarmac.session import materialize

#: Characters that are counted in each line; lines whose counts differ too much need no comparison.
BAG = "etaoinsrhldcumpgbwf."


def segment_keys(line: Column, length: Column, max_edits: int) -> Column:
    """Array of (role, seg) of a line: role 1 for its own segments, 2 for substrings that it looks up, 3 for both.

    A line of ``length`` characters is cut into ``max_edits + 1`` nearly equal segments; one of them is whole in
    every line within ``max_edits`` edits. A line looks up lines of its own length and of up to
    ``max_edits`` fewer. Segment i of a line shorter by ``gap`` can only have moved so far that the edits
    left and right of it stay within the bound, which leaves few places (12 look-ups for 2 edits).
    """
    parts, keys = max_edits + 1, []
    for gap in range(max_edits + 1):
        own = length - gap
        for i in range(parts):
            start = F.floor(own * i / parts)
            size = F.floor(own * (i + 1) / parts) - start
            after = max_edits - i
            for shift in range(max(-i, gap - after), min(i, gap + after) + 1):
                piece = F.substring(line, (start + 1 + shift).cast("int"), size.cast("int"))
                seg = F.xxhash64(own.cast("int"), F.lit(i), piece)
                keys.append(F.struct(F.lit(3 if gap == shift == 0 else 2).alias("role"), seg.alias("seg")))
    return F.array(*keys)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def banded_distance(a: Column, b: Column, max_edits: int) -> Column:
    """Edit distance of two strings if it is ``max_edits`` or less, else some greater number.

    Bit-parallel over the band of ``2 * max_edits + 1`` diagonals: one fold over the characters of ``b`` keeps the
    vertical differences of a column as two bit vectors. Both strings must have ``max_edits`` characters at
    least, and their lengths must differ by ``max_edits`` at most.
    """
    k, width = max_edits, 2 * max_edits + 1
    full = (1 << width) - 1
    long = lambda x: F.lit(x).cast("long")
    bits = lambda x: F.bitwise_not(x).bitwiseAND(long(full))

    def matches(rows: Column, char: Column, j: Column) -> Column:
        """Bit d says that this character of ``b`` equals the one of ``a`` on diagonal d."""
        out = long(0)
        for d in range(width):
            out = out + F.when(F.get(rows, j + (d - k)) == char, long(1 << d)).otherwise(long(0))
        return out

    def step(state: Column, column: Column) -> Column:
        x, j, m = column["x"], column["j"], column["m"]
        vp, vn, dist = state["vp"], state["vn"], state["dist"]
        same = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(long(full))

        def with_diagonal(d0: Column) -> Column:
            rise = vn.bitwiseOR(bits(d0.bitwiseOR(vp)))

            def with_rise(hp: Column) -> Column:
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                # the band's last row, and from the last character of ``a`` on that character's row
                edge = m - j + (k - 1)
                along = F.getbit(hp, edge).cast("int") - F.getbit(hn, edge).cast("int")
                diagonal = 1 - F.getbit(d0, F.lit(width - 1)).cast("int")
                return F.struct(
                    hn.bitwiseOR(bits(down.bitwiseOR(hp))).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"),
                    (dist + F.when(j + k < m, diagonal).otherwise(along)).alias("dist"),
                )

            return _let(rise, with_rise)

        return _let(same, with_diagonal)

    # what stands outside a lambda is computed for every element inside it, so the arrays are bound first
    def columns(pair: Column) -> Column:
        return F.transform(
            pair["b"],
            lambda char, j: F.struct(
                matches(pair["a"], char, j).alias("x"), j.alias("j"), F.size(pair["a"]).alias("m")
            ),
        )

    start = F.struct(
        long(full & ~((1 << k) - 1)).alias("vp"), long(0).alias("vn"), F.lit(k).cast("int").alias("dist")
    )
    chars = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"))
    return F.aggregate(_let(chars, columns), start, step, lambda state: state["dist"])


def lines_of(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines that hold a word: ``_id``, ``_hash`` (of the whole text), ``line_no`` from 0, ``node`` (hash of the
    line) and ``line``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(id_col).alias("_id"), F.xxhash64(whole).alias("_hash"), whole.alias("_text"))
    split = rows.select("_id", "_hash", F.posexplode(F.split("_text", "\n", -1)).alias("line_no", "line"))
    blank = F.btrim("line", F.lit(" \t\v\f\r")) == ""
    return split.where(~blank).withColumn("node", F.xxhash64("line"))


def line_classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    max_edits: int = 2,
    min_chars: int = 20,
) -> DataFrame:
    """Class of every line of every text: equal lines, and lines of ``min_chars`` or more characters that are
    tied by chains of at most ``max_edits`` character edits.

    1. All lines' segments and look-ups are counted by hash, without their text; partial sums make a line
       that fills a third of the corpus one row per task.
    2. Only hashes that two different lines share are looked up again, and only lines that have one are read
       again as text. These are compared inside the join on that hash, so pairs that differ too much are never
       written; counts of common characters, then the exact distance in a band decide. The join's inputs come
       straight from a shuffle, which lets the engine split a common segment over tasks.
    3. Links make classes; a class is known by its first line in order of id, text hash and line number.

    :return: ``id_col``, ``text_hash``, ``line_no`` (int, from 0), ``first_id``, ``first_line_no`` (where the class
        occurs first), ``n_links`` (other lines within ``max_edits``, copies included) and ``kept`` (the class's
        first line). One row per line that holds a word; blank lines and null or empty texts give none. Null ids
        come first in order. Rows equal in id and text count as one text, their lines as copies.
    """
    if min_chars <= 2 * max_edits:
        raise ValueError("min_chars must be more than twice max_edits")
    lines = lines_of(df, id_col, text)
    narrow = materialize(lines.select("_id", "_hash", "line_no", "node"))
    place = F.struct("_id", "_hash", "line_no")
    nodes = narrow.groupBy("node").agg(F.count("*").alias("copies"), F.min(place).alias("first"))
    nodes = materialize(nodes)
    links = materialize(_links(lines, max_edits, min_chars))
    classes = graph.components(links)
    weighted = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(
        nodes.select(F.col("node").alias("b"), "copies"), "b"
    )
    near = weighted.groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("near"))
    tied = classes.join(near, "node", "left").join(nodes, "node")
    firsts = tied.groupBy("component").agg(F.min("first").alias("class_first"))
    tied = materialize(tied.join(firsts, "component").select("node", "near", "class_first"))
    known = nodes.join(tied, "node", "left").select(
        "node",
        F.coalesce("class_first", "first").alias("first"),
        (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
    )
    return narrow.join(known, "node").select(
        F.col("_id").alias(id_col),
        F.col("_hash").alias("text_hash"),
        "line_no",
        F.col("first._id").alias("first_id"),
        F.col("first.line_no").alias("first_line_no"),
        "n_links",
        place.eqNullSafe(F.col("first")).alias("kept"),
    )


def _links(lines: DataFrame, max_edits: int, min_chars: int) -> DataFrame:
    """Pairs ``a``, ``b`` of different lines within the edit bound."""
    long = lines.select("node", "line", F.length("line").alias("length")).where(F.col("length") >= min_chars)
    emitted = long.select("node", F.inline(segment_keys(F.col("line"), F.col("length"), max_edits)))
    shared = (
        emitted.groupBy("seg")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"), F.bit_or("role").alias("roles"))
        .where("least != most AND roles = 3")
        .select("seg")
    )
    shared = materialize(shared)
    members = (
        probable_members(emitted, "seg", shared)
        .join(shared, "seg")
        .groupBy("seg", "node")
        .agg(F.bit_or("role").alias("role"))
    )
    members = materialize(members)
    wanted = members.select("node").distinct()
    bag = {f"bag{i}": F.length("line") - F.length(F.replace("line", F.lit(c))) for i, c in enumerate(BAG)}
    texts = (
        probable_members(long, "node", wanted)
        .join(wanted, "node", "left_semi")
        .groupBy("node")
        .agg(F.first("line").alias("line"))
        .withColumns({"length": F.length("line"), **bag})
    )
    found = materialize(members.join(texts, "node"))
    columns = ["node", "line", "length", *bag]
    index = found.where("role = 3").select("seg", *[F.col(c).alias(f"{c}_a") for c in columns])
    probe = found.select("seg", *[F.col(c).alias(f"{c}_b") for c in columns])
    ordered = (F.col("length_a") < F.col("length_b")) | (
        (F.col("length_a") == F.col("length_b")) & (F.col("node_a") < F.col("node_b"))
    )
    close = F.col("length_b") - F.col("length_a") <= max_edits
    # an edit changes the counts of two characters by one at most
    apart = sum((F.abs(F.col(f"{c}_a") - F.col(f"{c}_b")) for c in bag), F.lit(0))
    alike = apart <= 2 * max_edits
    near = banded_distance(F.col("line_a"), F.col("line_b"), max_edits) <= max_edits
    return (
        index.join(probe, (index["seg"] == probe["seg"]) & ordered & close & alike & near)
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", drop_emptied: bool = True, **options
) -> DataFrame:
    """The rows of ``df`` without the lines that repeat an earlier line (see ``line_classes``).

    Kept lines and blank lines stay in order. A text that loses all its lines goes with its row, unless
    ``drop_emptied`` is false, when it becomes empty; texts that held no words from the start stay as they are.
    """
    classes = line_classes(df, id_col, text, **options)
    lost = (
        classes.groupBy(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(
            F.collect_set(F.when(~F.col("kept"), F.col("line_no"))).alias("_lost"),
            F.bool_or("kept").alias("_some"),
        )
        .where(F.size("_lost") > 0)
    )
    lost = materialize(lost)
    rows = df.select(F.struct(*df.columns).alias("row"))
    body = F.col("row").getField(text)
    same = F.col("row").getField(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(body, F.lit(""))) == F.col("_hash"))
    joined = rows.join(lost, same, "left")
    parts = F.split(body, "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_lost"))
    rest = F.concat_ws("\n", F.transform(places, lambda i: F.get(parts, i)))
    if drop_emptied:
        joined = joined.where(F.coalesce(F.col("_some"), F.lit(True)))
    else:
        rest = F.when(F.col("_some"), rest).otherwise(F.lit(""))
    kept = F.when(F.col("_lost").isNull(), body).otherwise(rest)
    return joined.select(*[kept.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])
