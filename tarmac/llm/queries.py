"""One query per operator over the given tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tarmac.llm import (
    boilerplate, chat, decontaminate, exact_dedup, filter_audit, line_dedup, ngram_join, pieces, quality, sharding,
    spelling, substring, toxicity,
)
from tarmac.llm.common import table
from tarmac.session import materialize

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


PIECES = os.environ.get("TARMAC_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
SHARDS = [1.0] * 24

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


# CRC-32 by its rule: the table of 256 remainders, and the sum over the bytes that a column x lists in hexadecimal
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS tab)"""
_CRC = """xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT),
  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)"""


@query(
    "op1_rendezvous_sharding",
    f"""WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) + 8 AS size, coalesce(hex(text), '') AS x FROM documents),
c AS (SELECT r, doc_id, size, {_CRC} AS crc FROM d, crc),
u AS (SELECT r, k, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || k), 1, 13))::BIGINT AS u FROM d, range(25) t(k)),
s AS (SELECT r, arg_max(k, (u, -k)) FILTER (k < 24) AS shard, arg_max(k, (u, -k)) AS grown FROM u GROUP BY r),
o AS (SELECT doc_id, size, crc, shard, grown, ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, 'null'), size, crc, grown)), 1, 13))::BIGINT AS o
  FROM c JOIN s USING (r))
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY o, doc_id, size, crc, grown) - 1 AS slot, grown::INTEGER AS grown_shard FROM o""",
)
def _(spark, d):
    docs = table(spark, d, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"))
    sharded = sharding.assign_shards(rows, "doc_id", SHARDS)
    grown = sharding.assign_shards(sharded, "doc_id", [*SHARDS, 1.0], "grown_shard")
    return sharding.assign_slots(grown, ["doc_id", "size", "text_crc32", "grown_shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query(
    "op3_ngram_jaccard_join",
    f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sh AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM d WHERE len(w) > 0),
sz AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
co AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
li AS (SELECT a, b FROM co JOIN sz x ON x.r = a JOIN sz y ON y.r = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, li.b FROM reach JOIN li ON reach.b = li.a),
cl AS (SELECT a, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY a),
nl AS (SELECT a, count(*) AS n FROM li GROUP BY a)
SELECT d.doc_id, cl.class_id, coalesce(nl.n, 0)::BIGINT AS n_links
FROM d JOIN cl ON cl.a = d.r LEFT JOIN nl ON nl.a = d.r""",
)
def _(spark, d):
    return ngram_join.ngram_links(table(spark, d, "documents")).select("doc_id", "class_id", "n_links")


@query(
    "op6_substring_dedup",
    f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
wi AS (SELECT r, unnest(range(1, len(w) - 33)) AS p, unnest([array_to_string(w[i:i + 34], ' ')
  FOR i IN range(1, len(w) - 33)]) AS g FROM d WHERE len(w) >= 35),
re AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY hash(g), g) AS n FROM wi) WHERE n > 1),
go AS (SELECT DISTINCT r, p + o AS p FROM re, (SELECT unnest(range(35)) AS o)),
li AS (SELECT r, list(p) AS ps FROM go GROUP BY r),
ke AS (SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
  [x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT list_contains(coalesce(ps, []), x[2])] AS k
  FROM d LEFT JOIN li USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM ke""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return substring.repeated_windows_removed(docs, width=35).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op9_line_dedup")
def _(spark, d):
    return line_dedup.line_classes(table(spark, d, "documents")).select(
        "doc_id", "line_no", "first_id", "first_line_no", "n_links", "kept"
    )


@query("op7_sentencepiece")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    ids = F.col("token_ids")
    return pieces.encode(docs, PIECES).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "round_trip",
    )


@query("op2_benchmark_decontamination")
def _(spark, d):
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


_ESC = r"""replace(replace(replace({}, '\', '\s'), '</turn', '\e'), '<turn', '\t')"""
_PIECE = f"""length({_ESC.format('role')}) + 8 + length({_ESC.format('text')}) + 8"""


@query(
    "op4_chat_windows",
    rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
  ceil(strlen(text) / 4)::BIGINT + 4 AS tokens, {_PIECE} AS piece FROM c),
s AS (SELECT conv_id, tokens AS st, piece AS sp FROM o WHERE place = 0 AND role = 'system'),
h AS (SELECT o.*, st, sp, greatest(1, floor((1024 - 256 - coalesce(st, 0)) / 2))::BIGINT AS half,
  sum(tokens) OVER (PARTITION BY o.conv_id ORDER BY place) AS e FROM o LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id),
k AS (SELECT *, ((e - 1)::BIGINT // half)::VARCHAR || ':' || (2 * sum((tokens > half)::INT) OVER (PARTITION BY conv_id ORDER BY place)
  - (tokens > half)::INT)::VARCHAR AS span FROM h),
w AS (SELECT conv_id, span, min(place) AS f, sum(piece) AS p, max(sp) AS sp FROM k WHERE NOT (place = 0 AND sp IS NOT NULL) GROUP BY ALL),
b AS (SELECT w.conv_id, w.span, sum(CASE WHEN a.tokens + CASE WHEN a.place = w.f - 2 THEN coalesce(n.tokens, 0) ELSE 0 END <= 256
  THEN a.piece END) AS q FROM w JOIN k a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.place IN (w.f - 1, w.f - 2)
  AND NOT (a.place = 0 AND a.sp IS NOT NULL) LEFT JOIN k n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.place = w.f - 1 GROUP BY ALL),
z AS (SELECT w.conv_id, sum(p + coalesce(w.sp, 0) + coalesce(q, 0)) AS chars FROM w LEFT JOIN b
  ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.span = w.span GROUP BY ALL),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256, max(sp) AS sp FROM h GROUP BY conv_id)
SELECT g.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, coalesce(chars, g.sp)::BIGINT AS formatted_chars
FROM g LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM g.conv_id""",
)
def _(spark, d):
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    given = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    windows = materialize(chat.format_windows(given))
    heard = chat.read_windows(windows, keep=["formatted"])
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = heard.select(
        "conv_id",
        F.size("turns").cast("long").alias("n"),
        F.length("formatted").cast("long").alias("chars"),
        F.struct("window", F.array_join(lines, "").alias("said"), F.col("loss_text").alias("loss")).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    said, loss = F.array_join(F.col("parts.said"), ""), F.array_join(F.col("parts.loss"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op5_quality_classifier")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    rows = materialize(quality.with_statistics(docs).withColumn("held_out", quality.fold("doc_id", 5) == 0))
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(rows.where("NOT held_out").join(labels, "doc_id"))
    return quality.score(rows, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op10_toxicity")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", (quality.fold("doc_id", 3) == 1).alias("held_out"))
    labels = table(spark, d, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels.where(quality.fold("doc_id", 3) != 1))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op8_quality_rules")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    model = boilerplate.fit(docs, labels)
    return boilerplate.judge(docs, model)


@query(
    "op11_spelling_variants",
    "WITH RECURSIVE " + _CRC_TABLE + r""",
ru AS (SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents) GROUP BY ALL),
hx AS (SELECT *, hex(coalesce(doc_id::VARCHAR, '') || ':' || w) AS x FROM ru),
h AS (SELECT w, k, """ + _CRC + r""" AS h FROM hx, crc),
s AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS w, k FROM h),
v AS (SELECT w, sum(k)::BIGINT AS n FROM s WHERE length(w) >= 5 GROUP BY w HAVING sum(k) >= 3),
pl AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v),
pa AS (SELECT w, n, substr(w, 1, i - 1) || '_' || substr(w, i + 1) AS p, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM pl),
de AS (SELECT DISTINCT pa.w AS a, pa.n AS an, v.w AS b, v.n AS bn FROM pa JOIN v ON pa.d = v.w),
ne AS (SELECT x.w AS w, y.w AS b, y.n AS bn FROM pa x JOIN pa y ON x.p = y.p AND x.w <> y.w
  UNION ALL SELECT a, b, bn FROM de UNION ALL SELECT b, a, an FROM de),
be AS (SELECT w, count(*) AS n_near, min((-bn, b)) AS m FROM ne GROUP BY w),
fo AS (SELECT v.w AS w, v.n AS n, coalesce(n_near, 0) AS n_near, CASE WHEN -m[1] >= 2 * v.n THEN m[2] END AS form,
  CASE WHEN -m[1] >= 2 * v.n THEN -m[1] END AS form_n FROM v LEFT JOIN be USING (w)),
wa AS (SELECT w, w AS root, form FROM fo UNION ALL SELECT wa.w, fo.w, fo.form FROM wa JOIN fo ON fo.w = wa.form)
SELECT fo.w AS word, fo.form AS form, root, n, n_near, form_n FROM fo JOIN wa ON wa.w = fo.w AND wa.form IS NULL""",
)
def _(spark, d):
    return spelling.spelling_groups(spelling.word_counts(table(spark, d, "documents")))


@query(
    "op12_exact_dedup",
    r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST)""",
)
def _(spark, d):
    return exact_dedup.exact_copies(table(spark, d, "documents"), digest_all=True)


@query(
    "op13_filter_audit",
    r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^ 	-
]+') AS w FROM d),
m AS (SELECT doc_id, part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(doc_id IS DISTINCT FROM least AND (doc_id IS NULL OR doc_id > least), false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT [f1.f, f2.f, f3.f, f4.f, f5.f] AS fs, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bs FROM f f1, f f2, f f3, f f4, f f5
  WHERE f1.b | f2.b | f3.b | f4.b | f5.b = 31),
s AS (SELECT array_to_string(fs, '') AS filter_order, unnest([1, 2, 3, 4, 5]) AS step, unnest(bs) AS b,
  unnest([0, bs[1], bs[1] + bs[2], bs[1] + bs[2] + bs[3], bs[1] + bs[2] + bs[3] + bs[4]]) AS p FROM o),
x AS (SELECT part, filter_order, step, b, sum(n * ((mask & (b | p)) = 0)::INT)::BIGINT AS kept,
  sum(n * (mask & b <> 0 AND mask & p = 0)::INT)::BIGINT AS removed,
  sum(n * (mask & b <> 0 AND mask & p <> 0)::INT)::BIGINT AS redundant, sum(n * (mask = b)::INT)::BIGINT AS unique_fails,
  sum(good * (mask & b <> 0 AND mask & p = 0)::INT)::BIGINT AS good_lost,
  sum(toxic * (mask & b <> 0 AND mask & p = 0)::INT)::BIGINT AS toxic_lost FROM c, s GROUP BY ALL)
SELECT * EXCLUDE (b), (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM x""",
)
def _(spark, d):
    masks = filter_audit.filter_masks(table(spark, d, "documents"))
    return filter_audit.interaction_report(filter_audit.mask_counts(masks, table(spark, d, "labels")))
