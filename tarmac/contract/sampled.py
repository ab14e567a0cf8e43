"""Random selection, balancing, nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.contract.tables import LABELLED, labelled_flights, rounded_table, sr, table
from tarmac.operators import balance, knn, sampling

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _rank(by: str = "", key: str = "event_id", seed: str = "42") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5({key} || '|{seed}'), {key})"


@query("class_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    return sampling.class_counts(table(spark, d, "events"), "event_type")


@query(
    "hash_rank",
    f"SELECT event_id, event_type, {_rank('event_type')} AS hash_rank FROM events",
)
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    return sampling.hash_rank(ev, ["event_id"], by=["event_type"])


@query(
    "sample_n",
    f"SELECT event_id, value FROM (SELECT event_id, value, {_rank()} AS rn FROM events) WHERE rn <= 500",
)
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return sampling.sample_n(ev, 500, ["event_id"])


@query(
    "train_test_split",
    f"""SELECT event_id, value, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM (SELECT event_id, value, {_rank()} AS rn, count(*) OVER () AS n FROM events)""",
)
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return sampling.train_test_split(ev, ["event_id"])


_SHARES = """sizes AS (SELECT event_type, count(*) AS c FROM events GROUP BY event_type),
tot AS (SELECT sum(c)::BIGINT AS n, ceil(sum(c) * 0.2::DOUBLE)::BIGINT AS n_test FROM sizes),
part AS (SELECT event_type, c * n_test // n AS whole,
    row_number() OVER (ORDER BY c * n_test % n DESC, event_type) AS place FROM sizes, tot),
quota AS (SELECT event_type, whole + CASE WHEN place <= (SELECT n_test FROM tot) - (SELECT sum(whole) FROM part)
    THEN 1 ELSE 0 END AS q FROM part)"""


@query(
    "stratified_split",
    f"""WITH {_SHARES}
SELECT event_id, event_type, CASE WHEN rn <= q THEN 'test' ELSE 'train' END AS split
FROM (SELECT event_id, event_type, {_rank('event_type')} AS rn FROM events) JOIN quota USING (event_type)""",
)
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    return sampling.train_test_split(ev, ["event_id"], stratify="event_type")


@query(
    "stratified_kfold",
    f"""SELECT event_id, event_type, floor((rn - 1) * 5 / n)::INTEGER AS fold
FROM (SELECT event_id, event_type, {_rank('event_type')} AS rn,
             count(*) OVER (PARTITION BY event_type) AS n FROM events)""",
)
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    return sampling.stratified_kfold(ev, "event_type", ["event_id"], 5)


@query(
    "shuffle_split",
    """SELECT split, event_id, CASE WHEN rn <= ceil(n * 0.368::DOUBLE) THEN 'test' ELSE 'train' END AS part
FROM (SELECT split, event_id, count(*) OVER (PARTITION BY split) AS n,
             row_number() OVER (PARTITION BY split ORDER BY md5(event_id || '|' || (split + 42)), event_id) AS rn
      FROM events, (SELECT i::INTEGER AS split FROM range(20) t(i)))""",
)
def _(spark, d):
    return sampling.shuffle_split(table(spark, d, "events"), ["event_id"], 20)


@query(
    "undersample",
    f"""WITH rk AS (SELECT o_orderkey, o_orderstatus, o_totalprice, {_rank('o_orderstatus', 'o_orderkey')} AS rn FROM orders)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM rk
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus))""",
)
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sampling.undersample(o, "o_orderstatus", ["o_orderkey"])


def _draws(n_min: str, need: str, label: str) -> str:
    """Slots with the rank they pick; the digest covers label, slot and seed."""
    return (
        f"SELECT slot, floor(('0x' || substr(md5({label} || '|' || slot || '|42'), 1, 13))::BIGINT "
        f"/ 4503599627370496.0::DOUBLE * {n_min})::BIGINT + 1 AS pick "
        f"FROM (SELECT i AS slot FROM range(0, ({need})::BIGINT) t(i))"
    )


_SKEWED = """sk AS (SELECT event_id, value, event_type = 'error' AS rare_src,
  CASE WHEN event_type = 'error' THEN 'rare' ELSE 'common' END AS kind FROM events)"""


@query(
    "oversample",
    f"""WITH {_SKEWED}, n AS (SELECT count(*) FILTER (kind = 'rare') AS a, count(*) FILTER (kind = 'common') AS b FROM sk),
rk AS (SELECT event_id, kind, value, {_rank()} AS rn FROM sk WHERE kind = 'rare'),
dr AS ({_draws('(SELECT a FROM n)', 'SELECT b - a FROM n', "'rare'")})
SELECT event_id, kind, value FROM sk UNION ALL
SELECT event_id, kind, value FROM dr JOIN rk ON dr.pick = rk.rn""",
)
def _(spark, d):
    return sampling.oversample(_rare(spark, d), "kind", ["event_id"])


def _rare(spark, d):
    kind = F.when(F.col("event_type") == "error", F.lit("rare")).otherwise(F.lit("common"))
    return table(spark, d, "events").select("event_id", kind.alias("kind"), "value")


@query(
    "kfold_after_oversample",
    f"""WITH {_SKEWED}, n AS (SELECT count(*) FILTER (kind = 'rare') AS a, count(*) FILTER (kind = 'common') AS b FROM sk),
rk AS (SELECT event_id, kind, {_rank()} AS rn FROM sk WHERE kind = 'rare'),
dr AS ({_draws('(SELECT a FROM n)', 'SELECT b - a FROM n', "'rare'")}),
al AS (SELECT event_id, kind, 0::BIGINT AS copy FROM sk UNION ALL
  SELECT event_id, kind, slot // 100000 * 100000 + row_number() OVER (PARTITION BY pick, slot // 100000 ORDER BY slot) AS copy
  FROM dr JOIN rk ON dr.pick = rk.rn),
fo AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5(event_id || '|' || copy || '|42'), event_id, copy) AS rn,
  count(*) OVER (PARTITION BY kind) AS n FROM al)
SELECT event_id, copy, kind, floor((rn - 1) * 5 / n)::INTEGER AS fold FROM fo""",
)
def _(spark, d):
    full = sampling.oversample(_rare(spark, d).drop("value"), "kind", ["event_id"], copy_col="copy")
    return sampling.stratified_kfold(full, "kind", ["event_id", "copy"], 5)


@query(
    "split_after_smote",
    f"""WITH {_SKEWED}, n AS (SELECT count(*) FILTER (kind = 'rare') AS a, count(*) FILTER (kind = 'common') AS b FROM sk),
rk AS (SELECT event_id, kind, {_rank()} AS rn FROM sk WHERE kind = 'rare'),
dr AS ({_draws('(SELECT a FROM n)', 'SELECT b - a FROM n', "'rare'")}),
al AS (SELECT event_id, kind, 0::BIGINT AS copy FROM sk UNION ALL
  SELECT event_id, kind, slot + 1 AS copy FROM dr JOIN rk ON dr.pick = rk.rn)
SELECT event_id, copy, kind, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (ORDER BY md5(event_id || '|' || copy || '|42'), event_id, copy) AS rn, count(*) OVER () AS n
  FROM al)""",
)
def _(spark, d):
    src = _rare(spark, d).withColumn("wave", (F.col("event_id") * 7 % 101).cast("double"))
    full = balance.smote(src, "kind", "event_id", copy_col="copy").select("event_id", "copy", "kind")
    return sampling.train_test_split(full, ["event_id", "copy"])


@query(
    "balance_positive_zero",
    f"""WITH {LABELLED}, rk AS (SELECT FLIGHT_ID, ARR_DELAY, {_rank('ARR_DELAY > 0', 'FLIGHT_ID')} AS rn FROM labelled),
n AS (SELECT count(*) FILTER (ARR_DELAY > 0) AS p, count(*) FILTER (ARR_DELAY = 0) AS z FROM labelled),
dr AS ({_draws('(SELECT z FROM n)', 'SELECT p FROM n', "'0'")})
SELECT FLIGHT_ID, ARR_DELAY FROM rk WHERE ARR_DELAY > 0 UNION ALL
SELECT FLIGHT_ID, ARR_DELAY FROM dr JOIN rk ON dr.pick = rk.rn WHERE ARR_DELAY = 0 AND (SELECT z < p FROM n) UNION ALL
SELECT FLIGHT_ID, ARR_DELAY FROM rk WHERE ARR_DELAY = 0 AND rn <= (SELECT p FROM n) AND (SELECT z >= p FROM n)""",
)
def _(spark, d):
    df = labelled_flights(spark, d).select("FLIGHT_ID", "ARR_DELAY")
    return sampling.balance_positive_zero(df, "ARR_DELAY", ["FLIGHT_ID"])


_U = "('0x' || substr(md5('rare' || '|' || slot || '|{tag}|42'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"


_SMOTE = f"""WITH {_SKEWED},
src AS (SELECT event_id, kind, value, (event_id * 7 % 101)::DOUBLE AS wave FROM sk),
rare AS (SELECT *, {_rank()} AS rn FROM src WHERE kind = 'rare'),
n AS (SELECT count(*) FILTER (kind = 'rare') AS a, count(*) FILTER (kind = 'common') AS b FROM src),
nn AS (SELECT base, other, row_number() OVER (PARTITION BY base ORDER BY dist, other) AS k FROM (
  SELECT x.event_id AS base, y.event_id AS other,
         sqrt((x.value - y.value) * (x.value - y.value) + (x.wave - y.wave) * (x.wave - y.wave)) AS dist
  FROM rare x JOIN rare y ON x.event_id <> y.event_id)),
dr AS (SELECT *, floor({_U.format(tag='neighbor')} * 5)::BIGINT + 1 AS nk, {_U.format(tag='step')} AS u FROM
  ({_draws('(SELECT a FROM n)', 'SELECT b - a FROM n', "'rare'")}))
SELECT event_id, kind, {sr('value')} AS value, {sr('wave')} AS wave, FALSE AS is_synthetic FROM src UNION ALL
SELECT x.event_id, x.kind, {sr('x.value + u * (y.value - x.value)')} AS value,
       {sr('x.wave + u * (y.wave - x.wave)')} AS wave, TRUE AS is_synthetic
FROM dr JOIN rare x ON dr.pick = x.rn JOIN nn ON nn.base = x.event_id AND nn.k = dr.nk
     JOIN rare y ON y.event_id = nn.other"""


@query("smote", _SMOTE)
def _(spark, d):
    src = _rare(spark, d).withColumn("wave", (F.col("event_id") * 7 % 101).cast("double"))
    return rounded_table(balance.smote(src, "kind", "event_id"))


@query("smote_tiled", _SMOTE)
def _(spark, d):
    # the pivot tree in place of a broadcast minority
    src = _rare(spark, d).withColumn("wave", (F.col("event_id") * 7 % 101).cast("double"))
    return rounded_table(balance.smote(src, "kind", "event_id", broadcast_cells=3000, tile_rows=256))


# --- neighbours -------------------------------------------------------------------------------

_EMB = "emb AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings)"


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )


@query(
    "knn_join",
    f"""WITH {_EMB}, p AS (SELECT a.vec_id, b.vec_id AS neighbor, list_distance(a.v, b.v) AS dist
  FROM emb a JOIN emb b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbor, rank::INTEGER AS rank, {sr('dist')} AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbor) AS rank FROM p) WHERE rank <= 5""",
)
def _(spark, d):
    v = _vectors(spark, d)
    return rounded_table(knn.knn_join(v, v, 5, "vec_id", "vec_id", exclude_self=True))


_CUSTOMERS = ["c_acctbal", "c_nationkey"]


@query(
    "knn_graph",
    f"""WITH z AS (SELECT c_custkey,
  (c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer) AS a,
  (c_nationkey - (SELECT avg(c_nationkey) FROM customer)) / (SELECT stddev_pop(c_nationkey) FROM customer) AS b
  FROM customer),
p AS (SELECT x.c_custkey AS src, y.c_custkey AS dst, sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) AS dist
  FROM z x JOIN z y ON x.c_custkey <> y.c_custkey)
SELECT src, dst, rank::INTEGER AS rank, {sr('dist')} AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM p) WHERE rank <= 15""",
)
def _(spark, d):
    return rounded_table(knn.knn_graph(table(spark, d, "customer"), _CUSTOMERS, "c_custkey"))


@query(
    "knn_join_tiled",
    f"""WITH c AS (SELECT c_custkey AS k, c_acctbal::DOUBLE / 1000 AS x, c_nationkey::DOUBLE / 4 AS y,
  (c_custkey * 7919 % 1009)::DOUBLE / 200 AS z FROM customer),
p AS (SELECT a.k, b.k AS neighbor, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS dist
  FROM c a JOIN c b ON a.k <> b.k)
SELECT k AS c_custkey, neighbor, rank::INTEGER AS rank, {sr('dist')} AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, neighbor) AS rank FROM p) WHERE rank <= 5""",
)
def _(spark, d):
    x, y = F.col("c_acctbal").cast("double") / 1000, F.col("c_nationkey").cast("double") / 4
    z = (F.col("c_custkey") * 7919 % 1009).cast("double") / 200
    v = table(spark, d, "customer").select("c_custkey", F.array(x, y, z).alias("features"))
    tree = {"broadcast_cells": 4000, "tile_rows": 256}
    return rounded_table(knn.knn_join(v, v, 5, "c_custkey", "c_custkey", exclude_self=True, **tree))


_EMB_SPLIT = f"""{_EMB},
sp AS (SELECT *, rn <= ceil(n * 0.2::DOUBLE) AS is_test FROM
  (SELECT *, {_rank(key='vec_id')} AS rn, count(*) OVER () AS n FROM emb)),
p AS (SELECT a.vec_id, a.label, b.label AS vote,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k
      FROM sp a JOIN sp b ON a.is_test AND NOT b.is_test),
pred AS (SELECT vec_id, label, vote AS prediction FROM (
  SELECT vec_id, label, vote, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, vote) AS place
  FROM p WHERE k <= 5 GROUP BY vec_id, label, vote) WHERE place = 1)"""


def _knn_predictions(spark, d):
    parts = sampling.train_test_split(_vectors(spark, d), ["vec_id"])
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    fitted = knn.knn_classify(train, test, "vec_id", "label", 5)
    return test.select("vec_id", "label").join(fitted, "vec_id")


@query("knn_classify", f"WITH {_EMB_SPLIT} SELECT vec_id, label, prediction FROM pred")
def _(spark, d):
    return _knn_predictions(spark, d)


@query(
    "classification_metrics",
    f"""WITH {_EMB_SPLIT},
cls AS (SELECT c, sum(support) AS support, sum(called) AS called, sum(hit) AS hit FROM (
  SELECT label AS c, 1 AS support, 0 AS called, CASE WHEN label = prediction THEN 1 ELSE 0 END AS hit FROM pred UNION ALL
  SELECT prediction, 0, 1, 0 FROM pred) GROUP BY c)
SELECT sum(support)::BIGINT AS n, {sr('sum(hit) / sum(support)')} AS accuracy,
  {sr('sum(support * 2.0::DOUBLE * hit / (support + called)) / sum(support)')} AS f1_weighted FROM cls""",
)
def _(spark, d):
    from tarmac.operators.models import classification_metrics

    return rounded_table(classification_metrics(_knn_predictions(spark, d)))


@query(
    "majority_baseline",
    """WITH best AS (SELECT event_type FROM events WHERE event_id % 5 <> 0 GROUP BY event_type
  ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, event_type, (SELECT event_type FROM best) AS prediction FROM events""",
)
def _(spark, d):
    from tarmac.operators.models import majority_baseline

    ev = table(spark, d, "events").select("event_id", "event_type")
    return majority_baseline(ev.where(F.col("event_id") % 5 != 0), ev, "event_type")
