import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.llm import sharding
from tarmac.llm.queries import QUERIES


def test_query(spark, folder, documents):
    rows = QUERIES["op1_rendezvous_sharding"](spark, folder).collect()
    texts = dict(documents)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights_and_few_keys_move(spark):
    keys = spark.range(20_000)
    shards = sharding.assign_shards(keys, "id", [1, 2, 0, 1]).collect()
    share = Counter(r.shard for r in shards)
    assert share[2] == 0
    assert all(abs(share[s] / 20_000 - want) < 0.02 for s, want in ((0, 0.25), (1, 0.5), (3, 0.25)))
    before = {r.id: r.shard for r in shards}
    without = {r.id: r.shard for r in sharding.assign_shards(keys, "id", [1, 2, 0, 0]).collect()}
    assert all(without[k] == s for k, s in before.items() if s != 3)
    heavier = {r.id: r.shard for r in sharding.assign_shards(keys, "id", [1, 3, 0, 1]).collect()}
    assert all(heavier[k] in (s, 1) for k, s in before.items())


def test_odd_rows(odd):
    out = sharding.assign_shards(odd, "doc_id", [1.0] * 5, "node")
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("doc_id IS NULL").select("node").distinct().count() == 1
    slots = sharding.assign_slots(out, ["doc_id", "text"], "node").collect()
    by = defaultdict(list)
    for r in slots:
        by[r.node].append(r.slot)
    assert sum(map(len, by.values())) == odd.count()
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.assign_slots(out.limit(0), ["doc_id"], "node").count() == 0


def test_one_value_in_most_rows(spark):
    df = spark.range(3000).select(F.lit(1).alias("id"), F.lit(0).alias("shard"))
    slots = sharding.assign_slots(df, ["id"]).select("slot").collect()
    assert sorted(r.slot for r in slots) == list(range(3000))


def test_bad_weights(spark):
    with pytest.raises(ValueError):
        sharding.assign_shards(spark.range(1), "id", [0.0])
    with pytest.raises(ValueError):
        sharding.assign_shards(spark.range(1), "id", [1.0, -1.0])


def test_written_shards(spark, tmp_path):
    sharding.write_shards(spark.range(50), str(tmp_path / "s"), "id", [1, 1])
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 2


def test_many_copies_are_written_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(1, "a")] * 50 + [(None, "b")] * 20 + [(i, "c") for i in range(30)]
    df = spark.createDataFrame(rows, "k long, v string")
    sharded = sharding.assign_shards(df, "k", [1.0, 2.0, 1.0])
    out = sharding.assign_slots(sharded, ["k", "v"])
    got = [(r.shard, r.slot, r.k, r.v) for r in out.collect()]
    assert sorted((k is None, k or 0, v) for _, _, k, v in got) == sorted((k is None, k or 0, v) for k, v in rows)
    for shard in {r[0] for r in got}:
        assert sorted(slot for s, slot, _, _ in got if s == shard) == list(range(sum(s == shard for s, *_ in got)))
