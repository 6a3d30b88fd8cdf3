import zlib

from pyspark.sql import functions as F

from gridloom.llm import sharding
from gridloom.llm.queries import op1_jump_sharding
from tests.llm import data


def plain_jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards_are_the_published_ones(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(5, 400)]
    for n in (1, 2, 8, 9, 100):
        got = dict(map(tuple, spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.shard_of(F.col("k"), n)).collect()))
        assert got == {k: plain_jump(k, n) for k in keys}


def test_query(spark, sf_dir):
    import duckdb

    got = op1_jump_sharding(spark, sf_dir).collect()
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall())
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.shard == plain_jump(r.doc_id, 8) and r.grown_shard in (r.shard, 8) and r.grown_shard == plain_jump(r.doc_id, 9)
    for s in range(8):
        slots = [r.slot for r in got if r.shard == s]
        assert sorted(slots) == list(range(len(slots)))
        ids = [r.doc_id for r in sorted((r for r in got if r.shard == s), key=lambda r: r.slot)]
        assert ids == sorted(ids)


def test_hot_key_nulls_repeats_and_clashes(spark):
    rows = [(7, "x")] * 500 + [(None, None)] * 300 + [(i, "y") for i in range(200)]
    df = data.clashing(data.frame(spark, rows), ["shard", "slot", "tie", "s", "part", "_row"])
    out = sharding.with_slots(sharding.assign(df, "doc_id", 8), "shard", ["doc_id"])
    got = out.collect()
    assert len(got) == 1000 and out.columns == ["doc_id", "text", "tie", "s", "part", "_row", "shard", "slot"]
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.shard for r in got if r.doc_id is None} == {plain_jump(0, 8)}
    assert all(r.tie == r.s == r.part == r._row == "clash" for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.with_slots(sharding.assign(df, "doc_id", 8, "shard", "grown"), "shard", ["doc_id"]).collect() == []
