import math
import zlib
from collections import Counter

import pytest
import xxhash
from conftest import SF001
from pyspark.sql import functions as F

from evhist.llm.queries import op12_sharding
from evhist.llm.sharding import assign, equal_shards, moves, places, shard_documents, write_shards


def draw(name, weight, key):
    h = xxhash.xxh64_intdigest(name.encode(), seed=42)
    if key is not None:
        h = xxhash.xxh64_intdigest(str(key).encode(), seed=h)
    return -math.log(((h >> 12) + 0.5) / 2**52) / weight


def brute(shards, key):
    return min(shards, key=lambda s: draw(s, shards[s], key))


@pytest.mark.parametrize("shards", [equal_shards(16), {"a": 1.0, "b": 3.0, "c": 0.5}])
def test_owner_against_brute_force(spark, shards):
    rows = assign(spark.range(3000).withColumnRenamed("id", "doc_id"), shards).collect()
    assert len(rows) == 3000
    assert all(r.shard == brute(shards, r.doc_id) for r in rows)


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op12_sharding(spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        data = docs[r.doc_id].encode()
        slot = slots[r.shard] = slots.get(r.shard, -1) + 1  # places follow the ids
        assert (r.size, r.text_crc32, r.law, r.shard, r.slot) == (len(data) + 1, zlib.crc32(data), "key", int(brute(equal_shards(16), r.doc_id)), slot)
        assert r.grown_shard == int(brute(equal_shards(17), r.doc_id))
        assert r.grown_shard in (r.shard, 16)


def test_weights_and_few_moves(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("from_x"))
    old = {"a": 1.0, "b": 2.0, "c": 1.0}
    n = Counter(r.shard for r in assign(docs, old).collect())
    assert [abs(n[s] / 40_000 - w / 4) < 0.01 for s, w in old.items()] == [True] * 3
    gone = moves(docs, old, {**old, "d": 1.0}).collect()
    assert {r.to_shard for r in gone} == {"d"} and abs(len(gone) / 40_000 - 0.2) < 0.01
    assert {r.from_shard for r in moves(docs, old, {"a": 1.0, "b": 2.0}).collect()} == {"c"}
    assert {r.to_shard for r in moves(docs, old, {"a": 1.0, "b": 2.0, "c": 2.0}).collect()} == {"c"}
    assert moves(docs, old, dict(reversed(old.items()))).isEmpty()


def test_nulls_repeats_hot_key_and_clashing_names(spark):
    rows = [(None, None)] * 3 + [(7, "x")] * 2000 + [(8, "é"), (9, "")]
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], "doc_id long, text string, shard string, slot int, _row int")
    out = shard_documents(df).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter({(None, 1): 3, (7, 2): 2000, (8, 3): 1, (9, 1): 1})
    assert len({r.shard for r in out if r.doc_id == 7}) == len({r.shard for r in out if r.doc_id is None}) == 1
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert shard_documents(df.limit(0)).count() == 0


def test_places_split_a_hot_group(spark):
    df = spark.range(20_000).select(F.lit(None).cast("string").alias("g"), (F.col("id") % 3).alias("k"))
    rows = places(df, "g", ["k"]).collect()
    assert sorted(r.slot for r in rows) == list(range(20_000))
    assert [r.k for r in sorted(rows, key=lambda r: r.slot)] == sorted(r.k for r in rows)


def test_shards_that_cannot_own_are_refused(spark):
    for bad in ({}, {"a": 0.0}, {"a": -1.0}, {"a": float("nan")}, {"a": float("inf")}):
        with pytest.raises(ValueError):
            assign(spark.range(1).withColumnRenamed("id", "doc_id"), bad)


def test_written_shards_hold_every_row(spark, scratch):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    write_shards(docs, scratch, equal_shards(4))
    back = spark.read.parquet(scratch).collect()
    assert sorted(r.doc_id for r in back) == list(range(500))
    assert all(str(r.shard) == brute(equal_shards(4), r.doc_id) for r in back)
