import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from repseq.llm import sharding as H


def gapless(rows):
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_digest(spark, sf_dir, odd):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd):
        texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
        rows = H.shard_digest(docs).collect()
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
        assert all(r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16) for r in rows)
        gapless(rows)
        by_key = {}
        for r in rows:
            assert by_key.setdefault(r.doc_id, r.shard) == r.shard


def test_one_more_shard_takes_its_share_only(spark):
    keys = spark.range(40_000)
    rows = keys.select(H.rendezvous(F.col("id"), [1.0] * 16).alias("a"), H.rendezvous(F.col("id"), [1.0] * 17).alias("b")).collect()
    assert all(r.b in (r.a, 16) for r in rows)
    assert abs(sum(r.b == 16 for r in rows) / 40_000 - 1 / 17) < 0.006
    assert all(abs(n / 40_000 - 1 / 16) < 0.006 for n in Counter(r.a for r in rows).values())


def test_weights(spark):
    rows = spark.range(40_000).select(H.rendezvous(F.col("id"), [1.0, 2.0, 5.0]).alias("s")).collect()
    got = Counter(r.s for r in rows)
    assert all(abs(got[i] / 40_000 - w / 8) < 0.01 for i, w in enumerate((1, 2, 5)))


def test_slots_of_wide_rows(odd, empty):
    docs = odd.withColumn("shard", H.rendezvous(F.col("doc_id"), [1.0] * 3))
    rows = H.with_slots(docs, "shard", ["doc_id", "text"], buckets=5).collect()
    assert len(rows) == odd.count()
    gapless(rows)
    assert H.shard_digest(empty).count() == 0


def test_a_row_that_is_a_third_of_all(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    rows = H.shard_digest(docs).collect()
    assert len(rows) == 3000
    gapless(rows)


def own_shard(key, weights):
    """Weighted rendezvous by hand: XXH64 of the key, seed 42, is the seed of the shard's own."""
    first = xxhash.xxh64_intdigest(("\0" if key is None else str(key)).encode(), 42)
    scores = [-w / math.log(((xxhash.xxh64_intdigest(struct.pack("<i", i), first) >> 12) + 0.5) / 2**52) for i, w in enumerate(weights)]
    return max(range(len(weights)), key=lambda i: (scores[i], -i))


@pytest.mark.parametrize("weights", [[1.0] * 17, [0.5, 2.0, 1.0, 4.0]])
def test_shards_are_those_of_rendezvous_by_hand(spark, weights):
    docs = spark.range(1500).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    rows = H.shard_digest(docs, len(weights) - 1, weights).collect()
    assert [(r.shard, r.grown_shard) for r in rows] == [(own_shard(r.doc_id, weights[:-1]), own_shard(r.doc_id, weights)) for r in rows]


def test_one_row_a_great_many_times(spark):
    docs = spark.range(150_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")).unionAll(spark.range(20).selectExpr("id", "cast(id as string)"))
    rows = H.shard_digest(docs).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("top")).collect()
    assert sum(r.n for r in rows) == 150_020 and all(r.n == r.slots == r.top + 1 for r in rows)


def test_slot_column_of_the_input_is_replaced(spark):
    out = H.with_slots(spark.createDataFrame([(1, 9), (1, 9), (2, 9)], "shard int, slot int"), "shard", ["shard"])
    assert out.columns == ["shard", "slot"] and sorted(map(tuple, out.collect())) == [(1, 0), (1, 1), (2, 0)]
