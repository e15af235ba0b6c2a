"""Weighted rendezvous hashing into shards, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 16
BUCKETS = 1024
#: Equal rows that are dealt out at a time.
COPIES = 1 << 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard in which ``key`` scores highest.

    Shard i scores -weight / ln(u), u in (0, 1) from a hash of key and i, so a shard
    gets keys in proportion to its weight, and a further shard only takes the keys
    that score highest in it. Equal scores go to the lower shard; a null key is hashed
    as a value of its own.
    """
    key = F.coalesce(key.cast("string"), F.lit("\0"))

    def score(i: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))  # exact, so never 0 or 1
        return F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(-i).alias("shard"))

    if len(weights) == 1:
        return F.lit(0)
    return -F.greatest(*(score(i, w) for i, w in enumerate(weights))).getField("shard")


def with_slots(df: DataFrame, shard: str, order: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` plus ``slot``: gapless from 0 in each shard.

    A shard is cut into ``buckets`` by a hash of the ``order`` columns; rows are
    numbered inside a bucket and moved on by the rows of the buckets before it. No task
    holds a shard, only a bucket; the table of counts has shards x ``buckets`` rows.
    Rows equal in ``order`` are numbered among themselves in any order. A column ``slot``
    is replaced; an empty table gives no rows.
    """
    df = df.drop("slot")
    cut = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = cut.groupBy(F.col(shard).alias("__shard"), F.col("__bucket").alias("__b")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__shard", "__b", F.coalesce(before, F.lit(0)).alias("__before"))
    nth = F.row_number().over(Window.partitionBy(shard, "__bucket").orderBy(*order)) - 1
    out = cut.withColumn("__nth", nth).join(F.broadcast(counts), (F.col(shard) == F.col("__shard")) & (F.col("__bucket") == F.col("__b")))
    return out.select(*df.columns, (F.col("__before") + F.col("__nth")).cast("long").alias("slot"))


def shard_digest(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``key``: doc_id and the weights of the shards decide. ``weights`` has one more
    entry than ``shards``: the last is the shard that ``grown_shard`` adds. Repeated rows
    are counted before they are dealt out, so that even one row that makes up a third of
    the table is one row in the shuffle; then they go in chunks of at most ``COPIES`` to the buckets and get slots of their own.
    Null text has size 1 and checksum 0; null doc_id is a key of its own; an empty table
    gives no rows.
    """
    weights = list(weights or [1.0] * (shards + 1))
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32")
    )
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("all"))
    order = ["doc_id", "size", "text_crc32", "chunk"]
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`all` - 1) DIV {COPIES}"))).alias("chunk"))
    rows = rows.withColumn("n", F.least(F.lit(COPIES).cast("long"), F.col("all") - F.col("chunk") * COPIES))
    rows = rows.withColumn("shard", rendezvous(F.col("doc_id"), weights[:shards])).withColumn("grown_shard", rendezvous(F.col("doc_id"), weights))
    cut = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = cut.groupBy("shard", "bucket").agg(F.sum("n").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    here = F.sum("n").over(Window.partitionBy("shard", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = cut.withColumn("here", F.coalesce(here, F.lit(0))).join(F.broadcast(counts), ["shard", "bucket"])
    first = F.col("before") + F.col("here")
    out = out.withColumn("slot", F.explode(F.sequence(first, first + F.col("n") - 1)))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
