"""A training corpus from ``documents``: stages that each call one operator of repseq.llm."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.llm import decontamination, language_id, mixing, sharding, simhash
from repseq.operators.shared import checkpoint_dir, small_batches


def recognise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those that identification rejects go."""
    small_batches(spark)
    return language_id.recognised(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more) stays: that of the smallest doc_id."""
    small_batches(spark)
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark windows are cut from texts; clean texts stay as they are."""
    small_batches(spark)
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, up to three times."""
    return mixing.emit(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ``shard`` and their ``slot`` in it, gapless from 0."""
    weights = [1.0] * sharding.SHARDS
    placed = docs.drop("shard", "slot").withColumn("shard", sharding.rendezvous(F.col("doc_id"), weights).cast("int"))
    return sharding.with_slots(placed, "shard", ["doc_id", "text"])


STAGES = [
    ("language_id", recognise),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Character models and fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each writes Parquet that the next reads, in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
