"""Reads as a stream: parsing, demultiplexing and CDR3 search are row-local, so they are the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repseq.functions.dna import header_id
from repseq.operators.cdr3 import with_cdr3
from repseq.operators.demux import demultiplex


def stream_fasta(spark: SparkSession, folder: str) -> DataFrame:
    """``(read_id, seq)`` of FASTA files that arrive in a folder. Ids are not made unique: that would need all of the stream."""
    text = spark.readStream.option("lineSep", "\n>").text(folder).select(F.regexp_replace(F.regexp_replace("value", r"\r", ""), "^>", "").alias("r")).where("trim(r) <> ''")
    return text.select(header_id(F.substring_index("r", "\n", 1)).alias("read_id"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*", ""), r"\s+", "").alias("seq"))


def demultiplexed(reads: DataFrame, config: DataFrame) -> DataFrame:
    """A stream of reads with sample, status, clipped sequence and, for clipped ones, CDR3."""
    out = demultiplex(reads, config)
    return with_cdr3(out.withColumn("seq", F.when(F.col("status") == "ok", F.col("out_seq")))).drop("seq")


def write_by_sample(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Parquet in folders by sample and status; ``trigger`` as of ``DataStreamWriter.trigger``."""
    out = rows.writeStream.format("parquet").partitionBy("sample", "status").option("path", path).option("checkpointLocation", checkpoint)
    return out.trigger(**(trigger or {"availableNow": True})).start()
