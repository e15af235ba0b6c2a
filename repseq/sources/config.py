"""The run's configuration: a JSON array of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG = (
    "sampleName string, forwardMid string, reverseMid string, forwardPrimer string, reversePrimer string, "
    "cdr3Start array<string>, cdr3End array<string>, cdr3Threshold int, sequenceThreshold int"
)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """A sample a row, with its place in the file as ``cfg_ord``."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.posexplode(F.from_json("value", f"array<struct<{CONFIG.replace(' string', ':string').replace(' array', ':array').replace(' int', ':int')}>>")).alias("cfg_ord", "c"))
    return rows.select("c.*", "cfg_ord")
