"""Exact duplicates, and ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repseq.operators.numbering import numbered


def dedup_exact(reads: DataFrame, keys: Sequence[str] = ("sample",), seq: str = "seq") -> DataFrame:
    """Distinct sequences with their number; counted before the shuffle."""
    return reads.where(F.col(seq).isNotNull()).groupBy(*keys, seq).agg(F.count("*").alias("qty"))


def dedup_last_by_id(reads: DataFrame, key: str = "read_id", order: str = "ord") -> DataFrame:
    """The last row of each id."""
    rest = [c for c in reads.columns if c != key]
    return reads.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def assign_ids(unique: DataFrame, keys: Sequence[str] = ("sample",), seq: str = "seq") -> DataFrame:
    """``Seq{n}_{qty}`` in each sample, n from 1 by sequence. Numbers come from range partitions and their counts: no task holds a sample."""
    out = numbered(unique, keys, [seq], "__n")
    return out.select(*unique.columns, F.concat(F.lit("Seq"), (F.col("__n") + 1).cast("string"), F.lit("_"), F.col("qty").cast("string")).alias("uid"))


def cluster_names(members: DataFrame, keys: Sequence[str] = ("sample",), cluster: str = "cluster") -> DataFrame:
    """``members`` plus ``cluster_name``: ``Cluster_{i}_{size}``, i from 1 in each group of ``keys`` by the cluster's own id, size its rows."""
    sizes = members.groupBy(*keys, cluster).agg(F.count("*").alias("__size"))
    named = numbered(sizes, keys, [cluster], "__n")
    alias = {c: f"__own{i}" for i, c in enumerate([*keys, cluster])}
    named = named.select(*(F.col(c).alias(a) for c, a in alias.items()), F.concat(F.lit("Cluster_"), (F.col("__n") + 1).cast("string"), F.lit("_"), F.col("__size").cast("string")).alias("cluster_name"))
    same = None
    for c, a in alias.items():
        here = F.col(c).eqNullSafe(F.col(a))
        same = here if same is None else same & here
    return members.drop("cluster_name").join(named, same).select(*(c for c in members.columns if c != "cluster_name"), "cluster_name")


def content_id(unique: DataFrame, keys: Sequence[str] = ("sample",), seq: str = "seq") -> DataFrame:
    """An id that the content alone decides: no order, no shuffle."""
    return unique.withColumn("uid", F.md5(F.concat_ws("\x1f", *keys, seq)))
