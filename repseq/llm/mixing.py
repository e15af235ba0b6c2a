"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repseq.operators.shared import small_side

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 42


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, key: str) -> Column:
    """A number in [0, 1) that ``seed`` and ``key`` alone decide: 48 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"mix-{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, size)`` summed per source -> ``(source, source_size, target)``.

    The n-th source by code point (null last) weighs ``weights[n mod len]``. All sizes
    together are shared by weight; a target stops at ``max_repeats`` times its source's
    size and the excess is shared by weight among the others, until none is above.
    In closed form: with sources in order of size over weight, those before the first
    one that its share does not overfill are at their limit, the rest take
    (total - limits) x weight / (rest of the weights).

    Only this table of one row a source is ever in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("pos", at).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") % len(weights) + 1).cast("int")).cast("long"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "pos")
    limit = F.col("source_size") * max_repeats
    per = (
        per.withColumn("total", F.sum("source_size").over(every))
        .withColumn("before", F.coalesce(F.sum(limit).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("nth", F.row_number().over(filling))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
        .withColumn("fits", F.col("level") * F.col("weight") <= limit)
        .withColumn("first_fit", F.min(F.when(F.col("fits"), F.col("nth"))).over(every))
        .withColumn("share", F.max(F.when(F.col("nth") == F.col("first_fit"), F.col("level"))).over(every))
    )
    free = F.least(limit.cast("double"), F.col("share") * F.col("weight"))
    return per.select("source", "source_size", F.when(F.col("nth") < F.col("first_fit"), limit.cast("double")).otherwise(free).alias("target"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size``, ``source_size``, ``target``, ``copies``.

    ``copies`` = floor(target / source_size), plus one where the document's hash-seeded
    uniform number is below the fraction. It never exceeds ``max_repeats``.

    Defined results: null text has size 0; null source is a source of its own, last in
    order; a source of size 0 has target 0 and no copies; rows of equal doc_id share
    their draw; an empty table gives no rows. Two scans (sizes by source, combined
    before the shuffle; then the rows) and one join with the table of sources: it is computed first and
    broadcast if it was counted to be small, so that the documents are not shuffled.
    """
    hidden = docs.withColumn("__size", word_count("text"))
    targets = source_targets(hidden.select("source", F.col("__size").alias("size")), weights, max_repeats)
    targets = targets.select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    targets = small_side(targets)
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    own = [F.col(c) for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return hidden.join(targets, F.col("source").eqNullSafe(F.col("__source"))).select(
        *own, F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.floor(rate) + (uniform(seed, "doc_id") < rate - F.floor(rate)).cast("long")).cast("long").alias("copies"),
    )


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as ``mixed`` says, with its own columns."""
    out = mixed(docs.withColumn("__row", F.struct(*docs.columns)).select("doc_id", "text", "source", "__row"), **options)
    return out.select(F.explode(F.array_repeat("__row", F.col("copies").cast("int"))).alias("r")).select("r.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1 AS pos FROM d GROUP BY source
), w AS (
  SELECT *, pos % 3 + 1 AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s
), o AS (
  SELECT *, row_number() OVER f AS nth,
    CAST(coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CAST(sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM w WINDOW f AS (ORDER BY CAST(source_size AS DOUBLE) / CAST(weight AS DOUBLE), pos)
), l AS (
  SELECT *, CAST(total - before AS DOUBLE) / CAST(rest AS DOUBLE) AS level FROM o
), x AS (
  SELECT min(nth) AS first_fit, arg_min(level, nth) AS share FROM l WHERE level * weight <= 3 * source_size
), t AS (
  SELECT source, source_size, CASE WHEN nth < first_fit THEN CAST(3 * source_size AS DOUBLE)
    ELSE least(CAST(3 * source_size AS DOUBLE), share * weight) END AS target FROM l, x
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('mix-42:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
