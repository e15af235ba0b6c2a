"""Gapless numbers over a sorted table, without a window that holds a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repseq.operators.shared import materialise, small_side


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n", total: str | None = None) -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2, … in each group of ``keys`` by ``order`` (ascending, nulls first); with ``total``, also the rows of the group.

    Two passes: rows are dealt by ranges of (keys, order) and sorted where they lie, so
    that one group may fill many partitions; then the counts of each group in each
    partition, a table of at most (partitions + groups) rows, say where its rows there begin.
    Rows equal in keys and order are numbered among themselves in any order and stay in one
    range: add a column that tells them apart if they may be many. ``df`` is read twice (ranges are
    drawn from a sample), so it must give the same rows again: write it first where it is costly.
    Null keys are a group; an empty table gives no rows.
    """
    keys, order = list(keys), list(order)
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__id", F.monotonically_increasing_id())
    ranged = materialise(ranged.withColumn("__part", F.shiftright("__id", 33)))
    alias = {k: f"__key{i}" for i, k in enumerate(keys)}
    counts = ranged.groupBy(*(F.col(k).alias(a) for k, a in alias.items()), F.col("__part").alias("__p")).agg(F.min("__id").alias("__first"), F.count("*").alias("__rows"))
    group = Window.partitionBy(*alias.values())
    before = F.sum("__rows").over(group.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*alias.values(), "__p", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(group).alias("__total"))
    here = F.col("__part") == F.col("__p")
    for k, a in alias.items():
        here = here & F.col(k).eqNullSafe(F.col(a))
    out = ranged.join(small_side(counts), here)
    added = [(F.col("__id") + F.col("__shift")).alias(name), *([F.col("__total").alias(total)] if total else [])]
    return out.select(*(c for c in df.columns if c not in (name, total)), *added)
