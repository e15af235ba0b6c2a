"""Where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.operators.scope import current_scope

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018
except (OSError, AttributeError):  # another C library has no such call
    _LIBC = None

#: A table of so many rows of a few numbers each is broadcast, a larger one is joined by a shuffle.
FEW = 100_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    ``spark.checkpoint.dir`` names it on a cluster. Only where it is unset and all runs
    in one process (local tests) a temporary folder is made and set; a cluster without
    one is an error, as executors would not see each other's files.
    """
    jsc = spark.sparkContext._jsc.sc()
    known = jsc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not known.isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not known.isDefined():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="repseq-ckpt-"))
        known = jsc.getCheckpointDir()
    return known.get()


def tasks(spark: SparkSession) -> int:
    """How many tasks to deal rows to whose work is large for their bytes: adaptive execution would put few bytes into one task.

    One more than the partitions of a shuffle, as Spark leaves out a dealing that is the same as the shuffle of a join before it.
    """
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))) + 1


def small_batches(spark: SparkSession, most: int = 2 << 20) -> SparkSession:
    """From now on batches between the JVM and Python have ``most`` bytes, so that workers hold little of long texts. A value that was set, at the start or in the session, stays."""
    if not spark._jsparkSession.sessionState().conf().contains(BATCH_BYTES):
        spark.conf.set(BATCH_BYTES, most)
    return spark


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, with its lineage cut: in the folder of the run's scope where there is one, else as a checkpoint."""
    scope = current_scope()
    if scope is not None:
        return scope.keep(df)
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Returns memory that this process no longer uses to the system."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def free_shuffles(spark: SparkSession) -> None:
    """Has the driver collect its garbage, so that Spark removes shuffle files and tables that nothing refers to any more."""
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, kept: list[DataFrame]) -> DataFrame:
    """``df``, computed when first read and then kept on the executors' disks; what an executor takes with it is computed anew.

    For large tables that are read more than once and soon done with. ``kept`` gets
    it, for ``released``.
    """
    df = df.persist(StorageLevel.DISK_ONLY)
    kept.append(df)
    return df


def released(kept: list[DataFrame]) -> None:
    """Removes what ``stored`` kept, and the shuffle files behind it."""
    spark = kept[-1].sparkSession if kept else None
    while kept:
        kept.pop().unpersist()
    if spark is not None:
        free_shuffles(spark)


def compact(df: DataFrame, most: int = 1 << 20, then: Callable[[DataFrame, int], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """``df`` and its number of rows: computed in parallel, then kept in the shared folder in files of about ``most`` rows, with its lineage cut. For narrow tables.

    ``then`` makes of the files to be, and of the number of rows, what is kept in their place.
    """
    held = df.persist(StorageLevel.DISK_ONLY)
    n = held.count()
    few = held.coalesce(1 + n // most)
    out = materialise(then(few, n) if then else few)
    held.unpersist()
    del df, held, few
    free_shuffles(out.sparkSession)
    return out, n


def small_side(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df`` computed once, and to be broadcast in a join if it was counted to have at most ``most`` rows. For narrow tables."""
    df, n = compact(df)
    return F.broadcast(df) if n <= most else df
