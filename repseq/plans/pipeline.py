"""From reads to corrected sequences: one plan for all samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repseq.operators import cdr3
from repseq.operators.cluster import graph_cluster
from repseq.operators.correct import correct_cdrs, correct_parts, split_clusters
from repseq.operators.dedup import dedup_exact
from repseq.operators.demux import HAS_N, INCOMPLETE, NOMID, OK, demultiplex
from repseq.operators.scope import RunScope
from repseq.operators.shared import materialise, tasks
from repseq.plans.counts import StageCounts

STATUSES = (OK, INCOMPLETE, NOMID, HAS_N)


def _keep(scope: RunScope | None, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    return materialise(make()) if scope is None else scope.stage(name, make)


def stages(unique: DataFrame, cdr_threshold: int = 2, seq_threshold: int = 4, ratio: float | None = None, cutoff: float = 4.0, limit: int = 4, starts=cdr3.STARTS, ends=cdr3.ENDS, compat: bool = True, scope: RunScope | None = None, counts: StageCounts | None = None, label: str = "") -> tuple[DataFrame, DataFrame]:
    """``unique`` (sample, seq, qty) -> corrected sequences ``(sample, cdr, seq, qty, n_reads)``, and members ``(sample, cdr, part, seq, qty)`` of their clusters.

    CDR3s are sought, joined by edit distance on distinct CDRs, corrected inside
    components, and the reads of each true CDR are split and given a consensus. ``ratio``, by how
    much a CDR must outweigh another, is ``cdr_threshold`` unless given. Stages that several
    others read are written to the shared folder, so none is computed again; with ``scope`` to its folder, where finished ones are taken up.
    """
    watched = lambda stage, df: df if counts is None else counts.watch(f"{stage}{label}", df)

    def merged() -> DataFrame:
        dealt = unique.repartition(tasks(unique.sparkSession), "sample", "seq")  # few bytes, but the motif scans are work
        found = materialise(watched("cdr3", cdr3.with_cdr3(dealt, starts, ends).where("cdr IS NOT NULL").select("sample", "seq", "qty", "cdr")))
        components = graph_cluster(found.select("sample", F.col("cdr").alias("seq")), cdr_threshold).withColumnRenamed("seq", "cdr")
        return watched("merged", correct_cdrs(materialise(found.join(components, ["sample", "cdr"])), float(cdr_threshold if ratio is None else ratio), limit))

    true = _keep(scope, f"merged{label}", merged)
    fine = _keep(scope, f"clusters{label}", lambda: watched("clusters", split_clusters(true.select("sample", F.col("true_cdr").alias("cluster"), "seq", "qty"), seq_threshold, cutoff)))
    out = _keep(scope, f"corrected{label}", lambda: watched("corrected", correct_parts(fine, compat))) if scope or counts else correct_parts(fine, compat)
    return out.select("sample", F.col("cluster").alias("cdr"), "seq", "qty", "n_reads"), fine.select("sample", F.col("cluster").alias("cdr"), "part", "seq", "qty")


def corrected(unique: DataFrame, *args, **options) -> DataFrame:
    """The corrected sequences of ``stages``."""
    return stages(unique, *args, **options)[0]


def run_with_members(reads: DataFrame, config: DataFrame, scope: RunScope | None = None, counts: StageCounts | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """``reads`` (read_id, seq) of a run -> corrected sequences of all samples of ``config``, and the members of their clusters. Samples of equal thresholds and motifs share a plan."""

    def unique_reads() -> DataFrame:
        demuxed = demultiplex(reads.select("read_id", "seq"), config)
        demuxed = demuxed if counts is None else counts.watch("demultiplexed", demuxed, STATUSES)
        return dedup_exact(demuxed.where(F.col("status") == OK).select("sample", F.col("out_seq").alias("seq")))

    unique = _keep(scope, "unique", unique_reads)
    settings = {}
    for c in config.collect():  # one row a sample
        settings.setdefault((c.cdr3Threshold, c.sequenceThreshold, tuple(c.cdr3Start), tuple(c.cdr3End)), []).append(c.sampleName)
    both = None
    for k, ((cdr_threshold, seq_threshold, starts, ends), names) in enumerate(settings.items()):
        own = stages(unique.where(F.col("sample").isin(names)), cdr_threshold, seq_threshold, starts=starts, ends=ends, scope=scope, counts=counts, label=f"-{k}", **options)
        both = own if both is None else tuple(a.unionByName(b) for a, b in zip(both, own, strict=True))
    return both


def run(reads: DataFrame, config: DataFrame, **options) -> DataFrame:
    """The corrected sequences of ``run_with_members``."""
    return run_with_members(reads, config, **options)[0]
