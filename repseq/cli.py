"""Command line: ``python -m repseq.cli pipeline|graph-clust|hierarchical-clust|motif-scan ...``."""

from __future__ import annotations

import argparse
import math
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from repseq.functions import motif as M
from repseq.operators.cluster import graph_cluster
from repseq.operators.correct import split_clusters
from repseq.operators.dedup import assign_ids, cluster_names
from repseq.operators.demux import demultiplex
from repseq.operators.numbering import numbered
from repseq.operators.scope import RunScope
from repseq.plans import pipeline
from repseq.plans.counts import StageCounts
from repseq.sources.config import read_config
from repseq.sources.fasta import read_fasta_strict, render_clusters, render_fasta, render_hits, write_text
from repseq.sources.fastq import read_reads
from repseq.sources.routed import cluster_routes, demultiplexed_routes, write_routed


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="repseq", description=__doc__)
    sub = p.add_subparsers(dest="what", required=True)
    a = sub.add_parser("pipeline", help="reads of a run to corrected sequences")
    a.add_argument("reads")
    a.add_argument("-c", "--config", required=True)
    a.add_argument("-o", "--out", required=True)
    a.add_argument("-q", "--fastq", action="store_true")
    a.add_argument("-n", "--name", help="name of the run: if it is broken off, a run of the same name goes on where it was")
    a.add_argument("-d", "--demultiplexed", action="store_true", help="also write the reads of each sample, those without a far adapter, and the rest")
    b = sub.add_parser("graph-clust", help="components by edit distance")
    b.add_argument("-m", "--mismatches", type=int, default=2)
    b.add_argument("-k", "--kmer", type=int, default=21, help="accepted, and without effect: clusters do not depend on it, and neither does the join used here")
    h = sub.add_parser("hierarchical-clust", help="average-linkage clusters")
    h.add_argument("-c", "--cutoff", type=float, default=4.0)
    x = sub.add_parser("motif-scan", help="a protein motif in DNA")
    x.add_argument("motif")
    x.add_argument("-m", "--match", type=int, default=M.MATCH)
    x.add_argument("-x", "--mismatch", type=int, default=M.MISMATCH)
    x.add_argument("-i", "--insert", type=int, default=M.INDEL)
    x.add_argument("-d", "--delete", type=int, default=M.INDEL)
    x.add_argument("-t", "--threshold", type=int)
    for s in (b, h, x):
        s.add_argument("-q", "--quiet", action="store_true", help="say nothing but errors")
        s.add_argument("reads")
        s.add_argument("out")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("repseq").getOrCreate()
    if args.what == "pipeline":
        return run_pipeline(spark, args)
    reads = read_fasta_strict(spark, args.reads).withColumn("sample", F.lit("all"))
    if args.what == "motif-scan":
        usual = (args.match, args.mismatch, args.insert, args.delete) == (M.MATCH, M.MISMATCH, M.INDEL, M.INDEL) and args.threshold in (None, M.default_threshold(args.motif))
        hits = M.scan(F.col("seq"), args.motif) if usual else M.scan_general(F.col("seq"), args.motif, args.threshold, args.match, args.mismatch, args.insert, args.delete)
        found = reads.select("read_id", hits.alias("hits")).where("size(hits) > 0")
        write_text(found.withColumn("text", render_hits(F.col("read_id"), F.col("hits"))), "text", args.out)
        return 0
    if args.what == "graph-clust":
        clusters = graph_cluster(reads, args.mismatches).select("seq", F.col("cluster").alias("cluster_id"))
    else:
        one = reads.select("sample", F.lit("all").alias("cluster"), "seq", F.lit(1).alias("qty"))
        clusters = split_clusters(one, math.floor(args.cutoff), args.cutoff).select("seq", F.col("part").alias("cluster_id"))
    named = cluster_names(reads.join(clusters, "seq"), cluster="cluster_id")
    write_text(render_clusters(named, cluster="cluster_name", name="read_id"), "block", args.out)
    if not args.quiet:
        print(f"{named.select('cluster_name').distinct().count()} clusters", file=sys.stderr)
    return 0


def run_pipeline(spark: SparkSession, args: argparse.Namespace) -> int:
    """Writes ``<sample>/<sample>_corrected.fasta`` and ``<sample>/<sample>.cl``; says how many rows each stage had."""
    config = read_config(spark, args.config)
    reads = read_reads(spark, args.reads, "fastq" if args.fastq else "fasta")
    counts = StageCounts([r.sampleName for r in config.orderBy("cfg_ord").collect()])
    with RunScope(spark, args.name) as scope:
        out, members = pipeline.run_with_members(reads, config, scope=scope, counts=counts)
        s = F.col("sample")
        name = F.concat_ws("_", F.lit("Seq"), (F.col("n") + 1).cast("string"), F.col("qty").cast("string"))
        fasta = numbered(out, ["sample"], ["seq", "cdr"], "n").select(F.concat(s, F.lit("/"), s, F.lit("_corrected.fasta")).alias("route"), F.lit(None).cast("string").alias("head"), render_fasta(name, F.col("seq")).alias("record"))
        named = cluster_names(members.withColumn("cluster", F.concat_ws("|", "cdr", "part")))
        clusters = cluster_routes(assign_ids(named)).drop("uid")
        write_routed(fasta, args.out)
        write_routed(clusters, args.out, ("record",), ("head",), mode="append")
        if args.demultiplexed:
            write_routed(demultiplexed_routes(demultiplex(reads.select("read_id", "seq"), config)), args.out, mode="append")
        for line in counts.lines():
            print(line, file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
