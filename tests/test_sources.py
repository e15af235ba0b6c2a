import json
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from repseq import cli
from repseq.plans import pipeline, synth
from repseq.sources import fasta, fastq, routed
from repseq.sources.config import read_config
from repseq.streaming import reads as S

FASTA = "; a note\n>a first one\nAC\nGT\n\n>b\r\nAC\r\n>a again\n  TT \nT\n>c\n"


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(FASTA)
    rows = {r.read_id: r.seq for r in fasta.read_fasta(spark, str(tmp_path / "x.fasta")).collect()}
    assert rows == {"a": "TTT", "b": "AC", "c": ""}
    assert fasta.read_fasta(spark, str(tmp_path / "x.fasta"), last_wins=False).count() == 4


def test_strict_fasta(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">a\nacgt\n>b\nAC-N\n")
    assert [r.seq for r in fasta.read_fasta_strict(spark, str(tmp_path / "x.fasta")).collect()] == ["ACGT", "AC-N"]
    (tmp_path / "x.fasta").write_text("\n \n>a\nacgt\n")
    assert fasta.read_fasta_strict(spark, str(tmp_path / "x.fasta")).count() == 1
    for bad in (">a\n", ">a\nAC!\n", ">\nAC\n", "ACGT\n>a\nAC\n"):
        (tmp_path / "bad.fasta").write_text(bad)
        with pytest.raises(PySparkException):
            fasta.read_fasta_strict(spark, str(tmp_path / "bad.fasta")).collect()


def test_large_fasta_is_cut_for_many_tasks(spark, tmp_path):
    (tmp_path / "x.fasta").write_text("".join(f">r{i}\n{'ACGT' * (i % 40)}\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = fasta.read_fasta(spark, str(tmp_path / "x.fasta"))
        assert {r.read_id: len(r.seq) for r in rows.collect()} == {f"r{i}": 4 * (i % 40) for i in range(4000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_fastq(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("@a x\nACGT\n+\n@III\n@b\nA\n+b\n@\n\n@a\nTT\n+\nII\n")
    rows = {r.read_id: (r.seq, r.qual) for r in fastq.read_fastq(spark, str(tmp_path / "x.fastq"), keep_quality=True).collect()}
    assert rows == {"a": ("TT", "II"), "b": ("A", "@")}
    assert fastq.read_reads(spark, str(tmp_path), "fastq").columns == ["read_id", "seq", "ord"]
    (tmp_path / "x.fastq").write_text("@a\nACGT\n+\nII\n")
    with pytest.raises(PySparkException):
        fastq.read_fastq(spark, str(tmp_path)).collect()


def test_clusters(spark, tmp_path):
    (tmp_path / "x.cl").write_text(">lost\nAC\n=one\n>a x\nAC\nGT\n>b\nT\n=two\n>c\nG\n=one\n>d\nC\n")
    rows = sorted((r.cluster_id, r.read_id, r.seq) for r in fasta.read_clusters(spark, str(tmp_path / "x.cl")).collect())
    assert rows == [("one", "d", "C"), ("two", "c", "G")]


def test_config(spark, tmp_path):
    keys = ["sampleName", "forwardMid", "reverseMid", "forwardPrimer", "reversePrimer", "cdr3Start", "cdr3End", "cdr3Threshold", "sequenceThreshold"]
    (tmp_path / "c.json").write_text(json.dumps([dict(zip(keys, r[:-1], strict=True)) for r in synth.config_rows()], indent=1))
    assert [tuple(r) for r in read_config(spark, str(tmp_path / "c.json")).orderBy("cfg_ord").collect()] == synth.config_rows()


def test_hits_round_trip(spark):
    rows = spark.createDataFrame([("a", [(1, 9, 18), (3, 12, 17)]), ("b", [])], "n string, h array<struct<begin:int,end:int,score:int>>")
    lines = rows.select("n", "h", fasta.render_hits(F.col("n"), F.col("h")).alias("line"))
    assert [r.line for r in lines.collect()] == [">a (1,9,18) (3,12,17)", ">b "]
    assert all(r.h == r.back for r in lines.select("h", fasta.parse_hits(F.col("line")).alias("back")).collect())


def test_wrapping(spark):
    row = spark.createDataFrame([("x", "A" * 160), ("y", "A" * 81)], "n string, s string").select(fasta.render_fasta(F.col("n"), F.col("s"), 80).alias("t")).collect()
    assert [r.t for r in row] == [f">x\n{'A' * 80}\n{'A' * 80}", f">y\n{'A' * 80}\nA"]


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = synth.reads(spark, "/root/testdata/sf0.001").limit(200).collect()
    (tmp_path / "in" / "a.fasta").write_text("".join(f">{r.read_id}\n{r.seq}\n" for r in rows))
    config = synth.config(spark)
    stream = S.demultiplexed(S.stream_fasta(spark, str(tmp_path / "in")), config)
    S.write_by_sample(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = {r.read_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {str(r.read_id): r.status for r in rows}


def test_command_line(spark, tmp_path, capsys):
    rows = synth.unique(spark, "/root/testdata/sf0.001").limit(20).collect()
    (tmp_path / "x.fasta").write_text("".join(f">r{k}\n{r.seq}\n" for k, r in enumerate(rows)))
    for args in (["graph-clust", "-m", "2", "-k", "11"], ["hierarchical-clust", "-q"], ["motif-scan", "YYC", "-q"]):
        out = str(tmp_path / args[0])
        assert cli.main([*args, str(tmp_path / "x.fasta"), out], spark) == 0
        assert spark.read.text(out).count() > 0
    keys = ["sampleName", "forwardMid", "reverseMid", "forwardPrimer", "reversePrimer", "cdr3Start", "cdr3End", "cdr3Threshold", "sequenceThreshold"]
    (tmp_path / "c.json").write_text(json.dumps([dict(zip(keys, r[:-1], strict=True)) for r in synth.config_rows()]))
    reads = synth.reads(spark, "/root/testdata/sf0.001").limit(150).collect()
    (tmp_path / "r.fasta").write_text("".join(f">{r.read_id}\n{r.seq}\n" for r in reads))
    members = [n for line in (tmp_path / "graph-clust").glob("part-*") for n in re.findall(r"^=Cluster_\d+_(\d+)$", line.read_text(), re.M)]
    assert sum(map(int, members)) == 20
    assert cli.main(["pipeline", str(tmp_path / "r.fasta"), "-c", str(tmp_path / "c.json"), "-o", str(tmp_path / "o"), "-d", "-n", "r1"], spark) == 0
    found = {str(p.relative_to(tmp_path / "o")) for p in (tmp_path / "o").rglob("*") if p.is_file()}
    assert {f"s{k}/s{k}{x}" for k in range(3) for x in (".fasta", "_corrected.fasta", ".cl")} | {"filtered.fasta"} <= found
    said = capsys.readouterr().err
    assert "demultiplexed: s0 ok: " in said and "corrected-0: s1: " in said
    want = sorted((r.sample, r.seq) for r in pipeline.run(fasta.read_fasta(spark, str(tmp_path / "r.fasta")), synth.config(spark)).collect())
    got = sorted((r.file.split("/")[0], r.seq) for r in routed.read_routed(spark, str(tmp_path / "o")).where("file LIKE '%_corrected.fasta'").collect())
    assert got == want
    clusters = routed.read_cluster_files(spark, str(tmp_path / "o" / "s0"))
    assert clusters.where("cluster_id NOT RLIKE '^Cluster_[0-9]+_[0-9]+$' OR read_id NOT RLIKE '^Seq[0-9]+_[0-9]+$' OR cdr = ''").count() == 0 < clusters.count()
