"""Files that are cut anywhere, and files that a sink names."""

import gzip
import os
import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repseq.operators.dedup import cluster_names
from repseq.operators.numbering import numbered
from repseq.sources import routed
from repseq.sources.fastq import FastqReader, read_fastq


def fastq_text(seed, n, blanks):
    r = random.Random(seed)
    out, want = [], []
    for i in range(n):
        size = r.choice([0, 1, 1, 2, 5, 30])
        seq, qual = "".join(r.choices("ACGTN", k=size)), "".join(r.choices("@+I!~#", k=size))
        end = r.choice(["\n", "\r\n"]) if blanks else "\n"
        out.append(f"@r{i} d{end}{seq}{end}+{r.choice(['', f'r{i}'])}{end}{qual}{end}" + "\n" * (r.choice([0, 0, 0, 2]) if blanks else 0))
        want.append((f"r{i}", seq, qual))
    return "".join(out), want


def rows_of(path, split):
    reader = FastqReader(str(path), split)
    return [r for part in reader.partitions() for b in reader.read(part) for r in zip(*(b.column(c).to_pylist() for c in ("read_id", "seq", "qual", "ord")), strict=True)]


@pytest.mark.parametrize("blanks", [False, True])
def test_fastq_does_not_depend_on_the_cut(tmp_path, blanks):
    for seed in range(25):
        text, want = fastq_text(seed, (0, 1, 3, 40)[seed % 4], blanks)
        path = tmp_path / f"{blanks}-{seed}.fastq"
        path.write_bytes(text.encode())
        whole = rows_of(path, 1 << 30)
        assert [r[:3] for r in whole] == want
        for split in (1, 7, 50, 333):
            assert rows_of(path, split) == whole


@given(st.integers(0, 10**6), st.integers(1, 400))
@settings(max_examples=60, deadline=None)
def test_fastq_any_cut(tmp_path_factory, seed, split):
    text, want = fastq_text(seed, 12, seed % 2 == 0)
    path = tmp_path_factory.mktemp("fastq") / "x.fastq"
    path.write_bytes(text.encode())
    assert [r[:3] for r in rows_of(path, split)] == want


def test_fastq_small_pieces_cost_few_tasks_and_little_reading(tmp_path, monkeypatch):
    text, want = fastq_text(5, 4000, False)
    path = tmp_path / "x.fastq"
    path.write_text(text)
    reader = FastqReader(str(path), 100)
    assert len(reader.partitions()) < 128
    taken = []

    class Counted:
        def __init__(self, path, **_):
            self.file = open(path, "rb")

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            taken.append(len(out := self.file.read(n)))
            return out

    class System:
        open_input_file = Counted

    monkeypatch.setattr("repseq.sources.fastq.store", lambda path: (System, path))
    got = [r for part in reader.partitions() for b in reader.read(part) for r in b.column("read_id").to_pylist()]
    assert len(got) == len(want) == 4000
    assert sum(taken) < 60 * len(text)  # pieces of 100 bytes, each read as a few KB, not to the end of the file


def test_fastq_frame_gz_folders_and_errors(spark, tmp_path):
    text, want = fastq_text(3, 60, False)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.fastq").write_text(text)
    with gzip.open(tmp_path / "a" / "2.fastq.gz", "wt") as f:
        f.write(text.replace("@r", "@z"))
    one = read_fastq(spark, str(tmp_path / "a"), keep_quality=True, last_wins=False)
    many = read_fastq(spark, f"file://{tmp_path}/a", keep_quality=True, last_wins=False, split_bytes=len(text) // 50)
    assert many.rdd.getNumPartitions() > 50
    key = lambda r: r.ord
    assert sorted(one.collect(), key=key) == sorted(many.collect(), key=key)
    assert one.count() == 2 * len(want)
    (tmp_path / "bad.fastq").write_text(text + "@x\nAC\n+\nI\n")
    with pytest.raises(Exception, match="is not FASTQ"):
        read_fastq(spark, str(tmp_path / "bad.fastq")).collect()
    (tmp_path / "short.fastq").write_text(text + "@x\nAC\n+")
    with pytest.raises(Exception, match="is not FASTQ"):
        read_fastq(spark, str(tmp_path / "short.fastq")).collect()
    (tmp_path / "none.fastq").write_text("")
    assert read_fastq(spark, str(tmp_path / "none.fastq")).count() == 0


def files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*") if p.is_file())


def routes(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("s"), (F.col("id") % 2).cast("string"), F.lit("/x.fasta")).alias("route"), F.lit(None).cast("string").alias("head"), F.concat(F.lit(">r"), F.col("id").cast("string"), F.lit("\nACGT")).alias("record"))


def test_sink_names_files_and_overwrites(spark, tmp_path):
    out = str(tmp_path / "out")
    routed.write_routed(routes(spark, 40), out)
    assert files(out) == ["s0/x.fasta", "s1/x.fasta"]
    routed.write_routed(routes(spark, 6).union(spark.createDataFrame([(None, None, "x"), ("a", None, None)], "route string, head string, record string")), out)
    assert files(out) == ["s0/x.fasta", "s1/x.fasta"]
    assert (tmp_path / "out/s0/x.fasta").read_text().count(">") == 3
    routed.write_routed(routes(spark, 0), out)
    assert files(out) == []


def test_sink_numbers_the_files_of_several_tasks(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.dataSource.register(routed.RoutedSink)
    routes(spark, 90).sortWithinPartitions("route").write.format("routed").mode("overwrite").save(out)
    assert files(out) == [f"s{s}/x.{k:05d}.fasta" for s in (0, 1) for k in range(3)]
    assert routed.read_routed(spark, out).groupBy("file").count().orderBy("file").collect() == [("s0/x.fasta", 45), ("s1/x.fasta", 45)]


def test_failed_task_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    routed.write_routed(routes(spark, 4), out)

    @F.udf("string")
    def dies(record):
        if record.startswith(">r77\n"):
            raise ValueError("dies")
        return record

    with pytest.raises(Exception, match="dies"):
        routed.write_routed(routes(spark, 90).withColumn("record", dies("record")), out)
    assert files(out) == ["s0/x.fasta", "s1/x.fasta"]
    assert (tmp_path / "out/s0/x.fasta").read_text() == ">r0\nACGT\n>r2\nACGT\n"


def test_killed_attempt_leaves_nothing(tmp_path):
    """An attempt that ends in the middle of a file, and another of the same part that counts."""
    import pyarrow as pa

    writer = routed.RoutedWriter(str(tmp_path / "out"), True)
    batch = pa.RecordBatch.from_pydict({"route": ["a.txt", "b/c.txt"], "head": pa.array([None, "=n"], pa.string()), "record": ["1", "2"]})

    def killed():
        yield batch
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(killed())
    os.rename(next((tmp_path / "out").glob("_writing-*")) / "0-0-0", tmp_path / "keep")
    done = writer.write(iter([batch]))
    assert all("/_writing-" in p for p in map(str, (tmp_path / "out").rglob("*")) if Path(p).is_file())
    writer.commit([done, None])
    assert files(tmp_path / "out") == ["a.txt", "b/c.txt"]
    assert (tmp_path / "out/b/c.txt").read_text() == "=n\n2\n"
    writer.abort([done])


@pytest.mark.parametrize("route", ["/a", "../a", "a//b", "_x/a", "a/../b"])
def test_routes_stay_in_the_folder(route):
    with pytest.raises(ValueError, match="not a route"):
        routed.checked(route)


def test_numbered(spark):
    rows = [("a", 3), ("a", 1), ("a", 1), (None, 5), (None, 4), ("b", None), ("b", 2)]
    got = numbered(spark.createDataFrame(rows, "k string, v int"), ["k"], ["v"], "n", "all").collect()
    assert sorted(got, key=repr) == sorted([("a", 1, 0, 3), ("a", 1, 1, 3), ("a", 3, 2, 3), (None, 4, 0, 2), (None, 5, 1, 2), ("b", None, 0, 2), ("b", 2, 1, 2)], key=repr)
    many = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    assert [r.n for r in numbered(many, [], ["v"]).orderBy("v").collect()] == list(range(5000))
    assert numbered(many.where("v < 0"), [], ["v"]).count() == 0


def test_numbered_has_no_window_over_rows(spark):
    many = spark.range(5000).selectExpr("id % 2 AS k", "id AS v")
    plan = numbered(many, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_cluster_names(spark):
    rows = spark.createDataFrame([("s", "c1", 1), ("s", "c1", 2), ("s", "c0", 3), (None, "c1", 4)], "sample string, cluster string, x int")
    assert sorted(map(tuple, cluster_names(rows).collect()), key=repr) == sorted([("s", "c1", 1, "Cluster_2_2"), ("s", "c1", 2, "Cluster_2_2"), ("s", "c0", 3, "Cluster_1_1"), (None, "c1", 4, "Cluster_1_1")], key=repr)
