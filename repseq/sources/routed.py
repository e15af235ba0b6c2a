"""A sink that names its own files: rows of ``(route, head, record)`` become text files ``route`` under a folder.

A Spark data source writer with a two-phase commit. Each task attempt writes its records to files of
its own in a hidden folder; when all tasks have ended the driver moves the files of the attempts
that count to their names and drops the rest. A task that dies, or a second attempt of one, leaves nothing behind.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from repseq.operators.demux import INCOMPLETE, OK
from repseq.sources.fasta import read_clusters, read_fasta, render_fasta
from repseq.sources.store import data_files, store

FLUSH = 1 << 20


@dataclass
class Written(WriterCommitMessage):
    """Files of one attempt: route and hidden path, in order; ``part`` is the task's place."""

    part: int
    files: list[tuple[str, str]]


def checked(route: str) -> str:
    """A route is a relative path that stays in the folder."""
    parts = route.split("/")
    if not route or any(p in ("", ".", "..") or p.startswith("_") for p in parts):
        raise ValueError(f"not a route: {route!r}")
    return route


def numbered_name(route: str, k: int, of: int) -> str:
    """``a/b.fasta``, or where several tasks wrote to it ``a/b.00003.fasta``."""
    if of == 1:
        return route
    stem, dot, kind = route.rpartition(".")
    return f"{stem}.{k:05d}.{kind}" if dot and "/" not in kind else f"{route}.{k:05d}"


class RoutedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.hidden = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file open at a time: rows come sorted by route. ``head`` is written where it differs from the row before."""
        context = TaskContext.get()
        part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
        system, hidden = store(self.hidden)
        files: list[tuple[str, str]] = []
        out = route = head = None
        buffer: list[str] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if buffer:
                out.write("".join(buffer).encode())
                buffer.clear()
            held = 0

        try:
            for batch in iterator:
                for r, h, record in zip(*(batch.column(c).to_pylist() for c in ("route", "head", "record")), strict=True):
                    if r != route or out is None:
                        if out is not None:
                            flush()
                            out.close()
                        path = f"{hidden}/{part}-{attempt}-{len(files)}"
                        system.create_dir(hidden, recursive=True)
                        out, route, head = system.open_output_stream(path), r, None
                        files.append((checked(r), path))
                    if h is not None and h != head:
                        buffer.append(h + "\n")
                    head = h
                    buffer += [record, "\n"]
                    held += len(record)
                    if held > FLUSH:
                        flush()
            if out is not None:
                flush()
        finally:
            if out is not None:
                out.close()
        return Written(part, files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = store(self.path)
        by_route: dict[str, list[str]] = {}
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            for route, path in m.files:
                by_route.setdefault(route, []).append(path)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if not info.base_name.startswith("_writing-"):
                    (system.delete_file if info.is_file else system.delete_dir)(info.path)
        for route, paths in by_route.items():
            for k, path in enumerate(paths):
                name = f"{root}/{numbered_name(route, k, len(paths))}"
                system.create_dir(name.rpartition("/")[0], recursive=True)
                system.move(path, name)
        self._drop()

    def abort(self, messages: list[Written | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        system, hidden = store(self.hidden)
        if system.get_file_info(hidden).type.name == "Directory":
            system.delete_dir(hidden)


class RoutedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "routed"

    def schema(self) -> str:
        return "route string, head string, record string"

    def writer(self, schema, overwrite: bool) -> RoutedWriter:
        return RoutedWriter(self.options["path"], overwrite)


def write_routed(rows: DataFrame, path: str, order: tuple[str, ...] = (), together: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Writes ``(route, head, record)`` rows; a null route or record is left out.

    Rows of a route are spread over tasks by their size alone, so a route with most of the rows
    becomes several numbered files; with ``together`` the rows of those columns stay in one file, in ``order``.
    Of modes, ``overwrite`` clears the folder and ``append`` adds to it, in files that must be new.
    """
    rows = rows.where(F.col("route").isNotNull() & F.col("record").isNotNull())
    rows.sparkSession.dataSource.register(RoutedSink)
    dealt = rows.repartition("route", *together) if together else rows.hint("rebalance", "route")
    sorted_ = dealt.sortWithinPartitions("route", *together, *order)
    sorted_.select("route", F.col("head").cast("string").alias("head"), "record").write.format("routed").mode(mode).save(path)


# --- what a run writes --------------------------------------------------------------


def demultiplexed_routes(demuxed: DataFrame) -> DataFrame:
    """Routes of demultiplexed reads: ``<sample>/<sample>.fasta`` of the clipped, ``<sample>/<sample>_incomplete.fasta`` of those without a far adapter, ``filtered.fasta`` of the rest, as they came."""
    s = F.col("sample")
    route = F.when(F.col("status") == OK, F.concat(s, F.lit("/"), s, F.lit(".fasta"))).when(F.col("status") == INCOMPLETE, F.concat(s, F.lit("/"), s, F.lit("_incomplete.fasta"))).otherwise(F.lit("filtered.fasta"))
    return demuxed.select(route.alias("route"), F.lit(None).cast("string").alias("head"), render_fasta(F.col("read_id").cast("string"), F.col("out_seq")).alias("record"))


def write_demultiplexed(demuxed: DataFrame, path: str) -> None:
    write_routed(demultiplexed_routes(demuxed), path)


def cluster_routes(members: DataFrame, name: str = "cluster_name", uid: str = "uid", cdr: str = "cdr", seq: str = "seq") -> DataFrame:
    """Routes ``<sample>/<sample>.cl``: a line ``=name`` a cluster, then for each member ``>uid cdr`` and its full read."""
    s = F.col("sample")
    return members.select(F.concat(s, F.lit("/"), s, F.lit(".cl")).alias("route"), F.concat(F.lit("="), F.col(name)).alias("head"), render_fasta(F.concat_ws(" ", F.col(uid), F.col(cdr)), F.col(seq)).alias("record"), F.col(uid).alias("uid"))


def write_clusters(members: DataFrame, path: str, mode: str = "overwrite", **columns: str) -> None:
    """Cluster files of each sample. A cluster's records are in one file, in order of uid, streamed by one task."""
    write_routed(cluster_routes(members, **columns), path, ("uid",), ("head",), mode)


# --- and reads again ----------------------------------------------------------------


def routes(path: str) -> dict[str, list[str]]:
    """The routes of a folder and the files of each, numbered ones together."""
    found: dict[str, list[str]] = {}
    for file, _ in data_files(path):
        inside = file[len(path.rstrip("/")) + 1 :]
        found.setdefault(re.sub(r"\.\d{5}(?=\.[^./]*$|$)", "", inside), []).append(file)
    return found


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """``(file, read_id, seq)`` of all FASTA files of a folder; ``file`` is the route, without numbers."""
    name = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), r"^.*?/" + re.escape(store(path)[1].strip("/")) + "/", ""), r"\.\d{5}(?=\.[^./]*$|$)", "")
    return read_fasta(spark, path, last_wins=False, extra={"file": name}).select("file", "read_id", "seq")


def read_cluster_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, cluster_id, read_id, cdr, seq)`` of all cluster files of a folder."""
    out = None
    for route, files in routes(path).items():
        rows = read_clusters(spark, files).select(F.lit(route).alias("file"), "cluster_id", "read_id", F.regexp_replace("description", r"^\S+\s*", "").alias("cdr"), "seq")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], "file string, cluster_id string, read_id string, cdr string, seq string")
