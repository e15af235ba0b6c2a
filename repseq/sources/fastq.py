"""FASTQ as a Spark data source: ``spark.read.format("fastq").load(path)``, files cut for many tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from repseq.operators.dedup import dedup_last_by_id
from repseq.sources.store import data_files, store

SPLIT_BYTES = 64 << 20
#: Of more than so many pieces, one task reads some neighbouring small ones, up to so many bytes, piece by piece.
TASKS, TASK_BYTES = 64, 8 << 20
#: Most bytes read at a time; pieces smaller than that are read as such.
CHUNK = 4 << 20
#: Rows of a batch, about: small pieces are put together to that.
BATCH_ROWS = 4096
#: Records in a row that must look like records for the first to be taken as one.
AGREE = 4

_SCHEMA = pa.schema([("read_id", pa.string()), ("seq", pa.string()), ("ord", pa.int64()), ("qual", pa.string())])


@dataclass
class Split(InputPartition):
    """Bytes ``lo`` to ``hi`` of the ``number``-th file, in pieces of ``step`` bytes if given: the records that begin in them."""

    number: int
    path: str
    lo: int
    hi: int | None
    step: int | None = None

    def pieces(self) -> Iterator[Split]:
        if self.hi is None or not self.step:
            yield self
            return
        for lo in range(self.lo, self.hi, self.step):
            yield Split(self.number, self.path, lo, min(self.hi, lo + self.step))


class Lines:
    """Lines of a stream from a place on, with where each begins; a carriage return at the end goes."""

    def __init__(self, stream, at: int, chunk: int = CHUNK):
        self.stream, self.at, self.chunk = stream, at, chunk
        self.lines: list[bytes] = []
        self.begins: list[int] = []
        self.rest, self.ended = b"", False

    def fill(self, n: int) -> bool:
        """Whether ``n`` lines are there, after reading on if need be."""
        while len(self.lines) < n and not self.ended:
            chunk = self.stream.read(self.chunk)
            self.ended = not chunk
            if b"\n" not in chunk:  # a line longer than that: more at a time, so that it is not put together bit by bit
                self.chunk = min(CHUNK, 2 * self.chunk)
            parts = (self.rest + chunk).split(b"\n")
            self.rest = b"" if self.ended else parts.pop()
            if self.ended and parts == [b""]:
                parts = []
            for p in parts:
                self.lines.append(p.rstrip(b"\r"))
                self.begins.append(self.at)
                self.at += len(p) + 1
        return len(self.lines) >= n

    def skip(self, n: int) -> None:
        del self.lines[:n], self.begins[:n]


def is_record(lines: list[bytes]) -> bool:
    return lines[0].startswith(b"@") and lines[2].startswith(b"+") and len(lines[1]) == len(lines[3])


def record_start(lines: Lines) -> None:
    """Leaves ``lines`` at the first line from which records follow: ``@``, two lines on ``+``, as many qualities as letters, and so again ``AGREE`` times or to the end.

    A line of qualities may begin with ``@`` or ``+``, but not the letters of a read; so from a wrong
    line the ``+`` is missed. Blank lines between records count as none.
    """
    while lines.fill(4):
        at, good = 0, 0
        while good < AGREE and lines.fill(at + 4) and is_record(lines.lines[at : at + 4]):
            good, at = good + 1, at + 4
            while lines.fill(at + 1) and not lines.lines[at].strip():
                at += 1
        if good == AGREE or good and not lines.fill(at + 1):
            return
        lines.skip(1)
    lines.skip(len(lines.lines))


class FastqReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def partitions(self) -> list[InputPartition]:
        """Files in pieces of ``split_bytes``, small ones some to a task; compressed files whole. Tasks go by bytes, however small the pieces are."""
        files = data_files(self.path)
        whole = self.split_bytes * max(1, min(TASK_BYTES, sum(size for _, size in files) // TASKS) // self.split_bytes)
        out: list[InputPartition] = []
        for k, (path, size) in enumerate(files):
            if path.endswith(".gz"):
                out.append(Split(k, path, 0, None))
            else:
                out += [Split(k, path, lo, min(size, lo + whole), self.split_bytes) for lo in range(0, size, whole)]
        return out or [Split(0, "", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        """Batches of the records that begin in the split. ``ord`` is the file's number and the record's place in it: it does not depend on the cut."""
        if not partition.path:
            return
        system, path = store(partition.path)
        if partition.hi is None:
            stream = system.open_input_stream(path, compression="gzip")
        else:
            stream = system.open_input_file(path)
        held: list[list] = [[] for _ in _SCHEMA]
        with stream:
            for piece in partition.pieces():
                for columns in self._records(self._lines(stream, piece), piece):
                    for have, more in zip(held, columns, strict=True):
                        have += more
                    if len(held[0]) >= BATCH_ROWS:
                        yield self._batch(held)
                        held = [[] for _ in _SCHEMA]
        if held[0]:
            yield self._batch(held)

    @staticmethod
    def _batch(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types, strict=True)], schema=_SCHEMA)

    @staticmethod
    def _lines(stream, piece: Split) -> Lines:
        """Lines from the first record on that begins in the piece."""
        if piece.hi is None:
            return Lines(stream, 0)
        at = max(0, piece.lo - 1)
        stream.seek(at)
        lines = Lines(stream, at, min(CHUNK, max(1024, piece.hi - piece.lo)))
        if piece.lo > 0:
            lines.fill(1)
            lines.skip(1)  # up to the first line that begins in the piece
            record_start(lines)
        return lines

    def _records(self, lines: Lines, split: Split) -> Iterator[list[list]]:
        """Columns of the records that begin in the piece."""
        while lines.fill(1):
            blank = next((k for k, x in enumerate(lines.lines) if x.strip()), len(lines.lines))
            if blank:
                lines.skip(blank)
                continue
            if not lines.fill(4):
                raise ValueError(f"{split.path}: the record at byte {lines.begins[0]} is not FASTQ")
            n = len(lines.lines) // 4
            quads = lines.lines[: 4 * n]
            heads, seqs, quals = quads[0::4], quads[1::4], quads[3::4]
            begins = lines.begins[: 4 * n : 4]
            good = next((k for k in range(n) if not is_record(quads[4 * k : 4 * k + 4])), n)
            past = n if split.hi is None else next((k for k, b in enumerate(begins) if b >= split.hi), n)
            if good < min(n, past) and heads[good].strip():
                raise ValueError(f"{split.path}: the record at byte {begins[good]} is not FASTQ")
            n = min(good, past)
            ids = [h[1:].split(b" ", 1)[0].split(b"\t", 1)[0].decode("latin-1") for h in heads[:n]]
            if n:
                yield [ids, [s.decode("latin-1") for s in seqs[:n]], [(split.number << 44) + b for b in begins[:n]], [q.decode("latin-1") for q in quals[:n]]]
            if past <= good and past < len(begins):
                return
            lines.skip(4 * n)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "read_id string, seq string, ord long, qual string"

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def read_fastq(spark: SparkSession, path: str, keep_quality: bool = False, last_wins: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(read_id, seq, ord)``, with ``qual`` if asked for; of repeated ids the last stays. Files are read in pieces of ``split_bytes``, files of ``.gz`` whole."""
    spark.dataSource.register(FastqSource)
    rows = spark.read.format("fastq").option("splitBytes", split_bytes).load(path)
    rows = rows if keep_quality else rows.drop("qual")
    return dedup_last_by_id(rows).select(*rows.columns) if last_wins else rows


def read_reads(spark: SparkSession, path: str, format: str = "fasta") -> DataFrame:
    """Reads in either format."""
    from repseq.sources.fasta import read_fasta

    return {"fasta": read_fasta, "fastq": read_fastq}[format](spark, path)
