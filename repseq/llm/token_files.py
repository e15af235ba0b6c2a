"""Token ids in Arrow files of equal-length sequences, for zero-copy random access."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from repseq.llm.textcore import LOWER, Block, Slices, blocks, lean, runs
from repseq.operators.shared import checkpoint_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Ids in a sequence, and sequences in a record batch.
LENGTH = 2048
BATCH = 64
#: Bytes of text a file is planned for.
FILE_BYTES = 64 << 20
#: Different pieces of words whose ids a worker keeps.
CACHE_PIECES = 3_000_000


#: Bytes by what they are to the tokenizer: 0 white space, 1 ASCII letters, 2 digits, 3 signs, 4 what makes a word be encoded whole.
_KIND = np.full(256, 4, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[[c for c in b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = 3


def pieces(block: Block) -> tuple[np.ndarray, ...]:
    """A block's bytes in lower case, starts and ends of the pieces to encode, which are letters only, and the first of each text (and the end).

    The tokenizer drops white space, writes lower case, and keeps letters, single digits
    and runs of other signs apart, so words of ASCII and Latin-1 letters, digits and ASCII signs are cut where these
    meet. Words with anything else (other scripts, marks that compose with the letter before,
    apostrophes, control characters, the beginning of a special token) are left whole and as they are.
    """
    buf = block.buf
    n = len(buf)
    kind = _KIND[buf]
    lower = LOWER[buf]
    lead = np.zeros(n, bool)
    lead[:-1] = (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    tail = np.flatnonzero(lead) + 1
    kind[lead] = 1
    kind[tail] = 1
    capital = tail[buf[tail] <= 0x9E]
    lower[capital] += 0x20
    special = np.flatnonzero((buf[:-1] == 0x3C) & (buf[1:] == 0x7C))
    kind[special] = 4
    starts, ends, _ = runs(kind > 0, block.offs)
    odd = np.concatenate([[0], np.cumsum(kind == 4)])
    hard = odd[ends] > odd[starts]
    inside = np.zeros(n + 1, np.int8)
    np.add.at(inside, starts[hard], 1)
    np.add.at(inside, ends[hard], -1)
    whole = np.cumsum(inside[:-1]) > 0
    kind[whole] = 5
    lower[whole] = buf[whole]
    first = np.zeros(n, bool)
    first[starts] = True
    first[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0)
    begin = np.flatnonzero(first)
    stop = np.minimum(ends[np.searchsorted(ends, begin, "right")] if len(begin) else begin, np.append(begin[1:], n))
    return lower, begin, stop, kind[begin] == 1, np.searchsorted(begin, block.offs)


class Encoder:
    """Encodes texts piece by piece, each different piece once, as long as the table of known ones has room.

    The tests hold this against encoding whole texts.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.end_id = end_id
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[k for word, k in self.tokenizer.get_vocab().items() if word.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Only the end id is known, as the first of the pool."""
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.at = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.first, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.pool = np.array([self.end_id], self.kind)

    def ids_of(self, words: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has.

        Of ``plain`` words, which are letters only, many make one text: each gives one
        token that ends a word, its last. Where that doesn't add up they go one by one.
        """
        def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), self.kind), np.fromiter(map(len, ids), np.int64, len(ids))

        size = np.zeros(len(words), np.int64)
        easy = np.flatnonzero(plain)
        many, _ = encoded([" ".join([words[k] for k in easy[lo : lo + 128].tolist()]) for lo in range(0, len(easy), 128)])
        stops = np.flatnonzero(self.ends_word[many]) + 1
        if len(stops) != len(easy) or (len(many) and stops[-1] != len(many)):
            plain, many, stops = np.zeros(len(words), bool), many[:0], stops[:0]
        size[plain] = np.diff(stops, prepend=0)
        some, size[~plain] = encoded([words[k] for k in np.flatnonzero(~plain).tolist()])
        out = np.empty(int(size.sum()), self.kind)
        easy = np.repeat(plain, size)
        out[easy], out[~easy] = many, some
        return out, size

    def learn(self, keys: np.ndarray, words: list[str], plain: np.ndarray) -> None:
        """Adds pieces, in order of key, to the smaller of two sorted tables; it joins the larger when it has grown."""
        ids, size = self.ids_of(words, plain)
        number = np.arange(len(self.size), len(self.size) + len(size))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, ids])
        large = len(self.keys[1]) + len(keys) > 60_000
        both = [np.concatenate([*(self.keys if large else self.keys[1:]), keys]), np.concatenate([*(self.at if large else self.at[1:]), number])]
        order = np.argsort(both[0])
        small = [np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        sorted_ = [x[order] for x in both]
        self.keys = [sorted_[0], small[0]] if large else [self.keys[0], sorted_[0]]
        self.at = [sorted_[1], small[1]] if large else [self.at[0], sorted_[1]]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of known pieces, -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        for table, number in zip(self.keys, self.at, strict=True):
            if len(table):
                place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                own = table[place] == keys
                out[own] = number[place[own]]
        return out

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block's texts one after another, each text ending with the end id; and how many each has."""
        lower, begin, stop, plain, firsts = pieces(block) if len(block.buf) else (block.buf, *(np.zeros(0, np.int64),) * 3, np.zeros(block.n + 1, np.int64))
        if len(self.size) > CACHE_PIECES:
            self.forget()
        keys, place = np.unique(Slices(lower).hashes(begin, stop), return_inverse=True)
        number = self.find(keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            example = np.zeros(len(keys), np.int64)
            example[place] = np.arange(len(place))
            data, e = lower.tobytes(), example[new]
            self.learn(keys[new], [data[s:t].decode() for s, t in zip(begin[e].tolist(), stop[e].tolist(), strict=True)], plain[e])
            number[new] = np.arange(len(self.size) - len(new), len(self.size))
        per = np.diff(firsts)
        which = np.zeros(len(begin) + block.n, np.int64)
        inner = np.ones(len(which), bool)
        inner[np.cumsum(per + 1) - 1] = False
        which[inner] = number[place]
        lens = self.size[which]
        ends = np.cumsum(lens)
        ids = self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[which] - (ends - lens), lens)]
        counts = np.diff(np.concatenate([[0], ends[np.cumsum(per + 1) - 1]]))
        return ids, counts


# --- the files ----------------------------------------------------------------------


class SequenceWriter:
    """Cuts a stream of ids into rows of ``length``: ``ids`` and ``mask`` (true: an id, false: padding), both fixed-size lists.

    Only the last row of a file is padded. One record batch of pending rows is held.
    """

    def __init__(self, sink, kind: np.dtype, length: int = LENGTH, batch: int = BATCH):
        self.length, self.batch, self.kind = length, batch, np.dtype(kind)
        item = pa.from_numpy_dtype(self.kind)
        self.schema = pa.schema([pa.field("ids", pa.list_(pa.field("item", item, False), length), False), pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False)])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.held = self.n = 0

    def _rows(self, ids: np.ndarray, mask: np.ndarray) -> None:
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema, strict=True)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.held += len(ids)
        self.n += len(ids)
        full = self.length * self.batch
        if self.held >= full:
            stream = np.concatenate(self.pending)
            for at in range(0, len(stream) - full + 1, full):
                self._rows(stream[at : at + full], np.ones(full, bool))
            rest = stream[len(stream) // full * full :]
            self.pending, self.held = [rest.copy()], len(rest)

    def close(self) -> None:
        if self.held:
            stream = np.concatenate(self.pending)
            pad = -len(stream) % self.length
            self._rows(np.concatenate([stream, np.zeros(pad, self.kind)]), np.arange(len(stream) + pad) < len(stream))
        self.out.close()


class SequenceFile:
    """Random access to a file of sequences: rows and id ranges are views of the mapped file, nothing is copied or read ahead."""

    def __init__(self, source, length: int = LENGTH, batch: int = BATCH):
        self.reader = pa.ipc.open_file(source)
        self.length, self.batch = length, batch

    def _batch(self, k: int) -> tuple[np.ndarray, pa.Array]:
        got = self.reader.get_batch(k)
        return got.column("ids").flatten().to_numpy(zero_copy_only=True), got.column("mask").flatten()

    def row(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Sequence k and its mask."""
        ids, mask = self._batch(k // self.batch)
        at = k % self.batch * self.length
        return ids[at : at + self.length], mask.slice(at, self.length)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start``, in pieces of at most a record batch."""
        full = self.length * self.batch
        while n:
            k, at = divmod(start, full)
            piece = self._batch(k)[0][at : at + n]
            if not len(piece):
                raise ValueError("the file ends before the range")
            yield piece
            start, n = start + len(piece), n - len(piece)


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """Of a folder's URI: a local path, file:, hdfs:, s3: or gs:."""
    if "://" not in uri and not uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def opened(fs: pa.fs.FileSystem, path: str):
    """Mapped where files are local, else read by ranges."""
    return pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)


@dataclass(frozen=True)
class TokenFiles:
    """What was written: for each file, in order, its name, ids and documents; the ids before each are sums of those."""

    folder: str
    length: int
    batch: int
    files: tuple[tuple[str, int, int], ...]

    def starts(self) -> list[int]:
        return [0, *np.cumsum([n for _, n, _ in self.files]).tolist()][: len(self.files)]


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, length: int = LENGTH, batch: int = BATCH, file_bytes: int = FILE_BYTES
) -> TokenFiles:
    """Writes ``docs`` (doc_id, text) into ``folder``, shared by all executors, in ascending doc_id order.

    A range partition by (doc_id, checksum of text) is a file: ``part-NNNNN.arrow`` with the sequences and
    ``part-NNNNN.docs.arrow`` with doc_id and n_tokens of each document, in order. Both
    are written under other names and then renamed, so a task that runs twice leaves one
    file. Null doc_ids come last; rows of equal doc_id are in order of their text; a null
    text has the end id alone. A task holds one block of texts and one record batch of
    ids. An empty table writes no files.
    """
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // file_bytes), min(docs.sparkSession.sparkContext.defaultParallelism, -(-size // (1 << 20))))
    ordered = docs.withColumn("crc", F.crc32(F.col("text").cast("binary")))
    keys = [F.col("doc_id").asc_nulls_last(), F.col("crc").asc_nulls_first()]
    ordered = ordered.repartitionByRange(int(parts), *keys).sortWithinPartitions(*keys, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = listed = None
        part, mine = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, path = file_system(folder)
        name = f"{path}/part-{part:05d}"
        n_docs = 0
        for given in batches:
            for block in blocks(given.column("text")):
                if writer is None:
                    encoder = Encoder(vocabulary, end_id)
                    sink, index_sink = fs.open_output_stream(f"{name}.{mine}"), fs.open_output_stream(f"{name}.{mine}.docs")
                    writer = SequenceWriter(sink, encoder.kind, length, batch)
                    listed = pa.schema([("doc_id", given.schema.field("doc_id").type), ("n_tokens", pa.int64())])
                    index = pa.ipc.new_file(index_sink, listed)
                ids, counts = encoder.encode(block)
                writer.add(ids)
                index.write_batch(pa.RecordBatch.from_arrays([given.column("doc_id").slice(block.lo, block.n), pa.array(counts)], schema=listed))
                n_docs += block.n
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            index_sink.close()
            fs.move(f"{name}.{mine}.docs", f"{name}.docs.arrow")
            fs.move(f"{name}.{mine}", f"{name}.arrow")
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([writer.n]), pa.array([n_docs])], ["part", "n", "docs"])

    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    rows = sorted(tuple(r) for r in ordered.mapInArrow(lean(run), "part long, n long, docs long").collect())  # one row a file
    made = TokenFiles(folder, length, batch, tuple((f"part-{p:05d}", n, d) for p, n, d in rows))
    with fs.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps({"length": length, "batch": batch, "files": made.files}).encode())
    return made


def read_token_files(spark: SparkSession, made: TokenFiles, id_type: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files: each task maps its files and checks ids in place."""
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"
    if not made.files:
        return spark.createDataFrame([], schema)
    folder, length, batch = made.folder, made.length, made.batch
    listed = spark.createDataFrame([(name, start) for (name, _, _), start in zip(made.files, made.starts(), strict=True)], "name string, before long").repartition(len(made.files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for given in batches:
            for row in given.to_pylist():
                with opened(fs, f"{path}/{row['name']}.arrow") as source, opened(fs, f"{path}/{row['name']}.docs.arrow") as listing:
                    file, index, at = SequenceFile(source, length, batch), pa.ipc.open_file(listing), 0
                    for k in range(index.num_record_batches):
                        docs = index.get_batch(k)
                        counts = docs.column("n_tokens").to_numpy()
                        crcs = []
                        starts = row["before"] + at + np.cumsum(counts) - counts
                        for n in counts.tolist():
                            crc = 0
                            for piece in file.ids(at, n):
                                crc = zlib.crc32(piece.astype("<u4"), crc)
                            crcs.append(crc)
                            at += n
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(starts, pa.int64()), docs.column("n_tokens"), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(lean(run), schema)


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def op6_token_files(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
    folder = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    made = write_token_files(docs, folder, vocabulary_path())
    return read_token_files(spark, made, docs.schema["doc_id"].dataType.simpleString())
