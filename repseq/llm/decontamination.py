"""Benchmark decontamination: an FM-index over the words of each shard of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from repseq.llm.textcore import LOWER, LOWER_WORD, Block, Slices, blocks, lean, segment_sums
from repseq.operators.shared import materialise

WINDOW = 10
#: Bytes of text under one index.
SHARD_BYTES = 1 << 20
#: Every so many text positions one suffix position is kept.
SAMPLE_RATE = 8
#: Bytes of benchmark text in one pass over the documents.
PASS_BYTES = 16 << 20
#: Passes between two checkpoints.
PASSES = 4


# --- the index ----------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``text``, numbers that end in a lone 0.

    As many symbols as fit 63 bits make the first key; then suffixes that are still tied, and only they,
    are ordered by the rank of what follows, twice as far each time.
    """
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    step = min(8, 63 // bits)
    ahead = np.zeros(n + step, np.int64)
    ahead[:n] = text
    key = ahead[:n].copy()
    for k in range(1, step):
        key = key << bits | ahead[k : n + k]
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(n, np.int64)
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    tied = ~(head & np.concatenate([head[1:], [True]]))
    places = np.flatnonzero(tied)
    while len(places):
        who = order[places]
        after = who + step
        key = (rank[who] << 32) | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        turn = np.argsort(key)
        who, key = who[turn], key[turn]
        order[places] = who
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[who] = np.maximum.accumulate(np.where(head, places, 0))
        places = places[~(head & np.concatenate([head[1:], [True]]))]
        step *= 2
    return order


class WaveletTree:
    """Rank and access on a sequence of numbers, level by level from the highest bit (all nodes of a level side by side)."""

    def __init__(self, seq: np.ndarray):
        self.levels = []
        top = int(seq.max()).bit_length() if len(seq) else 0
        seq = seq.astype(np.int32)
        for b in range(top - 1, -1, -1):
            bit = (seq >> b) & 1 == 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((b, ones, np.int64(len(seq) - ones[-1])))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """How often ``symbol`` occurs before each of ``places``."""
        at = [np.zeros(len(symbol), np.int64), *places]
        for b, ones, zeros in self.levels:
            up = (symbol >> b) & 1 == 1
            at = [np.where(up, zeros + ones[i], i - ones[i]) for i in at]
        return [i - at[0] for i in at[1:]]

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before it."""
        symbol, first = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        for b, ones, zeros in self.levels:
            up = ones[place + 1] > ones[place]
            symbol |= up.astype(np.int64) << b
            place, first = (np.where(up, zeros + ones[i], i - ones[i]) for i in (place, first))
        return symbol, place - first


class FMIndex:
    """Backward search and location in a text of numbers that ends in a lone 0."""

    def __init__(self, text: np.ndarray, rate: int = SAMPLE_RATE):
        order = suffix_array(text)
        self.n = len(text)
        self.tree = WaveletTree(text[order - 1])
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text))])
        sampled = order % rate == 0
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``lo`` to ``hi`` of the suffixes that begin with each pattern; empty where hi <= lo. A negative symbol never occurs."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.where((patterns >= 0).sum(1) == lengths, self.n, 0)
        for j in range(patterns.shape[1] - 1, -1, -1):
            on = np.flatnonzero((j < lengths) & (hi > lo))
            if not len(on):
                continue
            symbol = patterns[on, j]
            low, high = self.tree.rank(symbol, lo[on], hi[on])
            lo[on], hi[on] = self.below[symbol] + low, self.below[symbol] + high
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back through the text until a sampled one."""
        out, steps = np.empty(len(rows), np.int64), 0
        left, at = np.arange(len(rows)), rows
        while len(left):
            found = self.sampled[at + 1] > self.sampled[at]
            out[left[found]] = self.positions[self.sampled[at[found]]] + steps
            left, at = left[~found], at[~found]
            symbol, before = self.tree.access(at)
            at = self.below[symbol] + before
            steps += 1
        return out


# --- the phrases --------------------------------------------------------------------


@dataclass
class Phrases:
    """The words of benchmark items by number, one item after another, and the windows in them: where each begins, how many words it has, whose it is."""

    words: list[bytes]
    hashes: np.ndarray
    sequence: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    item_of: np.ndarray
    items: list[str]


def phrases(items: Sequence[tuple[object, str | None]], width: int = WINDOW) -> Phrases:
    """All windows of ``width`` consecutive words of each item; an item of fewer words, but not none, is one window."""
    names = ["" if k is None else str(k) for k, _ in items]
    words: list[bytes] = []
    known, sequence, begins, lengths, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    number: dict[bytes, int] = {}
    at = 0
    for block in blocks(pa.array([t for _, t in items], pa.string())):
        buf = LOWER[block.buf]
        starts, ends, firsts = block.words(LOWER_WORD, buf)
        keys, example, place = np.unique(Slices(buf).hashes(starts, ends), return_index=True, return_inverse=True)
        data, own, fresh = buf.tobytes(), np.zeros(len(keys), np.int32), []
        for k, e in enumerate(example.tolist()):
            word = data[starts[e] : ends[e]]
            if word not in number:
                number[word] = len(number)
                fresh.append(k)
            own[k] = number[word]
        words += [data[starts[e] : ends[e]] for e in example[fresh].tolist()]
        known.append(keys[fresh])
        sequence.append(own[place])
        per = np.diff(firsts)
        n = np.where(per >= width, per - width + 1, np.minimum(per, 1))
        text = np.repeat(np.arange(block.n), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        begins.append(at + firsts[text] + nth)
        lengths.append(np.minimum(per, width)[text].astype(np.int32))
        owner.append((block.lo + text).astype(np.int32))
        at += len(starts)
    return Phrases(words, *map(np.concatenate, (known, sequence, begins, lengths, owner)), names)


@dataclass
class Found:
    """Of a block: word starts and ends, first word of each text, which words are hit, and (text, item) pairs."""

    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    hit: np.ndarray
    texts: np.ndarray
    items: np.ndarray


def find(block: Block, sought: Phrases, rate: int = SAMPLE_RATE, most: int = SHARD_BYTES) -> Found:
    """Index the words of a block and find every occurrence of every window.

    A text of more than ``most`` bytes is indexed in pieces that overlap by one word
    less than the longest window, so each occurrence is whole in one of them.
    """
    buf = LOWER[block.buf]
    starts, ends, firsts = block.words(LOWER_WORD, buf)
    n = len(starts)
    hit, none = np.zeros(n, bool), np.zeros(0, np.int64)
    if n == 0 or len(sought.begins) == 0:
        return Found(starts, ends, firsts, hit, none, none)
    if block.n == 1 and len(buf) > most and n > 1:
        items, at, more = [none], 0, int(sought.lengths.max()) - 1
        while at < n:
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + most // 2, "right")))
            last = min(n, stop + more)
            size = int(ends[last - 1] - starts[at])
            part = find(Block(0, 1, block.buf[starts[at] : ends[last - 1]], np.array([0, size])), sought, rate, max(most, size))
            hit[at:last] |= part.hit
            items.append(part.items)
            at = stop
        own = np.unique(np.concatenate(items))
        return Found(starts, ends, firsts, hit, np.zeros(len(own), np.int64), own)
    vocabulary, example, ids = np.unique(Slices(buf).hashes(starts, ends), return_index=True, return_inverse=True)
    at = np.minimum(np.searchsorted(vocabulary, sought.hashes), len(vocabulary) - 1)
    known = vocabulary[at] == sought.hashes
    for k in np.flatnonzero(known):  # equal hashes are held against the words themselves
        w = example[at[k]]
        known[k] = buf[starts[w] : ends[w]].tobytes() == sought.words[k]
    so_far = np.zeros(len(sought.sequence) + 1, np.int32)
    np.cumsum(known[sought.sequence], out=so_far[1:])
    possible = np.flatnonzero(so_far[sought.begins + sought.lengths] - so_far[sought.begins] == sought.lengths)
    if not len(possible):
        return Found(starts, ends, firsts, hit, none, none)
    # words of possible windows keep their numbers; all others are one symbol, which no window has
    reach = np.arange(int(sought.lengths.max()))
    lengths = sought.lengths[possible]
    windows = np.where(reach < lengths[:, None], sought.sequence[np.minimum(sought.begins[possible][:, None] + reach, len(sought.sequence) - 1)], -1)
    asked = np.zeros(len(known), bool)
    asked[windows[windows >= 0]] = True
    symbols = np.append(np.where(asked, np.cumsum(asked) + 2, 0), -1)
    windows = symbols[windows]
    other = np.full(len(vocabulary), 2, np.int64)
    other[at[asked]] = symbols[:-1][asked]
    text = np.ones(n + block.n + 1, np.int64)  # 1 between texts, 0 at the end
    place = np.arange(n) + np.repeat(np.arange(block.n), np.diff(firsts))
    text[place] = other[ids]
    text[-1] = 0
    index = FMIndex(text, rate)
    lo, hi = index.search(windows, lengths)
    times = np.maximum(hi - lo, 0)
    window = np.repeat(np.arange(len(possible)), times)
    if not len(window):
        return Found(starts, ends, firsts, hit, none, none)
    rows = np.arange(len(window)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
    word = np.searchsorted(place, index.locate(rows))
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, word, 1)
    np.add.at(steps, word + lengths[window], -1)
    hit = np.cumsum(steps[:-1]) > 0
    texts = np.searchsorted(firsts, word, "right") - 1
    pairs = np.unique(texts * len(sought.items) + sought.item_of[possible[window]])
    return Found(starts, ends, firsts, hit, pairs // len(sought.items), pairs % len(sought.items))


def spans(found: Found, k: int) -> list[tuple[int, int]]:
    """Byte spans, relative to the block, of maximal runs of hit words of text k."""
    a, b = found.firsts[k], found.firsts[k + 1]
    edge = np.diff(np.concatenate([[0], found.hit[a:b].astype(np.int8), [0]]))
    return list(zip(found.starts[a + np.flatnonzero(edge == 1)].tolist(), found.ends[a + np.flatnonzero(edge == -1) - 1].tolist(), strict=True))


# --- the operators ------------------------------------------------------------------


def passes(benchmark: DataFrame, width: int = WINDOW, most: int = PASS_BYTES) -> Iterator[Phrases]:
    """The benchmark as phrase sets of at most ``most`` bytes of text (or one longer item), one at a time on the driver."""
    kept, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        own = len((r.text or "").encode())
        if kept and size + own > most:
            yield phrases(kept, width)
            kept, size = [], 0
        kept.append((r.item_id, r.text))
        size += own
    if kept:
        yield phrases(kept, width)


def settled(df: DataFrame, alive: list[Broadcast]) -> DataFrame:
    """``df`` computed and kept; the phrases that were broadcast for it go."""
    out = materialise(df)
    while alive:
        alive.pop().unpersist()
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` plus ``hit_spans`` array<struct<first:long,last:long>> (merged runs of hit words, by word number), ``hit_items`` array<string> and ``n_words`` long.

    Each block of a partition is one shard with its own index; the benchmark is
    broadcast in passes of bounded size, each adding to what the one before found, so
    no benchmark is too large and no shuffle is needed. Null text has no words; an empty
    benchmark hits nothing; repeated items count once by id; a null item_id is the empty
    string. Columns of ``docs`` with those names are replaced.
    """
    spark = docs.sparkSession
    alive: list[Broadcast] = []
    docs = docs.drop("hit_spans", "hit_items", "n_words")
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("hit_spans array<struct<first: bigint, last: bigint>>, hit_items array<string>, n_words long").fields])
    given, names = docs.columns, schema.names
    span_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def one_pass(df: DataFrame, sought: Phrases, first: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(sought)
        alive.append(shared)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query = shared.value
            for batch in batches:
                for block in blocks(batch.column("text"), SHARD_BYTES):
                    part = batch.slice(block.lo, block.n)
                    found = find(block, query)
                    items: list[list[str]] = [[] for _ in range(block.n)]
                    for t, i in zip(found.texts.tolist(), found.items.tolist(), strict=True):
                        items[t].append(query.items[i])
                    if not first:
                        for k, (old, more) in enumerate(zip(part.column("hit_spans").to_pylist(), part.column("hit_items").to_pylist(), strict=True)):
                            items[k] += more
                            for s in old:
                                found.hit[found.firsts[k] + s["first"] : found.firsts[k] + s["last"] + 1] = True
                    runs: list[list[dict]] = [[] for _ in range(block.n)]
                    for k in np.flatnonzero(segment_sums(found.hit, found.firsts)):
                        edge = np.diff(np.concatenate([[0], found.hit[found.firsts[k] : found.firsts[k + 1]].astype(np.int8), [0]]))
                        runs[k] = [{"first": a, "last": b - 1} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
                    own = [part.column(c) for c in given]
                    new = [pa.array(runs, span_type), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())), pa.array(np.diff(found.firsts), pa.int64())]
                    yield pa.RecordBatch.from_arrays([*own, *new], names)

        return df.mapInArrow(lean(run), schema)

    out, k = docs, 0
    for k, sought in enumerate(passes(benchmark, width, pass_bytes), 1):
        out = one_pass(out, sought, k == 1)
        if k % PASSES == 0:
            out = settled(out, alive)
    return out if k else one_pass(docs, phrases([], width), True)


def remove_spans(texts: pa.Array, sought: Phrases) -> list[str | None]:
    """The texts without the words of any window's occurrence, again until none is left (what is cut can't join up to a new one)."""
    out = texts.to_pylist()
    todo = list(range(len(out)))
    while todo:
        again = []
        for block in blocks(pa.array([out[i] for i in todo], pa.string()), SHARD_BYTES):
            found = find(block, sought)
            for k in np.flatnonzero(segment_sums(found.hit, found.firsts)).tolist():
                at, end, pieces = int(block.offs[k]), int(block.offs[k + 1]), []
                for s, e in spans(found, k):
                    pieces.append(block.buf[at:s].tobytes())
                    at = e
                pieces.append(block.buf[at:end].tobytes())
                which = todo[block.lo + k]
                out[which] = b"".join(pieces).decode()
                again.append(which)
        todo = again
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` with every occurrence of a benchmark window cut from ``text``; ``n_chars``, if there, follows. Clean texts stay byte for byte.

    Null texts stay null. A text that is wholly benchmark becomes what stands around
    it. With several passes the first passes run again until none cuts anything, as a cut of one pass may join words
    into a window of another.
    """
    spark = docs.sparkSession
    alive: list[Broadcast] = []
    has_length = "n_chars" in docs.columns

    def cut(df: DataFrame, sought: Phrases) -> DataFrame:
        shared = spark.sparkContext.broadcast(sought)
        alive.append(shared)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                old = batch.column("text")
                new = pa.array(remove_spans(old, shared.value), old.type)
                columns = {name: batch.column(name) for name in batch.schema.names}
                columns["text"] = new
                if has_length:
                    changed = np.array([a != b for a, b in zip(old.to_pylist(), new.to_pylist(), strict=True)], bool)
                    lengths = [len(t) if c else n for t, c, n in zip(new.to_pylist(), changed, columns["n_chars"].to_pylist(), strict=True)]
                    columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        return df.mapInArrow(lean(run), docs.schema)

    sets = 0
    out = docs
    for sets, sought in enumerate(passes(benchmark, width, pass_bytes), 1):
        out = cut(out, sought)
        if sets % PASSES == 0:
            out = settled(out, alive)
    while sets > 1 and contamination(out, benchmark, width, pass_bytes).where("size(hit_spans) > 0").limit(1).count():
        for sought in passes(benchmark, width, pass_bytes):
            out = settled(cut(out, sought), alive)
    return out


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row a document."""
    found = contamination(docs.select("doc_id", "text"), benchmark, **options)
    return found.selectExpr(
        "doc_id", "n_words",
        "aggregate(hit_spans, 0L, (n, s) -> n + s.last - s.first + 1) AS n_hit",
        "cast(size(hit_items) AS bigint) AS n_items",
        "sha2(array_join(hit_items, ','), 256) AS items_sha256",
        "size(hit_spans) > 0 AS contaminated",
    )


#: ``items_sha256`` of a document without items.
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), p AS (
  SELECT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), o AS (
  SELECT k, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)
), f AS (
  SELECT o.k, o.i, o.n, p.item FROM o JOIN (SELECT DISTINCT item, n, phrase FROM p) p ON o.n = p.n AND o.phrase = p.phrase
), h AS (
  SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS place FROM f) GROUP BY k
), t AS (
  SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM f GROUP BY k
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)
"""
