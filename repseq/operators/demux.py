"""Assigning reads to samples by their adapters, and clipping those."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from repseq.functions.dna import COMPLEMENT, IUPAC, trim_soft_ends

#: What a forward and a reverse adapter may miss of a full score.
FORWARD_SLACK, REVERSE_SLACK = 6, 10
#: Window of the read searched, in lengths of the adapter.
FORWARD_WINDOW, REVERSE_WINDOW = 2, 4
#: Windows of a worker's reads whose place it remembers for each adapter.
KNOWN = 20_000
OK, INCOMPLETE, NOMID, HAS_N = "ok", "incomplete", "nomid", "has_n"

_COMPLEMENT = np.arange(256, dtype=np.uint8)
for _a, _b in zip(IUPAC + IUPAC.lower(), COMPLEMENT + COMPLEMENT.lower(), strict=True):
    _COMPLEMENT[ord(_a)] = ord(_b)
_TURN = _COMPLEMENT.tobytes()


@dataclass(frozen=True)
class Sample:
    """A sample's adapters: barcode and primer of either side."""

    name: str
    forward: str
    reverse: str


def samples(config: DataFrame) -> list[Sample]:
    """The configuration, in its own order (``cfg_ord``): one row a sample of the run, a handful."""
    rows = config.orderBy("cfg_ord").collect()
    return [Sample(r.sampleName, r.forwardMid + r.forwardPrimer, r.reverseMid + r.reversePrimer) for r in rows]


def _table(seqs: Sequence[bytes], size: int) -> np.ndarray:
    """The first ``size`` bytes of each, as rows padded with 0, which matches nothing."""
    return np.frombuffer(b"".join([s[:size].ljust(size, b"\0") for s in seqs]), np.uint8).reshape(len(seqs), size)


def locate_adapter(windows: np.ndarray, adapter: str) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment (1, -1, gap -1) of an adapter in each row: its score, and how much of the read to clip.

    The clip is the later of the two starts plus the columns of the alignment. All rows
    at once: a step for each base of the adapter, its gaps along the read by a running
    maximum. Going back, diagonal before a gap in the read's copy, before one in the
    adapter; it starts at the first of the best cells in reading order of the read.
    """
    a = np.frombuffer(adapter.encode(), np.uint8)
    n, w = windows.shape
    h = np.zeros((len(a) + 1, n, w + 1), np.int16)
    along = np.arange(w + 1, dtype=np.int16)
    for i in range(1, len(a) + 1):
        row = h[i - 1] - 1
        row[:, 1:] = np.maximum(row[:, 1:], h[i - 1][:, :-1] + np.where(windows == a[i - 1], 1, -1).astype(np.int16))
        np.maximum(row, 0, out=row)
        h[i] = np.maximum.accumulate(row + along, axis=1) - along
    cells = h.transpose(1, 2, 0).reshape(n, -1)
    best = cells.argmax(axis=1)
    score = cells[np.arange(n), best].astype(np.int64)
    j, i = best // (len(a) + 1), best % (len(a) + 1)
    columns = np.zeros(n, np.int64)
    live = np.flatnonzero(score > 0)
    while len(live):
        at_i, at_j = i[live], j[live]
        here = h[at_i, live, at_j]
        up, left = np.maximum(at_i - 1, 0), np.maximum(at_j - 1, 0)
        same = np.where(windows[live, left] == a[up], 1, -1)
        inner = (at_i > 0) & (at_j > 0)
        diagonal = inner & (here == h[up, live, left] + same)
        read_gap = ~diagonal & (at_j > 0) & (here == h[at_i, live, left] - 1)
        i[live] -= (~read_gap).astype(np.int64)
        j[live] -= (diagonal | read_gap).astype(np.int64)
        columns[live] += 1
        live = live[h[i[live], live, j[live]] > 0]
    return score, np.maximum(i, j) + columns


def best_scores(windows: np.ndarray, adapter: str) -> np.ndarray:
    """The scores alone of ``locate_adapter``, without the table to go back in."""
    a = np.frombuffer(adapter.encode(), np.uint8)
    n, w = windows.shape
    along = np.arange(w + 1, dtype=np.int16)
    row, best = np.zeros((n, w + 1), np.int16), np.zeros(n, np.int16)
    for c in a:
        new = row - 1
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + np.where(windows == c, 1, -1).astype(np.int16))
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + along, axis=1) - along
        np.maximum(best, row.max(axis=1), out=best)
    return best.astype(np.int64)


def located(seqs: Sequence[bytes], adapter: str, size: int, least: int, known: dict[bytes, tuple[int, int]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``locate_adapter`` in the first ``size`` bytes of each sequence; the clip is 0 where the score is less than ``least``.

    Each different window is looked at once. One that holds the whole adapter needs no alignment: no other scores as much as its
    first place. Of the rest, those that score enough are aligned again with the way back. ``known`` keeps what was found, for the next call.
    """
    known = {} if known is None else known
    windows = [s[:size] for s in seqs]
    new = [x for x in dict.fromkeys(windows) if x not in known]
    whole, open_ = adapter.encode(), []
    for x in new:
        at = x.find(whole) if whole else -1
        if at < 0:
            open_.append(x)
        else:
            known[x] = len(whole), at + len(whole)
    for lo in range(0, len(open_), 1024):
        part = open_[lo : lo + 1024]
        table = _table(part, size)
        score = best_scores(table, adapter)
        clip = np.zeros(len(part), np.int64)
        enough = np.flatnonzero(score >= least)
        if len(enough):
            clip[enough] = locate_adapter(table[enough], adapter)[1]
        known.update(zip(part, zip(score.tolist(), clip.tolist(), strict=True), strict=True))
    out = np.array([known[x] for x in windows], np.int64).reshape(len(windows), 2)
    if len(known) > KNOWN:
        known.clear()
    return out[:, 0], out[:, 1]


def assign(trimmed: Sequence[str], found: Sequence[Sample], forward_slack: int = FORWARD_SLACK, reverse_slack: int = REVERSE_SLACK, known: dict | None = None) -> list[tuple[str, str | None, str | None]]:
    """``(status, sample, clipped)`` of each read.

    Samples in order, each with the read as it is, then with its sides exchanged: the
    first side's adapter must score its length less ``forward_slack`` near the start;
    else the next try. Then the second side's must score its length less
    ``reverse_slack`` near the start of the reverse complement; if not, the read is
    incomplete in that sample and no further one is tried. ``known`` keeps places of adapters for the next call.
    """
    known = {} if known is None else known
    of = lambda seqs, adapter, size, least: located(seqs, adapter, size, least, known.setdefault((adapter, size, least), {}))
    reads = [s.encode("latin-1", "replace") for s in trimmed]
    turned = [r.translate(_TURN)[::-1] for r in reads]
    out: list[tuple[str, str | None, str | None]] = [(NOMID, None, None)] * len(reads)
    left = np.arange(len(reads))
    for sample in found:
        for first, second, swapped in ((sample.forward, sample.reverse, False), (sample.reverse, sample.forward, True)):
            if not len(left):
                return out
            score, clip = of([reads[k] for k in left.tolist()], first, FORWARD_WINDOW * len(first), len(first) - forward_slack)
            near = score >= len(first) - forward_slack
            some, start = left[near], clip[near]
            left = left[~near]
            if not len(some):
                continue
            score, stop = of([turned[k] for k in some.tolist()], second, REVERSE_WINDOW * len(second), len(second) - reverse_slack)
            for k, s, cut, tail in zip(some.tolist(), score.tolist(), start.tolist(), stop.tolist(), strict=True):
                if s < len(second) - reverse_slack:
                    out[k] = (INCOMPLETE, sample.name, None)
                else:
                    size = len(reads[k])
                    clipped = turned[k][tail : max(tail, size - cut)] if swapped else reads[k][cut : max(cut, size - tail)]
                    out[k] = (OK, sample.name, clipped.decode("latin-1"))
    return out


def demultiplex(reads: DataFrame, config: DataFrame, forward_slack: int = FORWARD_SLACK, reverse_slack: int = REVERSE_SLACK) -> DataFrame:
    """``reads`` (read_id, seq, ...) plus ``sample``, ``status`` and the resulting ``out_seq``.

    ``ok``: clipped, in forward direction and upper case. ``incomplete``: the read without soft ends.
    ``has_n`` (an N is left after trimming) and ``nomid``: the read as it was. A null
    sequence is ``nomid``. One pass over the reads, no shuffle; the adapters travel with the code.
    """
    found = samples(config)
    names = [c for c in reads.columns if c not in ("sample", "status", "out_seq")]
    given = reads.select(*names, trim_soft_ends(F.col("seq")).alias("__trimmed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                trimmed, original = part.column("__trimmed").to_pylist(), part.column("seq").to_pylist()
                able = [k for k, s in enumerate(trimmed) if s is not None and "N" not in s]
                status = [NOMID if s is None else HAS_N for s in trimmed]
                sample: list[str | None] = [None] * len(trimmed)
                result = list(original)
                for k, (what, whose, clipped) in zip(able, assign([trimmed[k] for k in able], found, forward_slack, reverse_slack, known), strict=True):
                    status[k], sample[k] = what, whose
                    result[k] = clipped.upper() if what == OK else trimmed[k] if what == INCOMPLETE else original[k]
                own = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(x, pa.string()) for x in (sample, status, result))], [*names, "sample", "status", "out_seq"])

    kept = [f for f in reads.schema.fields if f.name in names]
    return given.mapInArrow(run, StructType([*kept, *StructType.fromDDL("sample string, status string, out_seq string").fields]))


def demux_summary(demuxed: DataFrame, config: DataFrame) -> DataFrame:
    """Reads by sample and status; samples of the configuration without any read have a row of 0 and a null status."""
    counts = demuxed.groupBy("sample", "status").agg(F.count("*").alias("n_reads"))
    named = config.select(F.col("sampleName").alias("sample")).distinct()
    return counts.join(named, "sample", "full").select("sample", "status", F.coalesce("n_reads", F.lit(0).cast("long")).alias("n_reads"))  # one pass over the reads
