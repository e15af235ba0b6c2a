"""Pieces of strings that few others of their group have, for the edit-distance join where many share their segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of a piece, and how many of the most frequent ones are known to all tasks; the others count as rare, which costs time but loses no pair.
LETTERS, COMMON = 8, 100_000
#: How many strings may have a piece that is sought, the fewer the better.
RARE = (4, 16, 64, 128)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span(n: int) -> int:
    """Places that count as one in a piece's key; more than ``n``, so a piece that moved by ``n`` lies in one of two."""
    return max(16, 4 * n)


def pieces(seqs: list[str], groups: np.ndarray, letters: int = LETTERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all pieces of strings, in order: the string's number, the place in it, and a hash of group and letters."""
    size = np.array([len(s) for s in seqs], np.int64)
    codes = np.frombuffer("".join(seqs).encode("utf-32-le"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(seqs)), size)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    first = np.flatnonzero(at + letters <= size[of])
    value = np.zeros(len(first), np.uint64)
    for k in range(letters):
        value = value * _STEP + codes[first + k] + np.uint64(1)
    return of[first], at[first], _mixed(value ^ _mixed(groups.astype(np.int64).view(np.uint64)[of[first]]))


def keyed(value: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return _mixed(value + bucket.astype(np.int64).view(np.uint64) * _STEP).view(np.int64)


def times_known(key: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How often each key occurs by ``common`` (sorted keys, numbers); 0 where it is not in there."""
    keys, times = common
    if not len(keys):
        return np.zeros(len(key), np.int64)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, times[at], 0)


def _read(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    return batch.column("s").to_pylist(), batch.column("gh").to_numpy(), batch.column("id").to_numpy()


def common_pieces(rows: DataFrame, n: int, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pieces, with their places about, that more than ``RARE[0]`` of ``rows`` (id, gh, s) have, sorted, and how many; of the ``most`` most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, groups, _ = _read(batch)
            _, at, value = pieces(seqs, groups)
            key, times = np.unique(keyed(value, at // span(n)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(times.astype(np.int64))], ["k", "n"])

    counts = rows.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") > RARE[0])
    found = sorted((r.k, r.n) for r in counts.orderBy(F.desc("n"), "k").limit(most).collect())
    return np.array([k for k, _ in found], np.int64), np.array([n for _, n in found], np.int64)


def rare_index(rows: DataFrame, n: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(k, ia, la, at, i)``: n + 1 pieces of each of ``rows`` (id, gh, s) that do not overlap, i from 0 in order of place.

    They are the first that no more than ``RARE[0]`` strings have, if there are so many of them, else the first that no more than
    ``RARE[1]`` have, and so on. No rows of a string that has too few at the last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, groups, ids = _read(batch)
            of, at, value = pieces(seqs, groups)
            key = keyed(value, at // span(n))
            times = times_known(key, common)
            width = max(map(len, seqs), default=0) + 2 * LETTERS
            size = np.array([len(s) for s in seqs], np.int32)
            open_ = np.ones(len(seqs), bool)
            for often in RARE:
                rare = np.flatnonzero((times <= often) & open_[of])
                line = of[rare] * width + at[rare]
                whose, taken = np.flatnonzero(open_), []
                least = np.zeros(len(whose), np.int64)
                for _ in range(n + 1):
                    found = np.searchsorted(line, whose * width + least)
                    here = found < len(line)
                    here[here] = of[rare[found[here]]] == whose[here]
                    whose, taken = whose[here], [t[here] for t in taken]
                    taken.append(rare[found[here]])
                    least = at[taken[-1]] + LETTERS
                open_[whose] = False
                out = np.stack(taken, axis=1).ravel()
                ia, la = np.repeat(ids[whose], n + 1), np.repeat(size[whose], n + 1)
                rank = np.tile(np.arange(n + 1, dtype=np.int32), len(whose))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[out], ia, la, at[out].astype(np.int32), rank)], ["k", "ia", "la", "at", "i"])

    return rows.mapInArrow(run, "k long, ia long, la int, at int, i int")


def rare_probe(rows: DataFrame, n: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(k, ib, lb, place)``: every piece of ``rows`` (id, gh, s) that no more than ``RARE[-1]`` strings are known to have, with each key that it may have in a string where it has moved by at most ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, groups, ids = _read(batch)
            of, at, value = pieces(seqs, groups)
            size = np.array([len(s) for s in seqs], np.int32)
            low, high = np.maximum(at - n, 0) // span(n), (at + n) // span(n)
            for bucket, asked in ((low, np.ones(len(at), bool)), (high, low < high)):
                key = keyed(value, bucket)
                own = np.flatnonzero(asked & (times_known(key, common) <= RARE[-1]))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[own], ids[of[own]], size[of[own]], at[own].astype(np.int32))], ["k", "ib", "lb", "place"])

    return rows.mapInArrow(run, "k long, ib long, lb int, place int")


def rare_candidates(rows: DataFrame, index: DataFrame, n: int, common: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """``(ia, ib)``: pairs of a string of ``index`` (``rare_index``) and one of ``rows`` as long or longer that share one of its pieces at a fitting place.

    n edits leave one of n + 1 pieces that do not overlap unchanged, such that what stands left of it has at most i of
    them and what stands right at most n - i.
    """
    probe = rare_probe(rows, n, common).repartition(parts, "k")
    both = index.repartition(parts, "k").join(probe, "k")
    moved, longer, left = F.col("place") - F.col("at"), F.col("lb") - F.col("la"), F.lit(n) - F.col("i")
    fits = (longer >= 0) & (longer <= n) & (moved >= F.greatest(-F.col("i"), longer - left)) & (moved <= F.least(F.col("i"), longer + left))
    return both.where(fits & ((longer > 0) | (F.col("ia") < F.col("ib")))).select("ia", "ib").distinct()
