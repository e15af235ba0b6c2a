"""Whole-batch text scanning on Arrow buffers with numpy: no loop over words or characters.

A batch is cut into blocks of a bounded number of bytes (one longer text is a block of
its own); each block is one byte buffer with the texts' offsets. Words are runs of the
bytes a table allows. All word classes used here end at ASCII bytes only, so working on
UTF-8 bytes equals working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from repseq.operators.shared import give_back

BLOCK_BYTES = 1 << 20
U64 = np.uint64


def _table(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
LOWER_WORD = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: A-Z to a-z, all else as it is.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def lean(run):
    """A function over batches that gives memory back when its task ends: workers outlive tasks."""

    @wraps(run)
    def over(batches):
        yield from run(batches)
        give_back()

    return over


class Block:
    """Texts ``lo`` to ``hi`` of a batch: ``buf`` their bytes, ``offs`` where each begins, and the end."""

    def __init__(self, lo: int, hi: int, buf: np.ndarray, offs: np.ndarray):
        self.lo, self.hi, self.buf, self.offs = lo, hi, buf, offs
        self.n = hi - lo

    def words(self, table: np.ndarray, buf: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the number of the first word of each text (and the end)."""
        return runs(table[self.buf if buf is None else buf], self.offs)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offs[1:]] - total[self.offs[:-1]]

    def take(self, keep: np.ndarray) -> Block:
        """The texts that ``keep`` flags, as a block."""
        lens = np.diff(self.offs)
        offs = np.zeros(int(keep.sum()) + 1, np.int64)
        np.cumsum(lens[keep], out=offs[1:])
        return Block(0, len(offs) - 1, self.buf[np.repeat(keep, lens)], offs)


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offs[1:-1]
    before[edges[edges < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = edges[edges > 0]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of consecutive texts. Null is the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, at, data = texts.buffers()
    offs = np.frombuffer(at, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield Block(lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


#: Odd multipliers; their powers weigh bytes in a word and words in a window.
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(maxsize=2)
def _powers(odd: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(odd, -1, 1 << 64)
    with np.errstate(over="ignore"):
        forth, back = (np.concatenate([[U64(1)], np.cumprod(np.full(size, x, U64))]) for x in (odd, inverse))
    return forth, back


def powers(odd: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``odd`` and of its inverse modulo 2**64, at least ``size`` of them."""
    return _powers(odd, max(1 << 16, 1 << (size - 1).bit_length()) if size else 1 << 16)


_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class Slices:
    """64-bit hashes of any slices of a buffer, from one prefix sum."""

    def __init__(self, buf: np.ndarray):
        forth, self.back = powers(_P, len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U64)
        np.cumsum(_BYTE[buf] * forth[: len(buf)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return scrambled((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(U64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive numbers of ``words``."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    forth, back = powers(_Q, len(words) + 1)
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * forth[: len(words)], out=sums[1:])
    return scrambled((sums[width:] - sums[:n]) * back[:n])


def covered(begins: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Flags of the ``n`` places that runs of ``width`` from ``begins`` cover."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + width, -1)
    return np.cumsum(steps[:-1]) > 0


def segment_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (along the first axis) over the segments that ``offs`` bounds, empty ones included."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), values.dtype if values.dtype.kind in "iuf" and values.dtype.itemsize == 8 else np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]
