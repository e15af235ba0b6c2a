"""Pairwise alignment with linear gaps, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scores of the local alignment of adapters, and of the global one of variants.
LOCAL = {"match": 1, "mismatch": -1, "gap": -1}
GLOBAL = {"match": 0, "mismatch": -1, "gap": -2}


@dataclass(frozen=True)
class Alignment:
    """``a`` and ``b`` with gaps as ``-``, where each begins, and the score."""

    a: str
    b: str
    start_a: int
    start_b: int
    score: int


def codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("latin-1", "replace"), np.uint8)


def matrix(a: np.ndarray, b: np.ndarray, match: int, mismatch: int, gap_a: int, gap_b: int, local: bool, free_a: bool = False) -> np.ndarray:
    """Scores of all prefixes. A row takes a few vector steps: the run of gaps along it is a running maximum.

    ``gap_a`` is the price of a gap in ``a``, ``gap_b`` of one in ``b``.
    """
    n, m = len(a), len(b)
    h = np.zeros((n + 1, m + 1), np.int64)
    along = np.arange(m + 1) * gap_a
    if not local:
        h[0] = along
        h[1:, 0] = 0 if free_a else np.arange(1, n + 1) * gap_b
    for i in range(1, n + 1):
        row = h[i - 1] + gap_b
        row[1:] = np.maximum(row[1:], h[i - 1, :-1] + np.where(a[i - 1] == b, match, mismatch))
        if local:
            row = np.maximum(row, 0)
        else:
            row[0] = h[i, 0]
        h[i] = np.maximum.accumulate(row - along) + along
    return h


def align(a: str, b: str, match: int, mismatch: int, gap_a: int, gap_b: int | None = None, local: bool = False, mutual: bool = True) -> Alignment:
    """The best alignment. Going back, a diagonal step is preferred to a gap in ``b``, and that to a gap in ``a``; a local one ends in the first of the best cells.

    ``mutual=False`` lays ``b`` wholly along ``a``: gaps in ``b`` only, which must not be longer than ``a``.
    """
    gap_b = gap_a if gap_b is None else gap_b
    x, y = codes(a), codes(b)
    if not mutual:
        if len(b) > len(a):
            raise ValueError("the second sequence is longer than the first")
        gap_a = -(1 << 30)
    h = matrix(x, y, match, mismatch, gap_a, gap_b, local)
    i, j = np.unravel_index(int(h.argmax()), h.shape) if local else (len(a), len(b))
    score, left, right = int(h[i, j]), [], []
    while (h[i, j] > 0) if local else (i or j):
        if i and j and h[i, j] == h[i - 1, j - 1] + (match if x[i - 1] == y[j - 1] else mismatch):
            i, j = i - 1, j - 1
            left.append(a[i])
            right.append(b[j])
        elif i and h[i, j] == h[i - 1, j] + gap_b:
            i -= 1
            left.append(a[i])
            right.append("-")
        else:
            j -= 1
            left.append("-")
            right.append(b[j])
    return Alignment("".join(reversed(left)), "".join(reversed(right)), int(i), int(j), score)


def align_local(a: str, b: str) -> Alignment:
    return align(a, b, LOCAL["match"], LOCAL["mismatch"], LOCAL["gap"], local=True)


def fewest_gaps(a: str, b: str) -> Alignment | None:
    """``align_global`` of strings as long as each other or longer by a letter, where fewer than 4 letters differ but for the one gap that asks for; else None. Two gaps more would cost 4."""
    x, y = codes(a), codes(b)
    n, m = len(x), len(y)
    if n == m:
        differ = int((x != y).sum())
        return Alignment(a, b, 0, 0, -differ) if differ < 4 else None
    if abs(n - m) != 1:
        return None
    few = min(n, m)
    left = np.concatenate([[0], np.cumsum(x[:few] != y[:few])])
    right = np.concatenate([[0], np.cumsum((x[n - few :] != y[m - few :])[::-1])])[::-1]
    at = int((left + right).argmin())
    differ = int(left[at] + right[at])
    if differ >= 4:
        return None
    return Alignment(a, f"{b[:at]}-{b[at:]}", 0, 0, -2 - differ) if n > m else Alignment(f"{a[:at]}-{a[at:]}", b, 0, 0, -2 - differ)


def align_global(a: str, b: str) -> Alignment:
    return fewest_gaps(a, b) or align(a, b, GLOBAL["match"], GLOBAL["mismatch"], GLOBAL["gap"])


def differing_columns(a: str, b: str) -> int:
    """Columns of a global alignment that differ, gaps included."""
    if a == b:
        return 0
    got = align_global(a, b)
    return sum(p != q for p, q in zip(got.a, got.b, strict=True))


def substitutions(a: str, b: str) -> int:
    """Columns of a global alignment with two different bases."""
    got = align_global(a, b)
    return sum(p != q and "-" not in (p, q) for p, q in zip(got.a, got.b, strict=True))


def levenshtein_to(one: str, others: list[str]) -> np.ndarray:
    """Edit distances of a sequence to many, all in one table, row by row."""
    if not others:
        return np.zeros(0, np.int64)
    width = max(map(len, others))
    table = np.zeros((len(others), width), np.uint8)
    for k, s in enumerate(others):
        table[k, : len(s)] = codes(s)
    x = codes(one)
    along = np.arange(width + 1)
    row = np.tile(along, (len(others), 1))
    for i in range(1, len(x) + 1):
        new = row + 1
        new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (table != x[i - 1]))
        new[:, 0] = i
        row = np.minimum.accumulate(new - along, axis=1) + along
    return row[np.arange(len(others)), [len(s) for s in others]]


def levenshtein_within(a: str, b: str, limit: int) -> bool:
    """Whether two sequences are at most ``limit`` edits apart: cells that far from the diagonal alone are looked at."""
    if abs(len(a) - len(b)) > limit:
        return False
    far = limit + 1
    row = {d: d for d in range(limit + 1)}  # edits to reach each diagonal (letters of b less those of a) at the row
    for i in range(1, len(a) + 1):
        new: dict[int, int] = {}
        for d in range(-min(limit, i), limit + 1):
            j = i + d
            if j > len(b):
                break
            cost = row.get(d + 1, far) + 1
            if j:
                cost = min(cost, row.get(d, far) + (a[i - 1] != b[j - 1]), new.get(d - 1, far) + 1)
            if cost <= limit:
                new[d] = cost
        if not new:
            return False
        row = new
    return row.get(len(b) - len(a), far) <= limit


ALIGNED = "struct<a:string,b:string,start_a:int,start_b:int,score:int>"


def udf_of(kind: str, of):
    """A vectorised function of two strings; each different pair of a batch is aligned once, null gives null."""

    def rows_of(left: pd.Series, right: pd.Series) -> list:
        known: dict = {}
        for p, q in zip(left, right, strict=True):
            if (p, q) not in known:
                known[p, q] = None if p is None or q is None else of(p, q)
        return [known[p, q] for p, q in zip(left, right, strict=True)]

    if kind != ALIGNED:

        @F.pandas_udf(kind)
        def numbers(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for left, right in batches:
                yield pd.Series(rows_of(left, right), dtype="Int32")

        return numbers

    @F.pandas_udf(kind)
    def structs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = ["a", "b", "start_a", "start_b", "score"]
        for left, right in batches:
            yield pd.DataFrame([vars(r) if r else dict.fromkeys(names) for r in rows_of(left, right)], columns=names)

    return structs


def _column(a: Column, b: Column, kind: str, of) -> Column:
    return udf_of(kind, of)(a, b)


def local_align(a: Column, b: Column) -> Column:
    return _column(a, b, ALIGNED, align_local)


def global_align(a: Column, b: Column) -> Column:
    return _column(a, b, ALIGNED, align_global)


def nonmutual_align(a: Column, b: Column) -> Column:
    """``b`` along ``a`` with gaps in ``b`` only; null where ``b`` is longer."""
    return _column(a, b, ALIGNED, lambda p, q: align(p, q, 0, -1, -2, mutual=False) if len(q) <= len(p) else None)


def align_edit_distance(a: Column, b: Column) -> Column:
    return _column(a, b, "int", differing_columns)


def aligned_mismatches(a: Column, b: Column, gaps: bool = True) -> Column:
    """Columns in which two aligned strings differ; without ``gaps``, those of two different bases. Native."""
    places = F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1)))
    one, two = lambda i: F.substring(a, i, F.lit(1)), lambda i: F.substring(b, i, F.lit(1))
    differ = lambda i: (one(i) != two(i)) if gaps else (one(i) != two(i)) & (one(i) != "-") & (two(i) != "-")
    return F.size(F.filter(places, differ)).cast("long")
