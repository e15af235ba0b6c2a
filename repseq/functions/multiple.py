"""Multiple alignment of the reads of a cluster: k-mer guide tree, profiles aligned to profiles, one round of refinement."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

GAP = "-"
#: Prices of two different letters, and of a letter across a gap, as of the global pairwise alignment.
MISMATCH, INDEL = -1.0, -2.0
#: Letters of a word whose shared number says how near two sequences are; sequences that the guide tree is made for.
WORD, TREE = 6, 300
_NEAR, _SURE = 1e-9, 1e-6


@dataclass
class Profile:
    """Aligned sequences: their numbers, rows of letter codes (0 is the gap), and the weight of each code in each column."""

    members: list[int]
    rows: list[np.ndarray]
    weights: np.ndarray
    total: float


def profile_of(k: int, codes: np.ndarray, weight: float, letters: int) -> Profile:
    w = np.zeros((len(codes), letters))
    w[np.arange(len(codes)), codes] = weight
    return Profile([k], [codes], w, weight)


def steps(a: Profile, b: Profile) -> tuple[np.ndarray, np.ndarray, float]:
    """The best alignment of two profiles: for each of its columns the column of ``a`` and of ``b``, -1 for a gap, and the score.

    A pair of columns costs what its letters cost on average; so does a column across a gap. Of
    equals a pair is preferred to a gap in ``b``, and that to a gap in ``a``, from the end.
    """
    return fewest_gaps(a, b) or steps_by_table(a, b)


def fewest_gaps(a: Profile, b: Profile) -> tuple[np.ndarray, np.ndarray, float] | None:
    """``steps`` of profiles as long as each other or longer by a column, where the best alignment has no gaps but the one that asks for; else None.

    Any other has a gap on either side more. So if even the cheapest of those cost more than what differs, it is not the best.
    """
    n, m = len(a.weights), len(b.weights)
    if abs(n - m) > 1 or not n or not m:
        return None
    fa, fb = a.weights / a.total, b.weights / b.total
    price = np.full((fa.shape[1],) * 2, MISMATCH)
    price[0], price[:, 0] = INDEL, INDEL
    np.fill_diagonal(price, 0)
    pair, gap_a, gap_b = fa @ price, INDEL * (1 - fb[:, 0]), INDEL * (1 - fa[:, 0])
    more = float(gap_a.max() + gap_b.max())
    if n == m:
        score = float((pair * fb).sum())
        return (np.arange(n), np.arange(n), score) if score > more + _SURE else None
    few = min(n, m)
    left = np.concatenate([[0.0], np.cumsum((pair[:few] * fb[:few]).sum(axis=1))])
    right = np.concatenate([[0.0], np.cumsum((pair[n - few :] * fb[m - few :]).sum(axis=1)[::-1])])[::-1]
    gap = gap_b if n > m else gap_a
    score = left + gap + right
    best = float(score.max())
    if best <= float(gap.max()) + more + _SURE:
        return None
    record = np.concatenate([[-np.inf], np.maximum.accumulate(score)[:-1]])
    at = int(np.flatnonzero(score > record + _NEAR)[-1])  # from the end, a pair as long as one before is as good
    whole, part = np.arange(few + 1), np.concatenate([np.arange(at), [-1], np.arange(at, few)])
    return (whole, part, best) if n > m else (part, whole, best)


def steps_by_table(a: Profile, b: Profile) -> tuple[np.ndarray, np.ndarray, float]:
    """``steps`` by a table of all prefixes."""
    fa, fb = a.weights / a.total, b.weights / b.total
    price = np.full((fa.shape[1],) * 2, MISMATCH)
    price[0], price[:, 0] = INDEL, INDEL
    np.fill_diagonal(price, 0)
    pair = fa @ price  # then times the columns of b, a row at a time
    gap_a, gap_b = INDEL * (1 - fb[:, 0]), INDEL * (1 - fa[:, 0])
    n, m = len(fa), len(fb)
    along = np.concatenate([[0], np.cumsum(gap_a)])
    row = along.copy()
    way = np.full((n + 1, m + 1), 2, np.uint8)
    for i in range(1, n + 1):
        base = row + gap_b[i - 1]
        across = row[:-1] + pair[i - 1] @ fb.T
        by_pair = across >= base[1:] - _NEAR
        base[1:] = np.where(by_pair, across, base[1:])
        row = np.maximum.accumulate(base - along) + along
        way[i, 1:] = np.where(row[1:] > base[1:] + _NEAR, 2, np.where(by_pair, 0, 1))
        way[i, 0] = 1
    i, j, left, right = n, m, [], []
    while i or j:
        w = way[i, j]
        i, j = i - (w != 2), j - (w != 1)
        left.append(i if w != 2 else -1)
        right.append(j if w != 1 else -1)
    return np.array(left[::-1], np.int64), np.array(right[::-1], np.int64), float(row[m])


def spread(rows: list[np.ndarray], columns: np.ndarray) -> list[np.ndarray]:
    """Rows in new columns, gaps where there is none."""
    if not rows or len(rows[0]) == len(columns):
        return rows
    return [np.where(columns < 0, np.uint8(0), r[columns]) if len(r) else np.zeros(len(columns), np.uint8) for r in rows]


def joined(a: Profile, b: Profile, at: tuple[np.ndarray, np.ndarray, float] | None = None) -> Profile:
    left, right, _ = at or steps(a, b)
    weights = np.zeros((len(left), a.weights.shape[1]))
    for p, columns in ((a, left), (b, right)):
        own = columns >= 0
        weights[own] += p.weights[columns[own]]
        weights[~own, 0] += p.total
    return Profile(a.members + b.members, spread(a.rows, left) + spread(b.rows, right), weights, a.total + b.total)


def word_distances(codes: list[np.ndarray], letters: int) -> np.ndarray:
    """One less the part of the shorter sequence's words that the other has too."""
    words = []
    for c in codes:
        n = len(c) - WORD + 1
        value = np.zeros(max(n, 0), np.int64)
        for k in range(WORD):
            value = value * letters + c[k : k + n] if n > 0 else value
        words.append(np.unique(value))
    every, at = np.unique(np.concatenate(words), return_inverse=True) if words else (np.zeros(0), np.zeros(0, np.int64))
    has = np.zeros((len(codes), max(len(every), 1)), np.float32)
    has[np.repeat(np.arange(len(codes)), [len(w) for w in words]), at] = 1
    size = np.maximum(has.sum(axis=1), 1)
    return 1 - (has @ has.T) / np.minimum(size[:, None], size[None, :])


def guide(distance: np.ndarray) -> list[tuple[int, int]]:
    """Pairs to join, nearest mean distance first (of equals the first by place); the joined one stands where its first did."""
    n = len(distance)
    d = distance.astype(np.float64).copy()
    np.fill_diagonal(d, np.inf)
    size = np.ones(n)
    out = []
    for _ in range(n - 1):
        i, j = sorted(divmod(int(d.argmin()), n))
        out.append((i, j))
        mean = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        mean[[i, j]] = np.inf
        d[i], d[:, i] = mean, mean
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
    return out


def refined(whole: Profile, order: Sequence[int], weights: Sequence[float]) -> Profile:
    """Each sequence in turn is taken out and aligned to the rest again; the new alignment stays where it scores higher."""
    for k in order:
        at = whole.members.index(k)
        own, others = whole.rows[at], [r for x, r in enumerate(whole.rows) if x != at]
        rest = whole.weights.copy()
        rest[np.arange(len(own)), own] -= weights[k]
        total = whole.total - weights[k]
        filled = rest[:, 1:].sum(axis=1) > _NEAR
        other = Profile([m for m in whole.members if m != k], others if filled.all() else [r[filled] for r in others], rest[filled], total)
        alone = profile_of(k, own[own > 0], weights[k], rest.shape[1])
        found = steps(other, alone)
        place = np.cumsum(filled) - 1, np.cumsum(own > 0) - 1
        used = filled | (own > 0)
        now = _score(other, alone, np.where(filled, place[0], -1)[used], np.where(own > 0, place[1], -1)[used])
        if found[2] > now + _NEAR:
            whole = joined(other, alone, found)
    return whole


def _score(a: Profile, b: Profile, left: np.ndarray, right: np.ndarray) -> float:
    fa, fb = a.weights / a.total, b.weights / b.total
    price = np.full((fa.shape[1],) * 2, MISMATCH)
    price[0], price[:, 0] = INDEL, INDEL
    np.fill_diagonal(price, 0)
    both = (left >= 0) & (right >= 0)
    score = float(np.einsum("ix,xy,iy->", fa[left[both]], price, fb[right[both]]))
    return score + float((INDEL * (1 - fa[left[right < 0], 0])).sum() + (INDEL * (1 - fb[right[left < 0], 0])).sum())


def letters_of(seqs: Sequence[str]) -> list[str]:
    """Letters in order; the code of one is its place from 1."""
    return sorted(set("".join(seqs)) - {GAP})


def aligned(seqs: Sequence[str], weights: Sequence[float], letters: Sequence[str]) -> Profile:
    """The alignment of weighted sequences, one at least.

    The ``TREE`` heaviest (of equals the least) are joined along a guide tree of mean
    distances between their words; the rest are added to the profile one by one. Then each is once taken out and
    aligned again. Sequences may repeat; empty ones are all gaps.
    """
    code = {c: k + 1 for k, c in enumerate(letters)}
    codes = [np.array([code[c] for c in s if c != GAP], np.uint8 if len(letters) < 255 else np.uint32) for s in seqs]
    order = sorted(range(len(seqs)), key=lambda k: (-weights[k], seqs[k], k))
    first, later = order[:TREE], order[TREE:]
    held = [profile_of(k, codes[k], float(weights[k]), len(letters) + 1) for k in first]
    for i, j in guide(word_distances([codes[k] for k in first], len(letters) + 1)):
        held[i] = joined(held[i], held[j])
    whole = held[0]
    for k in later:
        whole = joined(whole, profile_of(k, codes[k], float(weights[k]), len(letters) + 1))
    return refined(whole, order, [float(w) for w in weights]) if len(seqs) > 2 else whole


def progressive_alignment(seqs: Sequence[str], weights: Sequence[float]) -> list[str]:
    """Strings of one length, in the order given: the rows of ``aligned``."""
    if not seqs:
        return []
    letters = letters_of(seqs)
    whole = aligned(seqs, weights, letters)
    table = np.array([GAP, *letters])
    out = [""] * len(seqs)
    for k, row in zip(whole.members, whole.rows, strict=True):
        out[k] = "".join(table[row])
    return out


def heaviest(profile: Profile, letters: Sequence[str]) -> str:
    """The heaviest letter of each column, gaps counted as one and then left out; of equals a letter, the least."""
    turned = np.hstack([profile.weights[:, 1:], profile.weights[:, :1]])  # the gap last
    best = turned.argmax(axis=1)
    return "".join(letters[k] for k in best.tolist() if k < len(letters))
