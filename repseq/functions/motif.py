"""Protein motifs sought in DNA: a native form for the default scores, and an alignment for any scores."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from repseq.functions.dna import CODONS

MATCH, MISMATCH, INDEL = 2, -2, -1
HITS = "array<struct<begin:int,end:int,score:int>>"


def parse(motif: str) -> list[str]:
    """Residues of a motif: letters, ``*`` for a stop, classes in brackets. ``W[KQR]`` -> ``["W", "KQR"]``."""
    known = set(CODONS.values())
    out = [a or b for a, b in re.findall(r"\[([^\]\[]+)\]|([^\]\[])", motif)]
    plain = "".join(f"[{r}]" if len(r) > 1 else r for r in out)
    if not out or plain != re.sub(r"\[(.)\]", r"\1", motif) or not set("".join(out)) <= known:
        raise ValueError(f"not a motif: {motif!r}")
    return out


def codons_of(residues: str) -> list[str]:
    """All codons of a class, in order."""
    return sorted(c for c, aa in CODONS.items() if aa in residues)


def default_threshold(motif: str, match: int = MATCH, indel: int = INDEL) -> int:
    """The score of an exact motif less (match + indel): an exact motif, or one with an inserted base."""
    return 3 * len(parse(motif)) * match - (match + indel)


def exact_pattern(motif: str) -> str:
    return "".join(f"(?:{'|'.join(codons_of(r))})" for r in parse(motif))


def insertion_pattern(motif: str) -> str:
    """The motif with one base more: inside a codon, or between two."""
    plain = [f"(?:{'|'.join(codons_of(r))})" for r in parse(motif)]
    out = []
    for k, r in enumerate(parse(motif)):
        inside = "|".join(f"{c[0]}.{c[1:]}|{c[:2]}.{c[2]}" for c in codons_of(r))
        own = [f"(?:{inside})"] + ([f".{plain[k]}"] if k else [])
        out += ["".join([*plain[:k], x, *plain[k + 1 :]]) for x in own]
    return "|".join(out)


def scan(seq: Column, motif: str) -> Column:
    """Hits (begin, end inclusive, score) at the default scores and threshold, by begin.

    At each place the exact motif, else the motif with one inserted base; an inserted
    one that ends where an exact one ends is dropped.
    """
    size = 3 * len(parse(motif))
    exact, longer = f"^(?:{exact_pattern(motif)})$", f"^(?:{insertion_pattern(motif)})$"
    is_exact = lambda i: F.substring(seq, i + 1, F.lit(size)).rlike(exact)
    is_longer = lambda i: F.substring(seq, i + 1, F.lit(size + 1)).rlike(longer)

    def hit(i: Column) -> Column:
        of = lambda n, score: F.struct(i.alias("begin"), (i + n - 1).alias("end"), F.lit(score).alias("score"))
        return F.when(is_exact(i), of(size, size * MATCH)).when(is_longer(i) & ~is_exact(i + 1), of(size + 1, size * MATCH + INDEL))

    places = F.sequence(F.lit(0), F.greatest(F.length(seq) - size, F.lit(0)))
    hits = F.filter(F.transform(places, hit), lambda h: h.isNotNull())
    return F.when(F.length(seq) >= size, hits).otherwise(F.array().cast(HITS))


# --- any scores ---------------------------------------------------------------------


def codon_graph(motif: str) -> tuple[list[str], list[list[int]], list[int]]:
    """Nodes in topological order (letter, and numbers of the nodes before it), and those that end the motif: node 0 is the root, each residue a trie of its codons, whose last bases all lead on to the next residue."""
    letters, before = [""], [[]]
    ends = [0]
    for residues in parse(motif):
        last = []
        tree: dict[str, int] = {}
        for codon in codons_of(residues):
            for k in range(1, 4):
                if codon[:k] not in tree:
                    tree[codon[:k]] = len(letters)
                    letters.append(codon[k - 1])
                    before.append(list(ends) if k == 1 else [tree[codon[: k - 1]]])
            last.append(tree[codon])
        ends = last
    return letters, before, ends


#: Bytes of scores that are held at a time.
TABLE_BYTES = 64 << 20


def align_hits(seq: str, motif: str, threshold: int, match: int = MATCH, mismatch: int = MISMATCH, insert: int = INDEL, delete: int = INDEL) -> list[tuple[int, int, int]]:
    """``align_many`` of one sequence."""
    return align_many([seq], motif, threshold, match, mismatch, insert, delete)[0]


def align_many(seqs: Sequence[str], motif: str, threshold: int, match: int = MATCH, mismatch: int = MISMATCH, insert: int = INDEL, delete: int = INDEL) -> list[list[tuple[int, int, int]]]:
    """Local alignment of each sequence on the codon graph, linear gaps: hits ``(begin, end, score)`` of ``threshold`` or more.

    A cell is the best of zero, a diagonal step, a skipped graph base (``delete``) and an
    extra read base (``insert``), in that order among equals. A cell at the threshold is
    a candidate; it takes the place of the one before it on its path unless that one is better. The ends of the motif
    count as one node, with the best of them at each place. Candidates are listed by node, then
    place; of neighbours in the list with one begin the first best stays.

    Sequences go through the graph together, those of like length in one table: a node is a few
    steps over all of their places at once.
    """
    graph = codon_graph(motif)
    order = sorted(range(len(seqs)), key=lambda k: len(seqs[k]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in seqs]
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * (len(seqs[order[hi]]) + 1) * len(graph[0]) * 8 <= TABLE_BYTES:
            hi += 1
        for k, hits in zip(order[lo:hi], _align_table([seqs[k] for k in order[lo:hi]], graph, threshold, match, mismatch, insert, delete), strict=True):
            out[k] = hits
        lo = hi
    return out


def _align_table(seqs: list[str], graph: tuple[list[str], list[list[int]], list[int]], threshold: int, match: int, mismatch: int, insert: int, delete: int) -> list[list[tuple[int, int, int]]]:
    letters, before, ends = graph
    wide = max(map(len, seqs))
    reads = np.zeros((len(seqs), wide), np.uint32)
    for k, s in enumerate(seqs):
        reads[k, : len(s)] = np.frombuffer(s.encode("utf-32-le"), np.uint32)
    place = np.arange(wide + 1, dtype=np.int32)
    inside = place[None, :] <= np.array([len(s) for s in seqs])[:, None]
    shape = (len(seqs), wide + 1)
    #: Of each node: scores, where its paths begin, and its candidates so far.
    score, begin, kept = {0: np.zeros(shape, np.int32)}, {0: np.broadcast_to(place, shape)}, {}
    merged: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for v in range(1, len(letters)):
        key = tuple(before[v])
        if key not in merged:
            merged = {key: _best_of(key, score, begin)}
        top, since, which = merged[key]
        diagonal = np.zeros(shape, np.int32)
        diagonal[:, 1:] = top[:, :-1] + np.where(reads == ord(letters[v]), np.int32(match), np.int32(mismatch))
        skipped = top + np.int32(delete)
        skipped[:, 0] = 0
        by_step = diagonal > 0
        own = np.where(by_step, diagonal, 0)
        by_skip = skipped > own
        own[by_skip] = skipped[by_skip]
        from_ = np.where(by_step, np.pad(since[:, :-1], ((0, 0), (1, 0))), place[None, :])
        from_ = np.where(by_skip, since, from_)
        rise = place * np.int32(insert)
        best = np.maximum.accumulate(own - rise, axis=1) + rise
        by_insert = best > own
        last = np.maximum.accumulate(np.where(by_insert, 0, place), axis=1)
        score[v], begin[v] = best, np.take_along_axis(from_, last, axis=1)
        good = (best >= threshold) & (best > 0) & inside
        if not good.any():
            continue
        kept[v] = good
        i, j = np.nonzero(good)
        at = best[i, j]
        insert_, skip_ = by_insert[i, j], by_skip[i, j] & ~by_insert[i, j]
        source = j - ~skip_
        pred = which[i, np.where(insert_, 0, source)]
        for p in np.unique(pred[~insert_]).tolist():
            mine = ~insert_ & (pred == p)
            _superseded(kept.get(p), score[p], i[mine], source[mine], at[mine])
        _superseded(good, best, i[insert_], source[insert_], at[insert_])
    return _listed(len(seqs), score, begin, kept, ends)


def _best_of(nodes: tuple[int, ...], score: dict[int, np.ndarray], begin: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At each place the first best of some nodes: its score, where its path begins, and its number."""
    top, since, which = score[nodes[0]], begin[nodes[0]], np.full(score[nodes[0]].shape, nodes[0], np.int32)
    for p in nodes[1:]:
        higher = score[p] > top
        top, since, which = np.where(higher, score[p], top), np.where(higher, begin[p], since), np.where(higher, np.int32(p), which)
    return top, since, which


def _superseded(kept: np.ndarray | None, score: np.ndarray, i: np.ndarray, j: np.ndarray, at: np.ndarray) -> None:
    """Cells that a candidate at least as good comes from are none themselves."""
    if kept is not None and len(i):
        no_better = score[i, j] <= at
        kept[i[no_better], j[no_better]] = False


def _listed(n: int, score: dict[int, np.ndarray], begin: dict[int, np.ndarray], kept: dict[int, np.ndarray], ends: list[int]) -> list[list[tuple[int, int, int]]]:
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    last: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(n)]
    for v in sorted(kept):
        for i, j in zip(*(x.tolist() for x in np.nonzero(kept[v])), strict=True):
            hit = (int(begin[v][i, j]), j - 1, int(score[v][i, j]))
            if v not in ends:
                found[i].append(hit)
            elif j not in last[i] or hit[2] > last[i][j][2]:
                last[i][j] = hit
    out = []
    for inner, final in zip(found, last, strict=True):
        own: list[tuple[int, int, int]] = []
        for h in [*inner, *(final[j] for j in sorted(final))]:
            if own and own[-1][0] == h[0]:
                if h[2] > own[-1][2]:
                    own[-1] = h
            else:
                own.append(h)
        out.append(own)
    return out


def scan_general(seq: Column, motif: str, threshold: int | None = None, match: int = MATCH, mismatch: int = MISMATCH, insert: int = INDEL, delete: int = INDEL) -> Column:
    """``align_many`` as a column, each different sequence of a batch aligned once."""
    limit = default_threshold(motif, match, insert) if threshold is None else threshold
    parse(motif)

    @F.pandas_udf(HITS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for given in batches:
            once = [s for s in given.unique() if s is not None]
            known: dict[str | None, list] = {None: []}
            for s, hits in zip(once, align_many(once, motif, limit, match, mismatch, insert, delete), strict=True):
                known[s] = [{"begin": b, "end": e, "score": x} for b, e, x in hits]
            yield pd.Series([known[s] for s in given])

    return run(seq)
