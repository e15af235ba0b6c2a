"""Motif alignment of many reads at once against an alignment cell by cell."""

import random

import numpy as np
import pytest

from repseq.functions import motif as M


def by_cells(seq, motif, threshold, match=2, mismatch=-2, insert=-1, delete=-1):
    """Local alignment of ``seq`` on the codon graph, linear gaps: hits ``(begin, end, score)`` of ``threshold`` or more.

    A cell is the best of zero, a diagonal step, a skipped graph base (``delete``) and an
    extra read base (``insert``), in that order among equals. A cell at the threshold is
    a candidate; it takes the place of the one before it on its path unless that one is better. The ends of the motif
    count as one node, with the best of them at each place. Candidates are listed by node, then
    place; of neighbours in the list with one begin the first best stays.
    """
    letters, before, ends = M.codon_graph(motif)
    n, m = len(letters), len(seq)
    score = np.zeros((n, m + 1), np.int64)
    back: dict[tuple[int, int], tuple[int, int]] = {}
    kept: dict[tuple[int, int], bool] = {}
    for v in range(1, n):
        for j in range(1, m + 1):
            own = match if letters[v] == seq[j - 1] else mismatch
            best, source = 0, None
            for p in before[v]:
                if score[p, j - 1] + own > best:
                    best, source = score[p, j - 1] + own, (p, j - 1)
            for p in before[v]:
                if score[p, j] + delete > best:
                    best, source = score[p, j] + delete, (p, j)
            if score[v, j - 1] + insert > best:
                best, source = score[v, j - 1] + insert, (v, j - 1)
            if source is None:
                continue
            score[v, j] = best
            back[v, j] = source
            if best >= threshold:
                kept[v, j] = True
                if source in kept and score[source] <= best:
                    kept[source] = False
    final: dict[int, int] = {}
    for v, j in sorted(c for c, k in kept.items() if k and c[0] in ends):
        if j not in final or score[v, j] > score[final[j], j]:
            final[j] = v
    inner = sorted(c for c, k in kept.items() if k and c[0] not in ends)
    hits = []
    for v, j in [*inner, *((final[j], j) for j in sorted(final))]:
        at = (v, j)
        while back[at] in back:
            at = back[at]
        hits.append((back[at][1], j - 1, int(score[v, j])))
    out: list[tuple[int, int, int]] = []
    for h in hits:
        if out and out[-1][0] == h[0]:
            if h[2] > out[-1][2]:
                out[-1] = h
        else:
            out.append(h)
    return out


SCORES = [(2, -2, -1, -1), (1, -1, -1, -1), (2, -1, -1, -2), (1, 0, -1, -1), (3, -2, -2, -1), (1, -1, 0, -1), (1, -1, 1, -1), (1, -1, -1, 0)]


@pytest.mark.parametrize("scores", SCORES)
def test_batches_are_cell_by_cell(scores):
    r = random.Random(repr(scores))
    for motif in ["YYC", "WG[KQR]", "W", "*", "[LS]R", "MK[DE]"]:
        for threshold in (M.default_threshold(motif, scores[0], scores[2]), 1, 3, 3 * len(M.parse(motif)) * scores[0] - 3):
            seqs = ["".join(r.choices("ACGT", k=r.choice([0, 1, 5, 20, 40]))) + "TATTATTGT"[: r.randint(0, 9)] + "TGGGGC" * r.randint(0, 1) for _ in range(5)]
            assert M.align_many(seqs, motif, threshold, *scores) == [by_cells(s, motif, threshold, *scores) for s in seqs]


def test_tables_of_a_few_reads_give_the_same(monkeypatch):
    r = random.Random(1)
    seqs = ["".join(r.choices("ACGTN", k=r.randint(0, 300))) for _ in range(40)] + ["é" * 9, ""]
    whole = M.align_many(seqs, "WG[QKR]", 8)
    monkeypatch.setattr(M, "TABLE_BYTES", 50_000)
    assert M.align_many(seqs, "WG[QKR]", 8) == whole
    assert any(whole)
