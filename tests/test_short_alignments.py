"""Alignments of sequences that hardly differ, without a table: the same as with one."""

import random

import numpy as np

from repseq.functions import align, multiple
from repseq.operators import consensus


def changed(r, s, subs, drop):
    s = list(s)
    for k in r.sample(range(len(s)), subs):
        s[k] = r.choice("ACG")
    for _ in range(drop):
        del s[r.randrange(len(s))]
    return "".join(s)


def test_pairs_of_strings():
    r, short = random.Random(1), 0
    for _ in range(600):
        s = "".join(r.choices("AC" if r.random() < 0.5 else "ACGT", k=r.randint(4, 14)))
        a, b = (changed(r, s, r.randint(0, 3), r.randint(0, 1)) for _ in range(2))
        got = align.fewest_gaps(a, b)
        short += got is not None
        assert (got or align.align_global(a, b)) == align.align(a, b, 0, -1, -2)
    assert short > 400 and align.fewest_gaps("", "") == align.align("", "", 0, -1, -2)


def test_pairs_of_profiles():
    r, short = random.Random(2), 0
    for _ in range(600):
        s = "".join(r.choices("AC" if r.random() < 0.5 else "ACGT", k=r.randint(4, 14)))
        rows = [changed(r, s, r.randint(0, 2), int(r.random() < 0.4)) for _ in range(r.randint(2, 5))]
        letters, weights = multiple.letters_of(rows), [r.choice([1, 2, 9, 30]) for _ in rows]
        cut = r.randint(1, len(rows) - 1)
        code = {c: k + 1 for k, c in enumerate(letters)}

        def whole(ks):
            held = [multiple.profile_of(k, np.array([code[c] for c in rows[k]], np.uint8), weights[k], len(letters) + 1) for k in ks]
            for p in held[1:]:
                held[0] = multiple.joined(held[0], p, multiple.steps_by_table(held[0], p))
            return held[0]

        a, b = whole(range(cut)), whole(range(cut, len(rows)))
        got, want = multiple.fewest_gaps(a, b), multiple.steps_by_table(a, b)
        if got is not None:
            short += 1
            assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist() and abs(got[2] - want[2]) < 1e-9
    assert short > 300


def test_consensus_is_the_plurality_of_rows_and_needs_no_table(monkeypatch):
    r = random.Random(3)
    for _ in range(60):
        core = "".join(r.choices("ACGT", k=40))
        seqs = sorted({core} | {changed(r, core, r.randint(0, 2), r.randint(0, 2)) for _ in range(4)})
        weights = [r.choice([1, 3, 20]) for _ in seqs]
        if len(seqs) > 1:
            assert consensus.consensus_of(seqs, weights) == consensus.plurality(multiple.progressive_alignment(seqs, weights), weights)
    monkeypatch.setattr(multiple, "steps_by_table", None)
    core = "".join(r.choices("ACGT", k=250))
    assert consensus.consensus_of([core, core[:41] + core[42:], core[:176] + "A" + core[177:]], [9, 1, 1]) == core


def test_two_reads_that_hardly_differ_need_no_table(monkeypatch):
    monkeypatch.setattr(align, "matrix", None)
    assert consensus.pair_consensus("ACGT" * 6, "ACGT" * 5 + "ACCT", ["ACGTACGTACC", "CGTACGTACCT"]) == "ACGT" * 5 + "ACCT"
    assert consensus.pair_consensus("ACGT", "AGT", []) == "ACGT"
