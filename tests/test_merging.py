"""Merging of variants, one against many, against the pairs one by one."""

import random

import numpy as np
import pytest

from repseq.functions.align import differing_columns, levenshtein_to, levenshtein_within, substitutions
from repseq.functions.multiple import aligned, heaviest, joined, letters_of
from repseq.operators import correct


def mutated(r, core, k, letters="ACGT"):
    s = list(core)
    for _ in range(k):
        what, at = r.randint(0, 2), r.randrange(len(s) + 1)
        if what == 0:
            s.insert(at, r.choice(letters))
        elif at < len(s):
            if what == 1:
                s[at] = r.choice(letters)
            else:
                del s[at]
    return "".join(s) or "A"


def pair_by_pair(reads, ratio, limit):
    members = {}
    for cdr, seq, qty in sorted(reads):
        members.setdefault(cdr, []).append((seq, qty))
    weight = {c: sum(q for _, q in m) for c, m in members.items()}
    into = {c: c for c in members}
    letters, profiles = letters_of([s for m in members.values() for s, _ in m]), {}
    consensus = lambda c: heaviest(profiles[c], letters)
    for same in (lambda a, b: substitutions(a, b) == 0, lambda a, b: differing_columns(consensus(a), consensus(b)) <= limit):
        profiles = {c: aligned([s for s, _ in m], [q for _, q in m], letters) for c, m in members.items()}
        order, gone = sorted(members, key=lambda c: (-weight[c], c)), set()
        for i, c1 in enumerate(order):
            for c2 in order[i + 1 :]:
                if c1 in gone:
                    break
                if c2 in gone or not same(c1, c2):
                    continue
                heavy = weight[c1] / weight[c2] >= ratio or len(c1) % 3 == 0 or len(c2) % 3
                stays, goes = (c1, c2) if heavy else (c2, c1)
                members[stays] += members.pop(goes)
                profiles[stays] = joined(profiles[stays], profiles.pop(goes))
                weight[stays] += weight.pop(goes)
                gone.add(goes)
                into = {c: stays if t == goes else t for c, t in into.items()}
    return into


@pytest.mark.parametrize("letters", ["AC", "ACGT"])
def test_predicates(letters):
    r = random.Random(letters)
    for _ in range(60):
        core = "".join(r.choices(letters, k=r.randint(1, 16)))
        seqs = sorted({mutated(r, core, r.randint(0, 8), letters) for _ in range(10)})
        rows = correct.Rows(seqs)
        for k in range(len(seqs)):
            others = np.array([j for j in range(len(seqs)) if j != k], np.int64)
            assert correct.alike_but_gaps(rows, k, others).tolist() == [substitutions(seqs[k], seqs[j]) == 0 for j in others]
            assert correct.near_in_columns(rows, k, others, 3).tolist() == [differing_columns(seqs[k], seqs[j]) <= 3 for j in others]
            assert [levenshtein_within(seqs[k], seqs[j], 3) for j in others] == [bool(d <= 3) for d in levenshtein_to(seqs[k], [seqs[j] for j in others])]


@pytest.mark.parametrize(("ratio", "limit"), [(2.0, 4), (1.5, 2), (10.0, 0)])
def test_merges(ratio, limit):
    r = random.Random(ratio)
    merged = 0
    for _ in range(15):
        core, before = ("".join(r.choices("ACGT", k=k)) for k in (24, 30))
        reads = {}
        for _ in range(r.randint(1, 22)):
            cdr = mutated(r, core, r.randint(0, 3))
            reads[cdr, mutated(r, before, r.choice([0, 0, 1, 3])) + cdr] = r.choice([1, 1, 1, 2, 5, 9])
        rows = [(c, s, q) for (c, s), q in reads.items()]
        got = correct.merge_variants(rows, ratio, limit)
        assert got == pair_by_pair(rows, ratio, limit)
        merged += len(got) - len(set(got.values()))
    assert merged > 0
    assert correct.merge_variants([], ratio, limit) == {}
