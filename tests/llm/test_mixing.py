import math
import random

import pytest

from repseq.llm import mixing as M


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight; hold what is above; share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, held, rest = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in held]
        total = sum(w[s] for s in free)
        out |= {s: rest * w[s] / total for s in free}
        over = [s for s in free if out[s] > most * sizes[s] * (1 + 1e-12)]
        if not over:
            return out
        for s in over:
            out[s] = most * sizes[s]
            held.add(s)
            rest -= out[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_the_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice("abcdeé𝔘zZ") + str(i): int(10 ** rng.uniform(0, 6)) for i in range(11)} | {None: 5, "zero": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in M.source_targets(rows).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    for s in got:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)


def test_odd_texts(odd):
    rows = M.mixed(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.copies <= 3 for r in rows)
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9)


def test_emitted_copies_and_columns(odd, empty):
    clash = odd.selectExpr("*", "1 AS size", "'x' AS copies", "2 AS __size")
    out = M.emit(clash)
    assert out.columns == clash.columns
    assert out.count() == sum(r.copies for r in M.mixed(odd).collect())
    assert M.emit(empty).count() == 0


def test_reruns_agree_and_come_near_the_targets(spark):
    sf = "/root/testdata/sf0.1"
    rows = M.op10_mixing(spark, sf).collect()
    assert sorted(rows) == sorted(M.op10_mixing(spark, sf).collect())
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()}
    taken, target, square = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        square[s] = square.get(s, 0) + r["size"] ** 2
        assert r.taken <= 3 * r["size"]
    for s in taken:
        assert abs(taken[s] - target[s]) <= 4 * 0.5 * square[s] ** 0.5
