import math

import numpy as np
import pyarrow as pa
import pytest

from repseq.llm import learning, quality_classifier, toxicity
from repseq.llm.textcore import blocks

SF = "/root/testdata/sf0.1"
CASES = [(quality_classifier.op1_quality_classifier, "quality", quality_classifier, 5, 0), (toxicity.op4_toxicity, "toxic", toxicity, 4, 2)]


@pytest.mark.parametrize(("query", "label", "module", "folds", "held"), CASES, ids=["quality", "toxicity"])
def test_held_out_accuracy(spark, query, label, module, folds, held):
    import zlib

    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    own = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    for y in (0, 1):
        side = [r for r in own if truth[r.doc_id] == y]
        # 4 % of this table's toxic rows are copies whose toxic words are gone, and it has 319 toxic rows to learn from
        assert sum(r.predicted == y for r in side) >= (0.9 if (label, y) == ("toxic", 1) else 0.985) * len(side)


@pytest.mark.parametrize(("query", "label", "module", "folds", "held"), CASES, ids=["quality", "toxicity"])
def test_odd_tables(spark, odd, empty, query, label, module, folds, held):
    some = spark.createDataFrame([(i, i % 2) for i in range(19)] + [(3, 0), (4, 1), (None, 1), (5, None)], f"doc_id long, {label} int")
    rows = module.classified(odd.selectExpr("*", "'x' AS score", "1 AS label"), some).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    for labels in (some.limit(0), some.where(f"{label} = 1")):
        rows = module.classified(odd, labels).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert module.classified(empty, some).count() == 0


def texts(*values):
    return next(iter(blocks(pa.array(values))))


def test_ngrams_are_those_of_the_words():
    keys, text, value = quality_classifier.ngrams(texts("The cat, the cat!", "", "the CAT", "  "))
    assert np.bincount(text, minlength=4).tolist() == [6 + 5 + 4, 0, 2 + 1, 0]
    assert np.allclose(np.bincount(text, value, 4), [20, 0, 20 * 2 / 3, 0])
    a, b = keys[text == 0], keys[text == 2]
    assert a[0] == a[3] == b[0] and a[1] == a[4] == b[1] and a[6] == a[9] == b[2]


def test_follow_the_leader_against_the_plain_formula():
    rows = [(np.array([1, 5]), np.array([1.0, 2.0])), (np.array([5]), np.array([0.5])), (np.array([1, 9]), np.array([3.0, 1.0]))] * 3
    labels = np.array([1, 0, 1] * 3)
    got, bias = quality_classifier.follow_the_leader(rows, labels, epochs=2)
    z, n, zb, nb = {}, {}, 0.0, 0.0
    alpha, beta, l1, l2 = 0.3, 1.0, 0.05, 0.5

    def weight(i):
        if abs(z.get(i, 0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    rng = np.random.default_rng(7)
    for _ in range(2):
        for k in rng.permutation(len(rows)):
            at, x = rows[k]
            w = [weight(i) for i in at]
            b = -zb / ((beta + math.sqrt(nb)) / alpha)
            e = 1 / (1 + math.exp(-(np.dot(w, x) + b))) - labels[k]
            for i, wi, xi in zip(at, w, x, strict=True):
                g, old = e * xi, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * wi
                n[i] = old + g * g
            zb, nb = zb + e - (math.sqrt(nb + e * e) - math.sqrt(nb)) / alpha * b, nb + e * e
    assert np.allclose([got[i] for i in (1, 5, 9)], [weight(i) for i in (1, 5, 9)], rtol=1e-5)
    assert (got != 0).sum() <= 3
    assert math.isclose(bias, -zb / ((beta + math.sqrt(nb)) / alpha), rel_tol=1e-9)


def test_pooling_against_loops():
    rng = np.random.default_rng(1)
    net = toxicity.Net([rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS], None, None, 0.0)
    net.track = True
    x = rng.normal(size=(11, toxicity.DIM)).astype(np.float32)
    firsts = np.array([0, 1, 4, 11])
    best, where = net.pooled(x, firsts)
    for t in range(3):
        own = np.concatenate([x[firsts[t] : firsts[t + 1]], np.zeros((3, toxicity.DIM))])
        for b, bank in enumerate(net.banks):
            for f in range(toxicity.FILTERS):
                answers = [sum(own[i + k] @ bank[k, :, f] for k in range(len(bank))) for i in range(firsts[t + 1] - firsts[t])]
                c = b * toxicity.FILTERS + f
                assert math.isclose(max(answers), best[t, c], rel_tol=1e-4, abs_tol=1e-5)
                assert where[t, c] == firsts[t] + int(np.argmax(answers))


def test_buckets_know_their_key():
    keys = np.array([5 << 44, (5 << 44) + 1, 7 << 44], np.uint64)
    table = toxicity.Table(keys, np.array([[1.0], [2.0], [3.0]]))
    rows = table.rows(np.array([[5 << 44, (5 << 44) + 1, 7 << 44, (7 << 44) + 9, 0]], np.uint64))
    assert table.vectors[rows[0], 0].tolist() == [0, 2, 3, 0, 0]


def test_cut():
    assert learning.best_cut(np.array([0.0, 1, 2, 8, 9]), np.array([0, 0, 0, 1, 1])) == 5
    assert learning.best_cut(np.array([1.0, 1.0]), np.array([1, 1])) == 0
    assert math.isclose(learning.shifted(np.array([5.0]), 5.0)[0], 0.3)


def test_gradients_of_the_toxicity_network_against_finite_differences():
    """One step of Adagrad from a known start moves each weight by its gradient, as differences of the loss give it."""
    rng = np.random.default_rng(11)
    sizes = [1, 2, 3, 5, 9, 4]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    rows = rng.integers(1, 30, (int(firsts[-1]), 3))
    vectors = rng.normal(0, 0.5, (30, toxicity.DIM)).astype(np.float32)
    vectors[0] = 0
    labels = np.array([1, 0, 1, 1, 0, 0])
    start = toxicity.train(rows, firsts, labels, vectors.copy(), epochs=0)
    moved = toxicity.train(rows, firsts, labels, vectors.copy(), epochs=1, step=len(sizes), rate=0.05)
    x = vectors[rows].sum(axis=1).astype(np.float64)

    def loss(banks, bias, out, last):
        net = toxicity.Net([b.astype(np.float64) for b in banks], bias, out, last)
        best, _ = net.pooled(x, firsts)
        z = np.maximum(best + bias, 0) @ out + last
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    own = ([b.astype(np.float64) for b in start.banks], start.bias.astype(np.float64), start.out.astype(np.float64), float(start.last))
    checked = 0
    for part, now in (*((own[0][k], moved.banks[k]) for k in range(len(own[0]))), (own[1], moved.bias), (own[2], moved.out)):
        for at in rng.integers(0, part.size, 40):
            place = np.unravel_index(at, part.shape)
            kept = part[place]
            part[place] = kept + 1e-5
            above = loss(*own)
            part[place] = kept - 1e-5
            below = loss(*own)
            part[place] = kept
            grad = (above - below) / 2e-5
            want = -0.05 * grad / np.sqrt(1e-6 + grad**2)
            if abs(grad) > 1e-4:
                checked += 1
                assert abs((now[place] - kept) - want) < 2e-3, (place, grad)
    assert checked > 40
