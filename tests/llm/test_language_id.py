import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from repseq.llm import language_id as L


def brute(texts):
    """Interpolated Kneser-Ney by dictionaries: (history, symbol) -> probability."""
    def clean(t):
        out = " " * 4
        for c in t.lower():
            out += c if c.isalpha() else "" if out[-1] == " " else " "
        return out

    counts = [Counter() for _ in range(6)]
    for t in map(clean, texts):
        for i in range(4, len(t)):
            counts[5][t[i - 4 : i + 1]] += 1
    for n in range(4, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    by = [defaultdict(list) for _ in range(6)]
    for n in range(1, 6):
        for g in counts[n]:
            by[n][g[:-1]].append(g)
    vocabulary = len(counts[1]) + 1

    def p(n, g):
        if n == 0:
            return 1 / vocabulary
        own = by[n].get(g[:-1])
        if not own:
            return p(n - 1, g[1:])
        n1, n2 = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        total = sum(counts[n][x] for x in own)
        return max(counts[n].get(g, 0) - d, 0) / total + d * len(own) / total * p(n - 1, g[1:])

    def entropy(t):
        t = clean(t)
        return -sum(math.log(p(5, t[i - 4 : i + 1])) for i in range(4, len(t))), len(t) - 4

    return entropy


TEXTS = ["The cat sat on the mat, the other cat sat 12 times.", "a b a b a abba", "Ένα κείμενο — είναι εδώ", "the mat"]
PROBES = ["the cat's mat", "zzz", "Abba είναι", "1234", "", "İstanbul", "a" * 50]


def test_cross_entropy_equals_the_definition():
    entropy = brute(TEXTS)
    model = L.Identifier(["x"], [L.kneser_ney(*L.count_grams(TEXTS))])
    for probes in (PROBES, list(reversed(PROBES)) * 2):
        total, count = model.sums(probes)
        for t, got, n in zip(probes, total[:, 0], count, strict=True):
            want, size = entropy(t)
            assert n == size
            assert math.isclose(-got, want, rel_tol=1e-4, abs_tol=1e-6)


def test_probabilities_sum_to_one():
    grams, counts = L.count_grams(TEXTS)
    m = L.kneser_ney(grams, counts)
    symbols = sorted({int(s) for s in grams[:, -1]}) + [0x10FFFE]
    for history in [grams[0][:-1], grams[7][:-1], np.array([1, 2, 3, 4], np.uint64), np.array([32, 32, 32, 32], np.uint64)]:
        rows = np.array([[*history.tolist(), s] for s in symbols], np.uint64)
        assert math.isclose(np.exp(m.score(rows)).sum(), 1, rel_tol=1e-4)


def test_long_texts_go_in_pieces(monkeypatch):
    model = L.Identifier(["x"], [L.kneser_ney(*L.count_grams(TEXTS))])
    long = " ".join(TEXTS * 9) + " 123 "
    whole, n = model.sums([long, "mat"])
    monkeypatch.setattr(L, "PIECE", 37)
    pieces, m = model.sums([long, "mat"])
    assert n.tolist() == m.tolist()
    assert np.allclose(whole, pieces, rtol=1e-5)


@pytest.fixture(scope="module")
def result(spark):
    sf = "/root/testdata/sf0.01"
    return L.op5_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()


def test_held_out_accuracy(result):
    held = [r for r in result if r.held_out]
    assert len(result) == 1000 and 150 < len(held) < 350
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in result)


def test_clean_documents_are_not_rejected(result):
    assert sum(r.rejected for r in result) <= 0.01 * len(result)


def test_odd_texts(odd, odd_texts, empty):
    rows = L.predicted(odd.selectExpr("*", "1 AS lang_pred")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id is not None:
            text = odd_texts[r.doc_id] or ""
            assert (r.lang_pred == "und") == (not any(map(str.isalpha, text)))
            assert r.lang_pred in ("und", "en", "de")
    assert L.predicted(empty).count() == 0
    nothing = L.predicted(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_other_scripts_are_rejected(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = L.train(docs, L.learnable())
    strange = ["これは日本語の文章です。" * 20, "Это предложение на русском языке. " * 20, "!!! 123 ???", "qxzj vvkq zzxw jjqk wxqz " * 30]
    assert found.identify(strange)[3].all()
    assert docs.columns == L.recognised(docs).columns


def test_copies_and_long_texts_leave_the_sample_whole(spark):
    line = "the {} cat sat on mat number {} and looked around for more of them, as cats do all day"
    some = [("aa", line.format(i, i * 7)) for i in range(40)]
    long = " ".join(f"ord{i % 97} kaksi{i}" for i in range(6_000))
    rows = [*some, *[("aa", "a copy that is everywhere " * 4)] * 3_000, ("bb", long), ("bb", None), (None, "x")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    found = L.train(docs, F.lit(True), 3_000, 1_000)
    assert found.langs == ["aa", "bb"]
    picked = [(r.lang, r.text) for r in L.sampled(docs, 3_000, 1_000).collect()]
    assert len(picked) == len(set(picked))
    assert sum(len(t) for x, t in picked if x == "aa") > 2_000
    pieces = [t for x, t in picked if x == "bb"]
    assert pieces and all(t in long and len(t) <= 1_000 for t in pieces)
    whole = [r.text for r in L.sampled(docs.where("lang = 'bb'"), len(long) + 1_000, 1_000).collect()]
    assert sorted(whole, key=long.index) == [long[k : k + 1_000] for k in range(0, len(long), 1_000)]
    spread = [long.index(r.text) for r in L.sampled(docs.where("lang = 'bb'"), 10_000, 1_000).collect()]
    assert max(spread) > len(long) / 2


def test_many_languages_share_one_budget(spark):
    rows = [(k, " ".join(f"w{k}{i % 7}{i}" for i in range(40)), f"l{k % 20:02d}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    picked = L.sampled(docs, sample_chars=5_000, total_chars=40_000).collect()
    assert len({r.lang for r in picked}) == 20
    per = {lang: sum(len(r.text) for r in picked if r.lang == lang) for lang in {r.lang for r in picked}}
    assert max(per.values()) <= 3 * 2_000
    assert sum(per.values()) < sum(len(r.text) for r in L.sampled(docs, sample_chars=5_000).collect())


def test_columns_of_its_own_names_stay(spark):
    docs = spark.createDataFrame([(k, "the quick brown fox jumps over the lazy dog again and again", "en", f"x{k}") for k in range(40)], "doc_id long, text string, lang string, lang_pred string")
    out = L.recognised(docs)
    assert out.columns == docs.columns
    assert sorted(r.lang_pred for r in out.collect()) == sorted(f"x{k}" for k in range(40))
