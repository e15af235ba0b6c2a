import re
from itertools import combinations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from repseq.llm import simhash as S


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def kept_by_brute_force(docs):
    """(doc_id, text) that stay, by comparing all pairs of sets."""
    sets = sorted({shingles(t) for _, t in docs}, key=lambda s: sorted(s))
    up = {s: s for s in sets}

    def root(s):
        while up[s] != s:
            s = up[s]
        return s

    n_pairs = 0
    for a, b in combinations(sets, 2):
        if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) > 0 and 9 * len(a & b) >= 4 * (len(a) + len(b)):
            n_pairs += 1
            up[root(a)] = root(b)
    low = {}
    for d, t in docs:
        r = root(shingles(t))
        low[r] = min(d, low.get(r, d))
    return {low[r] for r in low}, n_pairs


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_stage_leaves_no_near_copy_of_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, n_pairs = kept_by_brute_force([(r.doc_id, r.text) for r in docs.collect()])
    got = [r.doc_id for r in corpus_pipeline.deduplicate(spark, docs, sf).collect()]
    assert n_pairs and len(got) == len(set(got)) and set(got) == want


def test_similarity_at_the_edge(spark):
    words = [f"w{i}" for i in range(94)]  # 90 shingles
    changed = lambda k: " ".join([*words[: 94 - k], *(f"z{i}" for i in range(k))])
    # k words changed at the end: 90 - k shared of 90 + k
    docs = [(1, " ".join(words)), (2, changed(10)), (3, changed(11).upper()), (9, " ".join(words[:4])), (8, "W0  w1 w2\tw3"), (7, None), (6, " ")]
    got = S.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    # 80 of 100 links 1 and 2; 79 of 101 with 1 is too little, and 3 differs from 2 by all its last words but the shift
    assert {r.doc_id for r in got.collect()} == kept_by_brute_force(docs)[0]
    only = spark.createDataFrame([docs[0], docs[1]], "doc_id long, text string")
    assert [r.doc_id for r in S.one_of_each(only).collect()] == [1]
    only = spark.createDataFrame([docs[0], docs[2]], "doc_id long, text string")
    assert S.one_of_each(only).count() == 2


def test_near_copies_of_one_large_group(spark):
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join([*words[: 3 * (i % 60)], f"x{i}", *words[3 * (i % 60) + 1 :]])) for i in range(120)] + [(500 + i, f"some other text number {i} of its own here") for i in range(40)]
    got = {r.doc_id for r in S.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == kept_by_brute_force(docs)[0] and 0 in got and len(got) < 120
    assert S.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).select("component_id").distinct().agg(F.count("*")).first()[0] == len(got)


def test_different_texts_of_one_doc_id_are_decided_each(spark):
    docs = spark.createDataFrame([(3, "A"), (5, "A"), (5, "B"), (5, "B"), (None, "A")], "doc_id long, text string")
    assert sorted(((r.doc_id or 0), r.text) for r in S.one_of_each(docs).collect()) == [(0, "A"), (3, "A"), (5, "B")]
