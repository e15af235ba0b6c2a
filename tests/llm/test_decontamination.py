import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from repseq.llm import decontamination as D
from repseq.llm.textcore import blocks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        sought = words(body)
        for i in range(max(1, len(sought) - 9) if sought else 0):
            window = sought[i : i + 10]
            for j in range(len(own) - len(window) + 1):
                if own[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    found.add(item)
    ids = ",".join(sorted(found))
    return len(own), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def as_items(benchmark):
    return [("" if r.item_id is None else str(r.item_id), r.text) for r in benchmark.collect()]


@pytest.mark.parametrize("pass_bytes", [D.PASS_BYTES, 1500])
def test_documents(spark, sf_dir, pass_bytes):
    docs, benchmark = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = as_items(benchmark)
    rows = {r.doc_id: tuple(r)[1:] for r in D.digest(docs, benchmark, pass_bytes=pass_bytes).collect()}
    want = {r.doc_id: brute(r.text, items) for r in docs.collect()}
    assert rows == want
    assert any(r[4] for r in rows.values())


def odd_benchmark(spark, odd_texts):
    items = [(1, "one"), (10, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16"), (2, None), (3, " . "), (None, "the same line"), (1, "again and AGAIN for"), (7, "äpfel UND"), (1, "one"), (8, "cd efgh")]
    return spark.createDataFrame(items, "item_id long, text string")


def test_odd_texts(spark, odd, odd_texts):
    benchmark = odd_benchmark(spark, odd_texts)
    items = as_items(benchmark)
    short = odd.where("text IS NULL OR length(text) < 60000")
    rows = D.digest(short, benchmark).collect()
    want = [(r.doc_id, *brute(r.text, items)) for r in short.collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert D.digest(odd, benchmark).count() == odd.count()


def test_empty_tables(spark, odd, odd_texts, empty):
    benchmark = odd_benchmark(spark, odd_texts)
    assert D.digest(empty, benchmark).count() == 0
    rows = D.digest(odd, benchmark.limit(0)).collect()
    assert len(rows) == odd.count() and not any(r.contaminated for r in rows)
    assert {r.items_sha256 for r in rows} == {D.EMPTY_SHA256}


@pytest.mark.parametrize("pass_bytes", [D.PASS_BYTES, 40])
def test_nothing_is_left_and_clean_texts_stay(spark, odd, odd_texts, pass_bytes):
    benchmark = odd_benchmark(spark, odd_texts)
    items = as_items(benchmark)
    nested = spark.createDataFrame([(99, "keep again and again and again for for for tail", None, None, 46)], odd.schema)
    docs = odd.where("text IS NULL OR length(text) < 60000").unionAll(nested)
    clash = docs.selectExpr("*", "1 AS hit_spans", "2 AS n_words")
    out = D.decontaminated(clash, benchmark, pass_bytes=pass_bytes)
    assert out.columns == clash.columns
    rows = out.collect()
    before = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert len(rows) == docs.count()
    for r in rows:
        assert brute(r.text, items)[1] == 0
        if r.doc_id is not None and brute(before[r.doc_id], items)[1] == 0:
            assert r.text == before[r.doc_id]
        elif r.doc_id is not None:
            assert r.n_chars == len(r.text)


@pytest.mark.parametrize("seed", range(6))
def test_index(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(1, [3, 5, 40, 4, 2, 300][seed], [60, 400, 900, 50, 33, 2000][seed]), 0)
    if seed == 3:
        text = np.append(np.tile(text[:-1], 5), 0)
    assert D.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = D.FMIndex(text, rate=3)
    assert sorted(index.locate(np.arange(len(text))).tolist()) == list(range(len(text)))
    r = random.Random(seed)
    patterns = [text[i : i + r.randrange(1, 5)].tolist() for i in range(0, len(text) - 6, 7)] + [[1, 1, 1, 1], [2, -1]]
    table = np.array([p + [-1] * (4 - len(p)) for p in patterns])
    lengths = np.array([len(p) for p in patterns])
    lo, hi = index.search(table, lengths)
    for p, a, b in zip(patterns, lo, hi, strict=True):
        at = sorted(index.locate(np.arange(a, max(a, b))).tolist())
        assert at == [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)].tolist() == p]


def test_long_texts_are_searched_in_overlapping_pieces():
    rng = random.Random(5)
    words = [f"w{rng.randrange(40)}" for _ in range(3_000)]
    items = [(k, " ".join(words[i : i + n])) for k, (i, n) in enumerate([(0, 14), (700, 30), (2_990, 10), (1_500, 4), (2_000, 10)])] + [(9, "never there")]
    sought, text = D.phrases(items), " ".join(words)
    block = next(blocks(pa.array([text])))
    whole = D.find(block, sought)
    for most in (20, 64, 200, 1_000, len(text) - 1):
        cut = D.find(block, sought, most=most)
        assert (cut.hit == whole.hit).all() and cut.items.tolist() == whole.items.tolist() and set(cut.texts.tolist()) == {0}


def test_text_of_more_different_words_than_21_bits():
    words = [f"{i:x}" for i in range(2_200_000)]
    for at in (0, 1_048_570, 2_199_980):
        words[at : at + 12] = [f"planted{k}" for k in range(12)]
    found = D.find(next(blocks(pa.array([" ".join(words)]))), D.phrases([("a", " ".join(f"planted{k}" for k in range(12)))]))
    assert found.hit.nonzero()[0].tolist() == [at + k for at in (0, 1_048_570, 2_199_980) for k in range(12)]
