import re

from repseq.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for w in at.values() if len(w) > 1 for i in w for j in range(i, i + 8)}
    base = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), base


def verdict(text):
    """The production rules, one text at a time."""
    text = text or ""
    n, chars, symbols, dup, _, base = brute(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    bad = 10 * symbols > n or 2 * len(re.findall("[A-Z]", text)) > len(re.findall("[A-Za-z]", text)) or 10 * text.count("!") > 3 * n
    return not (base or bad or 10 * dup > 6 * len(lines) or 2 * n > chars or chars > 30 * n)


def check(rows, texts):
    got = [tuple(r)[1:8] for r in rows]
    want = [(*brute(t), verdict(t)) for t in texts]
    assert sorted(got) == sorted(want)


def test_odd_texts(odd, odd_texts):
    rows = Q.quality_report(odd).drop("failed_rule").collect()
    check(rows, [*odd_texts, odd_texts[3], odd_texts[3], "a row without id", None])


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = Q.op9_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:8] == (*brute(texts[r.doc_id]), verdict(texts[r.doc_id]))


def test_order_never_changes_the_verdict(odd):
    one = Q.filter_quality(odd, Q.BASE + Q.RULES).select("doc_id", "text", "failed_rule").collect()
    two = Q.filter_quality(odd, tuple(reversed(Q.BASE + Q.RULES))).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    assert [r.failed_rule is None for r in sorted(one, key=key)] == [r.failed_rule is None for r in sorted(two, key=key)]


def test_order_is_by_rejection_per_cost():
    import time

    import numpy as np

    def slow(t):
        time.sleep(0.02)
        return np.ones(t.block.n, bool)

    rules = [Q.Rule("slow", slow), Q.Rule("never", lambda t: np.zeros(t.block.n, bool)), Q.Rule("quick", lambda t: np.ones(t.block.n, bool))]
    assert [x[0] for x in Q.measured_order(["a b", None], rules)] == ["quick", "slow", "never"]


def test_empty_table(empty):
    assert Q.quality_report(empty).count() == 0
    assert Q.filter_quality(empty).count() == 0


def test_clean_documents_stay(spark):
    """Documents labelled good that pass the base are kept."""
    sf = "/root/testdata/sf0.01"
    rows = Q.op9_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.2 * len(bad)
