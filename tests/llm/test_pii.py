"""Plain identifiers against the patterns themselves; disguised ones by cases and by planting."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from repseq.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digit_right(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            right = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and check_digit_right(digits), "phone": 9 <= len(digits) <= 15}
            if right[kind]:
                out.append((kind, *m.span()))
    return out


def flat(spans):
    return [(k, a, b) for k in pii.KINDS for a, b in spans[k]]


def both(text):
    (base, more), = pii.found(pa.array([text]))
    return flat(base), [(k, text[a:b]) for k, a, b in flat(more)]


@given(st.text(alphabet="aZ0123456789.@+-() _%x\n", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_plain_is_the_patterns(text):
    assert both(text)[0] == brute(text)


@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "a.b@c.d", "1.2.3.4", "0255.1.2.3", "+1 (234) 567-890", ".", "@", " ", "-", "x", "9", "1.2.3.4.5.6.7.8", "a@b.c._x@y.z"]), max_size=6))
@settings(max_examples=800, deadline=None)
def test_plain_side_by_side(parts):
    text = "".join(parts)
    assert both(text)[0] == brute(text)


CASES = [
    ("mail john (at) example (dot) com now", ("email", "john (at) example (dot) com")),
    ("mail john.doe at example dot com now", ("email", "john.doe at example dot com")),
    ("[x] john [at] mail8.example.com", ("email", "john [at] mail8.example.com")),
    ("to john dot smith at gmail dot com today", ("email", "john dot smith at gmail dot com")),
    ("john AT example DOT com", ("email", "john AT example DOT com")),
    ("an.na at mail.example.org, yes", ("email", "an.na at mail.example.org")),
    ("john @ example.com", ("email", "john @ example.com")),
    ("john@gmail dot com", ("email", "john@gmail dot com")),
    ("is jоhn@exаmple.com", ("email", "jоhn@exаmple.com")),
    ("ｊｏ＠ｅｘ．ｃｏ", ("email", "ｊｏ＠ｅｘ．ｃｏ")),
    ("ä jo​hn@ex­ample.com!", ("email", "jo​hn@ex­ample.com")),
    ("call +one five five five one two three four five six seven", ("phone", "+one five five five one two three four five six seven")),
    ("call plus four nine three zero one two three four five six seven.", ("phone", "plus four nine three zero one two three four five six seven")),
    ("+1 (988) five five five 2485 x", ("phone", "+1 (988) five five five 2485")),
    ("ruf plus vier neun drei null eins zwei drei vier fünf an", ("phone", "plus vier neun drei null eins zwei drei vier fünf")),
    ("ip one nine two dot one six eight dot one dot one end", ("ip", "one nine two dot one six eight dot one dot one")),
    ("192 dot 168 dot 0 dot 1", ("ip", "192 dot 168 dot 0 dot 1")),
    ("192[.]168[.]0[.]1", ("ip", "192[.]168[.]0[.]1")),
    ("١٩٢.١٦٨.١.١", ("ip", "١٩٢.١٦٨.١.١")),
    ("four one one one one one one one one one one one one one one one ok", ("card", "four one one one one one one one one one one one one one one one")),
    ("4O41 8949 746O 8795", ("card", "4O41 8949 746O 8795")),
    ("quatre un un un, un un un un, un un un un, un un un un", ("card", "quatre un un un, un un un un, un un un un, un un un un")),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_disguised(text, want):
    base, more = both(text)
    assert (base, more) == ([], [want])


CLEAN = [
    "look at google.com", "meet me at home.Then go at once, at 5.30 at the latest", "she sat at the dot of the i", "the john@mail.com dot next thing", "+1 (988) 555-2485 one of them",
    "one, two, three and four", "version 1.2.3 one", "a point of view at point blank", "le point de vue est un, deux, trois", "null acht neun", "use (at) most five", "4111 1111 1111 1112", "абв с @ г.р",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_gain_nothing(text):
    assert both(text)[1] == []


def test_an_added_span_that_holds_a_plain_one():
    base, more = both("+49 30 123456 seven eight nine")
    assert base == [("phone", 0, 13)]
    assert more == [("phone", "+49 30 123456 seven eight nine")]


def test_planted_spans_in_long_texts():
    random.seed(5)
    filler = [w for w in "the of at one plan dot river été müde acht un point".split()]
    for text, (kind, want) in CASES:
        before = " ".join(random.choices(filler, k=400)) + " ; "
        after = " ; " + " ".join(random.choices(filler, k=400))
        (_, more), = pii.found(pa.array([before + text + after]))
        assert (kind, len(before) + text.index(want), len(before) + text.index(want) + len(want)) in flat(more)


@pytest.mark.parametrize("unit", ["x", "1", "1 ", "+1", "a@", ".", "one ", "at ", "(at)", "a dot ", "1.", "+1 ", "@a.", "о", "​", "1O"])
def test_long_runs_take_linear_time(unit):
    text = unit * (1_000_000 // len(unit))
    (base, more), = pii.found(pa.array([text]))
    assert all(0 <= a < b <= len(text) for _, a, b in [*flat(base), *flat(more)])


def test_rows(spark, odd, empty):
    docs = odd.withColumn("spans", odd["text"]).withColumn("n_email", odd["doc_id"])
    got = pii.personal_data(docs).collect()
    rows = odd.collect()
    assert sorted((r.doc_id is None, r.doc_id, r.base_sha256) for r in got if r.doc_id is not None) == sorted((False, r.doc_id, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute(r.text or "")).encode()).hexdigest()) for r in rows if r.doc_id is not None)
    assert len(got) == len(rows)
    assert pii.personal_data(empty).count() == 0


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = pii.op12_pii(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r.doc_id] or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == w[0] for w in want) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == text and r.n_added == 0
