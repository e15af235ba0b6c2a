import random
import re
from collections import Counter

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from repseq.llm import simhash as S
from repseq.llm.textcore import blocks


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps):
    """fp -> its component, by comparing all pairs."""
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, f in enumerate(fps):
        for g in fps[:i]:
            if (f ^ g).bit_count() <= 2:
                up[root(f)] = root(g)
    return {f: root(f) for f in fps}


def check(rows, docs):
    want = {d: fingerprint(t) for d, t in docs}
    part = components(want.values())
    low = {}
    for d, f in want.items():
        if d is not None:
            low[part[f]] = min(d, low.get(part[f], d))
    for r in rows:
        assert r.fingerprint == f"{want[r.doc_id]:016x}"
        assert r.component_id == low.get(part[want[r.doc_id]])


def test_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = S.op8_simhash(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    check(rows, docs)


def test_odd_texts(odd):
    named = odd.where("doc_id IS NOT NULL")
    docs = [(r.doc_id, r.text) for r in named.collect()]
    rows = S.near_duplicates(named).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert S.near_duplicates(odd).count() == odd.count()


def test_empty_table(empty):
    assert S.near_duplicates(empty).count() == 0
    assert S.one_of_each(empty).count() == 0


def test_one_of_each_group_stays(spark, odd):
    kept = S.one_of_each(odd)
    assert kept.columns == odd.columns
    groups = {r.doc_id: r.component_id for r in S.near_duplicates(odd).collect() if r.doc_id is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(i for i in ids if i is not None) == Counter(set(groups.values()))
    assert ids.count(None) == 2


def planted(seed):
    rng = random.Random(seed)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        g = f
        for _ in range(rng.randrange(1, 8)):
            g ^= 1 << rng.randrange(64)
            fps.add(g)
    centre = rng.getrandbits(64)
    for _ in range(250):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    return sorted(fps | {0, 3})


@pytest.mark.parametrize("hot", [0, 3, 1000])
@pytest.mark.parametrize("most", [None, (0, 0, 0), (1, 0), (2,), (-1, 1, 0), (0, -1, 0, 0)])
def test_links_reach_all_pairs(spark, hot, most):
    fps = planted(7)
    table = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    if most is None:
        parts = S.plan(table)
        assert sum(p.most + 1 for p in parts) == 3
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
    else:
        size = 64 // len(most)
        parts = [S.Part(tuple(range(i * size, 64 if i == len(most) - 1 else (i + 1) * size)), t) for i, t in enumerate(most)]
    edges = S.links(table, parts, hot=hot)
    wanted = components(fps)
    unsigned = F.col("node")
    got = S.connected_components(edges).select(unsigned.alias("n"), "component").collect()
    group = {r.n % (1 << 64): r.component for r in got}
    assert len({(wanted[f], group.get(f, f)) for f in fps}) == len(set(wanted.values())) == len({group.get(f, S._signed(f)) for f in fps})


def test_allocation_is_unequal_where_parts_are():
    differ = [[0.5] * 16, [0.5] * 16, [0.5] * 16, [0.02] * 16]
    cost, most = S.allocate(1e6, [2**-16, 2**-16, 2**-16, 0.7], differ)
    assert most == [0, 0, 0, -1]
    _, most = S.allocate(1e9, [1e-9, 0.9], [[0.5] * 32, [0.01] * 32])
    assert most == [2, -1]


@pytest.mark.parametrize("most", [1, 2, 7, 1000])
def test_shingles_hashed_some_at_a_time(most):
    texts = ["a b c d e f g", "", "x", "one two", "A  b\tc \n d", None, "z " * 40]
    block = next(blocks(pa.array(texts)))
    hashes, offs = S.shingle_hashes(block, most=most)
    for k, text in enumerate(texts):
        words = (text or "").lower().split()
        want = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        assert hashes[offs[k] : offs[k + 1]].tolist() == want
