"""The manifest against a plain recomputation, and SQL."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from repseq.llm import merkle

def even():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def walk(levels, at, node):
    seen = ""
    for level in levels[:-1]:
        lo = at // 3 * 3
        run = level[lo : lo + 3]
        seen += "".join(x for k, x in enumerate(run) if lo + k != at)
        node = sha("".join([*run[: at - lo], node, *run[at - lo + 1 :]]))
        at //= 3
    return seen, node


def brute(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))):
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r, r["text"]) for r in by[s]]) for s in sources}
    trunk = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            low, node = walk(trees[s], i, leaf(r, text))
            high, node = walk(trunk, k, node)
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], trunk[-1][0], sha(low + high), node, node == trunk[-1][0]))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def test_odd_rows_with_a_clashing_column(odd):
    docs = odd.withColumn("leaf", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("root", F.lit(None))
    got = collected(merkle.manifest(docs, even()))
    assert got == brute([r.asDict() for r in odd.collect()])


@pytest.mark.parametrize(("n", "depth"), [(1, 1), (3, 1), (4, 1), (28, 1), (9, 2), (82, 2)])
def test_levels_and_borders(spark, n, depth):
    rows = [(i, f"a\n{i}", None, f"s{i % (1 + n // 10)}", i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert collected(merkle.manifest(docs, even(), depth=depth)) == brute([r.asDict() for r in docs.collect()])


def test_empty(empty):
    assert collected(merkle.manifest(empty, even())) == []


def test_all_verified_without_tampering(odd):
    assert all(r.verified for r in merkle.manifest(odd).collect())


def test_repeated_rows_and_a_long_text(spark):
    docs = spark.createDataFrame([(2, "same\n", "en", "a", 5)] * 40 + [(4, "x\n" * 3_000_000, "en", None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = collected(merkle.manifest(docs, even(), depth=2))
    assert got == brute([r.asDict() for r in docs.collect()])


def test_query_equals_sql(spark, sf_dir):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = db.sql(merkle.ORACLE)
    assert sorted(map(tuple, merkle.op11_merkle(spark, sf_dir).select(want.columns).collect())) == sorted(want.fetchall())
