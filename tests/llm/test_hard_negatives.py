"""Hard negatives against brute force with small passes and bins, and SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from repseq.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def flip():
    return F.pmod(F.col("vec_id"), F.lit(7)) == 0


def anchor():
    return F.pmod(F.col("vec_id"), F.lit(100)) == 0


def brute(rows):
    taking = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taking.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a in {(i, label, tuple(v)) for i, label, v in taking if i % 100 == 0}:
        scored = sorted((-sum(p * q for p, q in zip(a[2], v, strict=True)), i, label) for i, label, v in taking if i != a[0] and len(v) == len(a[2]))
        for ps, pid, label in [s for s in scored if s[2] == a[1]][:5]:
            negatives = [(s, i) for s, i, label in scored if label != a[1] and 30 * -ps <= 100 * -s <= 90 * -ps][:10]
            out += [(a[0], pid, k, i, -ps, -s) for k, (s, i) in enumerate(negatives, 1)]
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, dim, spread, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    return [(i, (centres[i % 5] * spread + rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_small_passes_and_bins(spark, spread):
    rows = vectors(1200, 6, spread)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = H.hard_negatives(H.prepared(df, flip()), anchor(), chunk=5, sample_rows=40, pivots=4, size=8)
    want = brute([(i, [float(x) for x in v], c) for i, v, c in rows])
    assert collected(got) == want and want


def test_odd_rows_ties_and_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(i, [1.0, 2.0, 0.5], i % 3) for i in range(0, 420)]  # ties everywhere
    rows += [(i, [rng.uniform(-2, 2) for _ in range(2)], 1) for i in range(1000, 1150)]
    rows += [(i, [rng.uniform(-2, 2) for _ in range(2)], 2) for i in range(1150, 1300)]
    rows += [(None, [1.0, 2.0, 0.5], 1), (500, None, 1), (600, [None, 1.0, 1.0], 1), (700, [float("nan")] * 3, 1), (800, [float("inf"), 0.0, 0.0], 1), (900, [1.0] * 3, None), (1400, [], 1), (1401, [], 2), (1402, [], 1), (1500, [9.0], 1)]
    rows += [rows[100], rows[101], rows[200]]  # repeated
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("x")).withColumn("length", F.lit(-1)).withColumn("n", F.lit(None))
    assert collected(H.hard_negatives(H.prepared(df, flip()), anchor(), chunk=2, size=16, sample_rows=30)) == brute(rows)


def test_large_numbers_are_exact(spark):
    rows = [(i, [float(np.float32(3e5 + i)), float(np.float32(2e5 - 3 * i))], i % 2) for i in range(0, 210)]
    rows.append((300, [3e38, 1.0], 1))  # its scores do not fit: it takes no part
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(H.hard_negatives(H.prepared(df, flip()), anchor())) == brute(rows[:-1])


def test_brackets_hold_every_score():
    rng = np.random.default_rng(1)
    v = rng.integers(-400, 400, (300, 8))
    p = H.Pivots(float((v**2).sum(axis=1).max()))
    p.at[8] = H.farthest_first(p.augmented(v[:50]), 6)
    far = p.distances(p.augmented(v))
    q = rng.integers(-400, 400, (20, 8))
    score = q @ v.T
    for low, high in ((0, 50_000), (100_000, 10**9), (-(10**9), -100_000)):
        s = H.Sought(np.arange(20), np.arange(20), np.zeros(20, int), q, np.full((20, 1), low), np.full((20, 1), high), p.distances(np.hstack([q, np.zeros((20, 1))])), 5, True)
        reach = s.reach(p, far, far)  # bins of one row
        assert reach[(score >= low) & (score <= high)].all()
        assert low < 0 or not reach.all()


def test_empty_and_without_anchors(spark):
    assert collected(H.hard_negatives(H.prepared(spark.createDataFrame([], SCHEMA)), anchor())) == []
    assert collected(H.hard_negatives(H.prepared(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)), anchor())) == []
    assert collected(H.hard_negatives(H.prepared(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)), anchor())) == []


def test_query_equals_sql(spark, sf_dir):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted(db.sql(H.ORACLE).fetchall())
    assert collected(H.op13_hard_negatives(spark, sf_dir)) == want and want
