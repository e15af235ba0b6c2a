"""Average linkage against its definition; multiple alignment on planted clusters; the edit join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from repseq.functions.align import levenshtein_to
from repseq.functions.multiple import progressive_alignment
from repseq.operators import cluster, simjoin
from repseq.operators.consensus import consensus_of, plurality, star_alignment


def by_definition(seqs, cutoff):
    n = len(seqs)
    dist = [levenshtein_to(s, list(seqs)).tolist() for s in seqs]
    own = [[i] for i in range(n)]
    while True:
        best = None
        for i in range(n):
            for j in range(i + 1, n):
                if own[i] and own[j]:
                    mean = sum(dist[a][b] for a in own[i] for b in own[j]) / (len(own[i]) * len(own[j]))
                    if mean <= cutoff and (best is None or mean < best[0]):
                        best = (mean, i, j)
        if best is None:
            break
        _, i, j = best
        own[i] += own[j]
        own[j] = []
    label = {k: i for i, c in enumerate(own) for k in c}
    number = {c: k for k, c in enumerate(dict.fromkeys(label[k] for k in range(n)))}
    return [number[label[k]] for k in range(n)]


@pytest.mark.parametrize("cutoff", [0.5, 1, 2.5, 3, 4])
def test_linkage_is_its_definition(cutoff):
    r = random.Random(cutoff)
    for t in range(40):
        seqs = sorted({"".join(r.choices("AC" if t % 2 else "ACGT", k=r.randint(3, 9))) for _ in range(r.randint(1, 20))})
        assert cluster.average_linkage(seqs, cutoff) == by_definition(seqs, cutoff)


def test_linkage_of_a_large_dense_group():
    """Pairs are given; 1,500 sequences are three clusters, 3 edits apart in each, 9 between."""
    n = 1500
    kind = np.arange(n) % 3
    a, b = np.triu_indices(n, 1)
    near = kind[a] == kind[b]
    label = cluster.average_linkage([f"{k:04d}" for k in range(n)], 4.0, (a[near], b[near], np.full(int(near.sum()), 3)))
    assert label == kind.tolist()


def test_hierarchical_cluster_rows(spark):
    r = random.Random(3)
    rows = {(g, "".join(r.choices("ACG", k=r.randint(4, 9)))) for g in ("x", "y", None) for _ in range(25)} | {("z", "ACGTACGT")}
    df = spark.createDataFrame([(g, "c", s, k) for k, (g, s) in enumerate(sorted(rows, key=repr))], "sample string, cluster string, seq string, part_of long")
    got = {(x.sample, x.seq): x.part for x in cluster.hierarchical_cluster(df, 2.5).collect()}
    for g in ("x", "y", "z", None):
        seqs = sorted(s for own, s in rows if own == g)
        label = by_definition(seqs, 2.5)
        first = {}
        for c, s in zip(label, seqs, strict=True):
            first.setdefault(c, s)
        assert [got[g, s] for s in seqs] == [first[c] for c in label]


def test_no_edges_and_no_rows(spark):
    df = spark.createDataFrame([("a", "c", "AAAA"), ("a", "c", "TTTTTTTT")], "sample string, cluster string, seq string")
    assert sorted(map(tuple, cluster.hierarchical_cluster(df).select("seq", "part").collect())) == [("AAAA", "AAAA"), ("TTTTTTTT", "TTTTTTTT")]
    assert cluster.hierarchical_cluster(df, 0.5).where("seq <> part").count() == 0
    assert cluster.hierarchical_cluster(df.where("false")).count() == 0


def mutated(r, core, subs, indels):
    s = list(core)
    for _ in range(subs):
        s[r.randrange(len(s))] = r.choice("ACGT")
    for _ in range(indels):
        k = r.randrange(len(s))
        if r.random() < 0.5:
            del s[k]
        else:
            s.insert(k, r.choice("ACGT"))
    return "".join(s)


@pytest.mark.parametrize(("subs", "indels", "reads", "least", "lead"), [(1, 2, 9, 38, -1), (1, 3, 9, 38, 2), (2, 4, 12, 38, 5), (3, 6, 15, 34, 12)])
def test_progressive_finds_planted_cores(subs, indels, reads, least, lead):
    """Right consensus sequences of 40 clusters; ``lead`` over the star alignment, which few indels do not trouble."""
    right = {"star": 0, "progressive": 0}
    for seed in range(40):
        r = random.Random(seed)
        core = "".join(r.choices("ACGT", k=90))
        seqs = list(dict.fromkeys(mutated(r, core, subs, indels) for _ in range(reads)))
        weights = [r.choice([1, 1, 2]) for _ in seqs]
        rows = progressive_alignment(seqs, weights)
        assert len({len(x) for x in rows}) == 1
        assert [x.replace("-", "") for x in rows] == seqs
        right["progressive"] += consensus_of(seqs, weights) == core
        right["star"] += plurality(star_alignment(seqs, weights), weights) == core
    assert right["progressive"] >= max(least, right["star"] + lead)


def test_progressive_equals_the_star_on_substitutions():
    for seed in range(20):
        r = random.Random(seed)
        core = "".join(r.choices("ACGT", k=60))
        seqs = list(dict.fromkeys([core, *(mutated(r, core, 2, 0) for _ in range(6))]))
        weights = [r.randint(1, 4) for _ in seqs]
        assert consensus_of(seqs, weights) == plurality(star_alignment(seqs, weights), weights)


def test_progressive_odd_inputs(monkeypatch):
    assert progressive_alignment([], []) == []
    assert progressive_alignment(["", "A", "A"], [1, 1, 1]) == ["-", "A", "A"]
    assert progressive_alignment(["", ""], [1, 1]) == ["", ""]
    from repseq.functions import multiple

    monkeypatch.setattr(multiple, "TREE", 3)  # the rest join one by one
    r = random.Random(1)
    core = "".join(r.choices("ACGT", k=60))
    seqs = list(dict.fromkeys(mutated(r, core, 1, 1) for _ in range(12)))
    assert consensus_of(seqs, [1] * len(seqs)) == core


@pytest.mark.parametrize("n", [1, 2, 4, 8])
def test_edit_join_is_all_pairs(spark, n):
    r = random.Random(n)
    seqs = {"".join(r.choices("ACG", k=r.choice([2, 5, 12, 30]))) for _ in range(20)}
    for s in list(seqs):
        seqs |= {mutated(r, s, r.randint(0, 1), r.randint(0, n)) for _ in range(4) if len(s) > n + 2}
    df = spark.createDataFrame([("g" if k % 9 else "h", s) for k, s in enumerate(sorted(seqs))] + [(None, "A"), ("g", None)], "sample string, seq string")
    want = sorted(map(tuple, simjoin.naive_edit_distance_join(df, n).collect()))
    assert sorted(map(tuple, simjoin.edit_distance_join(df, n, hot_rows=3).collect())) == want
    assert want


def test_edit_join_plan_stays_small(spark):
    df = spark.createDataFrame([("g", "ACGTACGTACGT")], "sample string, seq string")
    assert simjoin.edit_distance_join(df, 0).count() == 0
    size = [len(simjoin.edit_distance_join(df, n)._jdf.queryExecution().logical().toString()) for n in (2, 8)]
    assert size[1] < 8 * size[0]
    assert len(simjoin.windows(8)) < 300


def test_hot_segments_are_dealt_out(spark):
    rows = spark.range(4000).select(F.lit("g").alias("g"), F.concat(F.lit("AAAA"), F.lpad(F.conv(F.col("id"), 10, 4), 8, "0")).alias("a"), F.lit(12).alias("l"), F.lit(0).alias("i"), F.lit("AAAA").alias("part"))
    index, probe = simjoin.dealt(rows, rows.limit(3), ["g", "l", "i", "part"], "a", 100)
    sizes = [r["count"] for r in index.groupBy("piece").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 200
    assert probe.count() == 120
