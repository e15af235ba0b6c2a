import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from repseq.operators import cdr3, cluster, consensus, correct, dedup, demux, simjoin
from repseq.operators.components import connected_components
from repseq.plans import pipeline, synth

SF = "/root/testdata/sf0.001"


def mutated(rng, s, n):
    s = list(s)
    for _ in range(n):
        k = rng.randrange(len(s) + 1)
        what = rng.choice("ids")
        if what == "i":
            s.insert(k, rng.choice("ACGT"))
        elif s and k < len(s):
            s[k : k + 1] = [] if what == "d" else [rng.choice("ACGT")]
    return "".join(s)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_blocked_join_equals_all_pairs(spark, n):
    rng = random.Random(n)
    base = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 24))) for _ in range(25)]
    seqs = base + [mutated(rng, s, rng.randrange(0, 4)) for s in base for _ in range(4)] + ["", "A", "AC", None]
    rows = spark.createDataFrame([(rng.choice("xy"), s) for s in seqs], "sample string, seq string")
    got = sorted(map(tuple, simjoin.edit_distance_join(rows, n).collect()))
    assert got == sorted(map(tuple, simjoin.naive_edit_distance_join(rows, n).collect()))
    assert (not got) == (n == 0)


def test_join_has_no_nested_loop(spark):
    rows = spark.createDataFrame([("x", "ACGTACGT"), ("x", "ACGTACGA")], "sample string, seq string")
    plan = simjoin.edit_distance_join(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_shared_kmers_are_multisets(spark):
    rows = spark.createDataFrame([("x", "AAAA"), ("x", "AAA"), ("x", "CC")], "sample string, seq string")
    assert [tuple(r) for r in simjoin.shared_kmers(rows, 2).collect()] == [("x", "AAA", "AAAA", 2)]


def test_prefilter_loses_no_pair(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ACGT") for _ in range(60))
    rows = spark.createDataFrame([("x", mutated(rng, base, rng.randrange(3))) for _ in range(30)], "sample string, seq string")
    kept = {(r.src, r.dst) for r in simjoin.kmer_prefilter(rows, 5, 2).collect()}
    assert {(r.src, r.dst) for r in simjoin.edit_distance_join(rows, 2).collect()} <= kept
    pair = spark.createDataFrame([("x", "ACGTACGTACGTAC"), ("x", "ACGTACCTACGTAC")], "sample string, seq string")  # no bound: every pair passes
    assert [tuple(r) for r in simjoin.kmer_prefilter(pair, 11, 2).collect()] == [("x", "ACGTACCTACGTAC", "ACGTACGTACGTAC", 0)]


def test_pairs_by_blocks_equal_all_pairs_and_are_not_shuffled(spark):
    rng = random.Random(4)
    seqs = ["".join(rng.choice("AC") for _ in range(rng.randrange(0, 40))) for _ in range(90)] + ["é" * 5, "C" * 80, None]
    rows = spark.createDataFrame([(rng.choice("xy"), rng.randrange(12), s) for s in seqs] + [("x", 3, "ACCA")] * 2 + [(None, 1, "A"), ("x", None, "A")], "sample string, cluster int, seq string")
    left, right = rows.selectExpr("sample", "cluster AS cluster_a", "seq AS a"), rows.selectExpr("sample", "cluster AS cluster_b", "seq AS b")
    want = left.join(right, "sample").where("cluster_a < cluster_b").groupBy("sample", "cluster_a", "cluster_b").agg(F.avg(F.levenshtein("a", "b").cast("double")).alias("d"))
    for size in (5, 1000):
        key = lambda r: (r[:3], r[3])
        assert sorted(map(tuple, cluster.cluster_pair_distances(rows, block_rows=size).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    few = rows.where("cluster < 4 AND seq IS NOT NULL")
    bags = {(r.sample, r.seq): Counter(r.seq[i : i + 3] for i in range(len(r.seq) - 2)) for r in few.collect() if r.sample}
    every = {(*a, b[1]): (bags[a] & bags[b]).total() for a in bags for b in bags if a[0] == b[0] and a[1] < b[1]}
    got = simjoin.shared_kmers(few, 3, block_rows=7)
    assert sorted(map(tuple, got.collect())) == sorted((*k, n) for k, n in every.items() if n)
    assert sorted(map(tuple, simjoin.kmer_prefilter(few, 3, 2, block_rows=7).collect())) == sorted((*k, n) for k, n in every.items() if n >= max(map(len, k[1:])) - 2 - 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "src" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            hi, lo = sorted((root(a), root(b)), reverse=True)
            up[hi] = lo
    assert got == {x: root(x) for x in up}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_components_of_few_edges_take_few_tasks(spark):
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "src int, dst int")
    first = 1 + max([j for j in sc.statusTracker().getJobIdsForGroup(None)], default=0)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r.node: r.component for r in connected_components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(range(31), 0)
    tasks, stages = 0, set()
    for j in range(first, 100_000):
        job = sc.statusTracker().getJobInfo(j)
        if job is None:
            break
        stages |= set(job.stageIds)
    for s in stages:
        info = sc.statusTracker().getStageInfo(s)
        tasks += info.numCompletedTasks if info else 0
    assert tasks < 200  # rounds took 1,604


def test_components_of_edges_in_many_pieces(spark):
    rng = random.Random(3)
    whole = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(300, 340)] + [(400, i) for i in range(401, 430)] + [(5, 5), (None, 3)]
    rng.shuffle(whole)
    text = [tuple(None if x is None else "é" * (x % 3) + str(x) for x in e) for e in whole]
    for edges, kind in ((whole, "long"), (text, "string")):
        up = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
        for _ in up:
            for a, b in edges:
                if a in up and b in up:
                    up[a] = up[b] = min(up[a], up[b])
        for most in (7, 40, 1000):
            got = connected_components(spark.createDataFrame(edges, f"src {kind}, dst {kind}").repartition(3), most=most).collect()
            assert len(got) == len(up) and {r.node: r.component for r in got} == up


def test_trusted_kmer_count_shuffles_no_sequence_with_its_kmers(spark):
    rng = random.Random(5)
    seqs = ["".join(rng.choice("AC") for _ in range(n)) for n in (3, 10, 11, 40, 40, 60)]
    rows = [(s, q) for s in ("x", "y") for q in seqs] + [("x", seqs[4]), ("x", None), (None, seqs[5]), ("z", seqs[5])]
    trust = {(s, q[i : i + 4]) for s, q in rows[:9] if s for i in range(0, len(q) - 3, 3)}
    trusted = spark.createDataFrame(sorted(trust), "sample string, kmer string")
    got = correct.trusted_kmer_count(spark.createDataFrame(rows, "sample string, seq string"), trusted, 4)
    want = {(s, q): sum((s, q[i : i + 4]) in trust for i in range(len(q or "") - 3)) for s, q in rows}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*k, n) for k, n in want.items()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    beside = [line.rsplit("], ", 1)[0].rsplit("[", 1)[1] for line in plan.splitlines() if "Generate explode" in line]
    assert beside and not any("seq" in x for x in beside)


def test_average_linkage():
    def with_distances(d, monkey):
        names = sorted({x for p in d for x in p})
        monkey.setattr(cluster, "levenshtein_to", lambda a, others: __import__("numpy").array([d[tuple(sorted((a, o)))] for o in others], float))
        return dict(zip(names, cluster.average_linkage(names, 4.0), strict=True))

    with pytest.MonkeyPatch.context() as m:
        assert with_distances({("a", "b"): 2, ("a", "c"): 4, ("b", "c"): 6}, m) == {"a": 0, "b": 0, "c": 1}
        assert with_distances({("a", "b"): 2, ("a", "c"): 4, ("b", "c"): 4}, m) == {"a": 0, "b": 0, "c": 0}
    assert cluster.average_linkage([], 4) == [] and cluster.average_linkage(["A"], 4) == [0]


def test_average_linkage_against_recomputed_means():
    from repseq.functions.align import levenshtein_to

    rng = random.Random(9)
    base = ["".join(rng.choice("ACGT") for _ in range(20)) for _ in range(4)]
    seqs = sorted({mutated(rng, b, rng.randrange(5)) for b in base for _ in range(6)})
    parts = [[s] for s in seqs]
    while len(parts) > 1:
        means = [(sum(levenshtein_to(a, q).sum() for a in p) / len(p) / len(q), i, j) for i, p in enumerate(parts) for j, q in enumerate(parts) if i < j]
        best, i, j = min(means)
        if best > 4:
            break
        parts[i] += parts.pop(j)
    got = cluster.average_linkage(seqs, 4.0)
    assert sorted(sorted(p) for p in parts) == sorted(sorted(s for s, c in zip(seqs, got, strict=True) if c == k) for k in set(got))


def test_preclusters_at_the_cutoff_change_nothing(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("ACGT") for _ in range(25)) for _ in range(3)]
    rows = spark.createDataFrame([("x", s) for s in sorted({mutated(rng, b, rng.randrange(4)) for b in base for _ in range(6)})], "sample string, seq string")
    whole = cluster.hierarchical_cluster(rows.withColumn("cluster", F.lit("all")))
    split = cluster.hierarchical_cluster(cluster.graph_cluster(rows, 4))
    assert {(r.seq, r.part) for r in whole.collect()} == {(r.seq, r.part) for r in split.collect()}


def test_consensus():
    assert consensus.plurality(["AC-T", "ACGT", "AT-T"], [2, 1, 1]) == "ACT"
    assert consensus.plurality(["A", "-"], [1, 1]) == "A"
    rows = consensus.star_alignment(["ACGT", "ACGGT", "AGT"], [5, 1, 1])
    assert len({len(r) for r in rows}) == 1 and [r.replace("-", "") for r in rows] == ["ACGT", "ACGGT", "AGT"]
    assert consensus.consensus_of(["ACGGT", "ACGT", "AGT"], [1, 5, 1]) == "ACGT"
    assert consensus.pair_consensus("ACGT" * 6, "ACGT" * 5 + "ACCT", ["ACGTACGTACC", "CGTACGTACCT"]) == "ACGT" * 5 + "ACCT"
    assert consensus.pair_consensus("ACGT", "AGT", []) == "ACGT"


def test_abundance(spark):
    rows = spark.createDataFrame([("a", "s", 7), ("b", "s", 2), ("b", "t", 1)], "c string, seq string, qty long")
    got = {r.c: (r.qty, r.n_reads) for r in consensus.cluster_abundance(rows, ["c"]).collect()}
    assert got == {"a": (1, 7), "b": (3, 3)}
    assert {r.qty for r in consensus.cluster_abundance(rows, ["c"], compat=False).collect()} == {7, 3}


@pytest.mark.parametrize(("w1", "c1", "w2", "c2", "first"), [(4, "A" * 45, 2, "C" * 45, True), (3, "A" * 45, 2, "C" * 44, True), (3, "A" * 44, 2, "C" * 45, False), (3, "A" * 45, 2, "C" * 48, True)])
def test_choose_true(spark, w1, c1, w2, c2, first):
    row = spark.createDataFrame([(c1, w1, c2, w2)], "c1 string, w1 int, c2 string, w2 int").select(correct.choose_true(F.col("c1"), F.col("w1"), F.col("c2"), F.col("w2"), 2).alias("x")).first()
    assert row.x == correct._true_of(c1, w1, c2, w2, 2) == (c1 if first else c2)


def test_merge_variants():
    tail = "ACGTTGCA" * 10
    reads = [("ACGTAC", "ACGTAC" + tail, 5), ("ACGTACG", "ACGTACG" + tail, 1), ("ACCTAC", "ACCTAC" + tail, 2), ("TTTTTT", "TTTTTT" + tail[::-1], 4)]
    assert correct.merge_variants(reads, 2, 4) == {"ACGTAC": "ACGTAC", "ACGTACG": "ACGTAC", "ACCTAC": "ACGTAC", "TTTTTT": "TTTTTT"}
    assert correct.merge_variants(reads, 2, 0)["ACCTAC"] == "ACCTAC"


def adapters():
    return [demux.Sample("a", "ACGTACGTACGGTTACAGCT", "TTGACCATGGATCCAAGTCA"), demux.Sample("b", "GCGCGTATATCCGGAATTCA", "CATCATGGTTGGTACACACA")]


def rc(s):
    return s.translate(str.maketrans("ACGTacgt", "TGCAtgca"))[::-1]


def test_demultiplex():
    core = "GATTACAGATTACAGGCCTTAACCGGTTAA" * 3
    a, b = adapters()
    whole = a.forward + core + rc(a.reverse)
    reads = [whole, rc(whole), b.forward + core + rc(b.reverse), a.forward + core, core, a.forward[:5] + "G" + a.forward[6:] + core + rc(a.reverse), "TT" + whole + "C", ""]
    got = demux.assign(reads, [a, b])
    assert [g[:2] for g in got] == [("ok", "a"), ("ok", "a"), ("ok", "b"), ("incomplete", "a"), ("nomid", None), ("ok", "a"), ("ok", "a"), ("nomid", None)]
    assert all(g[2] == core for g in got if g[0] == "ok")


def test_adapter_alignment_equals_the_pairwise_one():
    import numpy as np

    from repseq.functions.align import align_local

    rng = random.Random(8)
    adapter = adapters()[0].forward
    reads = [mutated(rng, "".join(rng.choice("ACGT") for _ in range(rng.randrange(6))) + adapter, rng.randrange(8))[:30] for _ in range(60)]
    score, clip = demux.locate_adapter(demux._table([r.encode() for r in reads], 40), adapter)
    for r, s, c in zip(reads, score, clip, strict=True):
        assert s == align_local(r, adapter).score
        assert c <= len(r) + len(adapter)
    assert isinstance(score, np.ndarray)


def test_windows_are_aligned_once_and_whole_adapters_not_at_all(monkeypatch):
    rng = random.Random(9)
    for sample in adapters():
        adapter = sample.forward
        reads = [mutated(rng, "".join(rng.choice("ACGT") for _ in range(rng.randrange(6))) + adapter + adapter[:7], rng.randrange(9))[: rng.randrange(50)].encode() for _ in range(400)] + [b"", adapter.encode() * 3]
        for least in (len(adapter) - 6, 0):
            score, clip = demux.locate_adapter(demux._table(reads, 40), adapter)
            known = {}
            for some in (reads[:200], reads):
                got = demux.located(some, adapter, 40, least, known)
                assert got[0].tolist() == score[: len(some)].tolist()
                assert got[1].tolist() == [c if s >= least else 0 for s, c in zip(score[: len(some)].tolist(), clip[: len(some)].tolist(), strict=True)]
    rows, plain = [], demux.best_scores
    monkeypatch.setattr(demux, "best_scores", lambda windows, adapter: rows.append(len(windows)) or plain(windows, adapter))
    core = "GATTACAGATTACAGGCCTTAACCGGTTAA" * 3
    demux.assign([adapters()[0].forward + core + rc(adapters()[0].reverse)] * 500 + [core] * 500, adapters())
    assert sum(rows) <= 10


def test_reads_are_dealt_out_and_summed_in_one_pass(spark):
    assert synth.reads(spark, SF).rdd.getNumPartitions() > spark.read.parquet(f"{SF}/orders.parquet").rdd.getNumPartitions()
    summary = demux.demux_summary(demux.demultiplex(synth.reads(spark, SF).select("read_id", "seq"), synth.config(spark)), synth.config(spark))
    assert summary._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_statuses_of_a_run(spark):
    a, _ = adapters()
    config = spark.createDataFrame([("a", a.forward[:10], a.reverse[:10], a.forward[10:], a.reverse[10:], 0), ("none", "C" * 10, "C" * 10, "G" * 10, "G" * 10, 1)], "sampleName string, forwardMid string, reverseMid string, forwardPrimer string, reversePrimer string, cfg_ord int")
    core = "GATTACA" * 12
    rows = [(1, "acg" + a.forward + core + rc(a.reverse) + "nt"), (2, a.forward + "N" + core), (3, "acgt"), (4, None), (5, "n" + a.forward + core.lower() + "C")]
    reads = spark.createDataFrame(rows, "read_id long, seq string").withColumn("status", F.lit("x"))
    got = {r.read_id: (r.sample, r.status, r.out_seq) for r in demux.demultiplex(reads, config).collect()}
    assert got == {1: ("a", "ok", core), 2: (None, "has_n", rows[1][1]), 3: (None, "nomid", "acgt"), 4: (None, "nomid", None), 5: ("a", "incomplete", rows[4][1][1:])}
    summary = {(r.sample, r.status): r.n_reads for r in demux.demux_summary(demux.demultiplex(reads, config), config).collect()}
    assert summary[("none", None)] == 0 and summary[("a", "ok")] == 1 and summary[(None, "nomid")] == 2


@pytest.mark.parametrize(("gap", "found"), [(29, False), (30, True), (90, True), (91, False)])
def test_cdr_band(spark, gap, found):
    start, end = "TATTATTGT", "TGGGGCAAG"
    seq = "C" * 120 + start + "C" * (gap - 9) + end
    row = cdr3.with_cdr3(spark.createDataFrame([(seq,)], "seq string")).first()
    assert (row.cdr == start + "C" * (gap - 9)) if found else row.cdr is None


@pytest.mark.parametrize("more", [0, 1])
def test_cdr_starts_in_the_second_half(spark, more):
    inner = "TATTATTGT" + "C" * 31 + "TGGGGCAAG"
    seq = "C" * (len(inner) + more) + inner
    half = len(seq) // 2
    row = cdr3.with_cdr3(spark.createDataFrame([(seq,)], "seq string")).first()
    assert (row.cdr is not None) == (len(inner) + more > half)


def test_last_of_repeated_ids(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "read_id string, ord int, seq string")
    assert sorted((r.read_id, r.seq) for r in dedup.dedup_last_by_id(rows).collect()) == [("a", "y"), ("b", None)]
    assert dedup.content_id(rows.selectExpr("*", "'s' AS sample")).select("uid").distinct().count() == 3


def test_pipeline_recovers_the_planted_clones(spark):
    out = pipeline.run(synth.reads(spark, SF), synth.config(spark)).collect()
    truth = synth.unique(spark, SF).groupBy("sample", "clone").agg(F.sum("qty").alias("n"), F.max(F.struct("qty", "seq")).alias("top"), F.first("true_core").alias("core")).collect()
    want = {}
    for t in truth:
        want[t.sample, t.core] = want.get((t.sample, t.core), 0) + t.n
    assert sum(r.n_reads for r in out) == sum(want.values())
    right = sum(r.n_reads for r in out if want.get((r.sample, r.seq)) is not None)
    assert right >= 0.9 * sum(want.values())


def test_pipeline_does_not_depend_on_order_or_partitions(spark):
    reads = synth.reads(spark, SF).where("read_id % 3 = 0")
    config = synth.config(spark)
    key = lambda rows: sorted(map(tuple, rows))
    assert key(pipeline.run(reads, config).collect()) == key(pipeline.run(reads.orderBy(F.desc("seq")).repartition(7), config).collect())
