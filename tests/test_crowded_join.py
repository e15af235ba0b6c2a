"""The edit-distance join where many strings share most of their letters, and what is dealt out of it."""

import random

import pytest
from pyspark.sql import functions as F

from repseq.operators import cluster, components, consensus, correct, simjoin


def mutated(r, s, n, letters="ACGT"):
    s = list(s)
    for _ in range(n):
        k = r.randrange(len(s))
        s[k : k + 1] = r.choice([[], [r.choice(letters)], [s[k], r.choice(letters)]])
    return "".join(s)


@pytest.mark.parametrize(("n", "letters"), [(1, "ACGT"), (4, "AÉ𝄞Z")])
def test_crowded_join_is_all_pairs(spark, n, letters):
    r = random.Random(n)
    word = lambda k: "".join(r.choices(letters, k=k))
    head, tail = word(60), word(30)
    seqs = {head + word(r.randint(0, 45)) + tail for _ in range(40)} | {letters[0] * k for k in range(30, 60)}
    seqs |= {mutated(r, s, r.randint(1, n + 1), letters) for s in sorted(seqs) for _ in range(3)}
    df = spark.createDataFrame([((r.choice("xy"), k % 2), s) for k, s in enumerate(sorted(seqs))], "g struct<a: string, b: int>, seq string")
    want = sorted(map(str, simjoin.naive_edit_distance_join(df, n, "g").collect()))
    for crowded in (1, 5):
        assert sorted(map(str, simjoin.edit_distance_join(df, n, "g", hot_rows=7, crowded=crowded).collect())) == want
    assert want


def test_crowded_strings_meet_few_others(spark, monkeypatch):
    """Strings that share all their segments but one: before, each was compared with all of its group."""
    r = random.Random(0)
    head, tail = "".join(r.choices("ACGT", k=160)), "".join(r.choices("ACGT", k=40))
    base = [head + "".join(r.choices("ACGT", k=40)) + tail for _ in range(300)]
    df = spark.createDataFrame([("g", s) for s in base] + [("g", mutated(r, s, 2)) for s in base], "sample string, seq string")
    met, verified = [], simjoin._verified

    def counted(rows, pairs, n, parts):
        met.append(pairs.count())
        return verified(rows, pairs, n, parts)

    monkeypatch.setattr(simjoin, "_verified", counted)
    assert simjoin.edit_distance_join(df, 4).count() > 250
    assert sum(met) < 6000


def test_few_bytes_are_verified_in_many_tasks(spark):
    r = random.Random(2)
    df = spark.createDataFrame([("g", "".join(r.choices("ACGT", k=40))) for _ in range(200)], "sample string, seq string")
    pairs = simjoin.edit_distance_join(df.union(df.selectExpr("sample", "concat(seq, 'A')")), 2)
    used = pairs.select(F.spark_partition_id().alias("p")).distinct().count()
    assert pairs.count() == 200 and used > 8


def test_groups_near_throughout_pass_by_without_python(spark, monkeypatch):
    rows = [("s", f"c{k}", f"{k:04d}" + x) for k in range(40) for x in ("AAAAAAAA", "AAAAAAAC", "AAAAAAC")]
    odd = [("s", "o", x) for x in ("AAAAAAAA", "AAAAAACC", "AAAACCCC")]
    df = spark.createDataFrame(rows + odd, "sample string, cluster string, seq string")
    out = cluster.hierarchical_cluster(df, 2.0)
    assert {(x.cluster, x.part) for x in out.where("cluster <> 'o'").collect()} == {(f"c{k}", f"{k:04d}AAAAAAAA") for k in range(40)}
    assert {x.seq: x.part for x in out.where("cluster = 'o'").collect()} == {"AAAAAAAA": "AAAAAAAA", "AAAAAACC": "AAAAAAAA", "AAAACCCC": "AAAACCCC"}
    monkeypatch.setattr(cluster, "average_linkage", None)  # what goes to Python fails
    assert cluster.hierarchical_cluster(df.where("cluster <> 'o'"), 2.0).count() == 120


@pytest.mark.parametrize("partitions", [4, 16, 64])
def test_work_on_few_bytes_is_dealt_out(spark, request, partitions):
    """Adaptive execution would put groups of few bytes into one task, which a number of partitions that is asked for prevents."""
    reads = spark.createDataFrame([("s", f"c{k}", f"ACGT{'A' * (k % 3)}", "ACGTACGT", 3) for k in range(9)], "sample string, cluster string, cdr string, seq string, qty long")
    for key, value, before in (("spark.sql.shuffle.partitions", partitions, 4), ("spark.sql.autoBroadcastJoinThreshold", -1, 10 << 20)):
        spark.conf.set(key, value)
        request.addfinalizer(lambda key=key, before=before: spark.conf.set(key, before))
    for df in (correct.correct_cdrs(reads), consensus.consensus_clusters(reads, ["sample", "cluster"])):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(k for k, line in enumerate(lines) if "FlatMapGroups" in line)
        assert any("REPARTITION_BY_NUM" in line for line in lines[at : at + 4])


def test_components_of_few_near_sequences_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "_step", None)
    rows = spark.createDataFrame([("x", s) for s in ("TTTTTTTT", "AAAAAAAA", "AAAAAAAC", "AAAAAACC", "GGGGGGGG", "GGGGGGGC")] + [("y", "AAAAAACC")], "sample string, seq string")
    got = {(r.sample, r.seq): r.cluster for r in cluster.graph_cluster(rows, 1).collect()}
    assert got == {("x", "TTTTTTTT"): "TTTTTTTT", **{("x", s): "AAAAAAAA" for s in ("AAAAAAAA", "AAAAAAAC", "AAAAAACC")}, ("x", "GGGGGGGG"): "GGGGGGGC", ("x", "GGGGGGGC"): "GGGGGGGC", ("y", "AAAAAACC"): "AAAAAACC"}
