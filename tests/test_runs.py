"""The life of a run: its folder, its counts, taking it up again."""

import pytest

from repseq.operators.scope import RunScope, current_scope
from repseq.operators.shared import checkpoint_dir, materialise
from repseq.operators.simjoin import closest_pair
from repseq.plans import catalogue, pipeline, synth
from repseq.plans.counts import StageCounts

SF = "/root/testdata/sf0.001"


def test_scope_removes_what_was_written(spark):
    with RunScope(spark) as scope:
        assert current_scope() is scope
        kept = materialise(spark.range(5))
        assert kept.count() == 5 and scope.exists(scope.folder)
        assert scope.stage("a", lambda: spark.range(3)).count() == 3
    assert not scope.exists(scope.folder) and current_scope() is None
    with pytest.raises(ValueError, match="x"), RunScope(spark) as scope:
        materialise(spark.range(5))
        raise ValueError("x")
    assert not scope.exists(scope.folder)
    assert scope.folder.startswith(checkpoint_dir(spark))


def test_run_counts_and_is_taken_up_again(spark):
    reads, config = synth.reads(spark, SF), synth.config(spark)
    counts = StageCounts(synth.SAMPLES)
    name = "test-taken-up"
    with pytest.raises(KeyboardInterrupt), RunScope(spark, name) as scope:
        first = sorted(map(tuple, pipeline.run(reads, config, scope=scope, counts=counts).collect()))
        raise KeyboardInterrupt
    assert scope.skipped == [] and scope.exists(scope.folder)
    summary = {(r.sample, r.status): r.n_reads for r in catalogue.QUERIES["demux_summary"](spark, SF).collect() if r.n_reads}
    assert counts.of("demultiplexed") == summary
    assert sum(counts.of("corrected-0").values()) == len(first)
    assert any("corrected-0: s1" in line for line in counts.lines())
    with RunScope(spark, name) as again:
        assert sorted(map(tuple, pipeline.run(reads, config, scope=again).collect())) == first
    assert again.skipped == ["unique", "merged-0", "clusters-0", "corrected-0"]
    assert not again.exists(again.folder)


def test_closest_pair_widens(spark):
    df = spark.createDataFrame([("g", "AAAAAAAAAA"), ("g", "AAAAACCCCC"), ("h", "TTTTTTTTTT"), ("h", "GTTTTTTTCCCC"), (None, "A")], "sample string, seq string")
    assert [tuple(r) for r in closest_pair(df).collect()] == [("g", "AAAAAAAAAA", "AAAAACCCCC", 5)]
    assert closest_pair(df.limit(1)).count() == 0
    assert closest_pair(df.where("false")).count() == 0
