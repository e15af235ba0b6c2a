from collections import Counter

import corpus_pipeline as P
from repseq.llm import decontamination as D
from repseq.llm import mixing, simhash

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        if k < len(P.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = seen[name][1]
    before, after = seen["language_id"]
    assert after.count() >= 0.98 * before.count()
    before, after = seen["near_duplicates"]
    groups = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert {r.doc_id for r in after.collect()} == groups and after.count() == len(groups)
    before, after = seen["decontamination"]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = {r.doc_id for r in D.digest(before, benchmark).where("contaminated").collect()}
    assert not D.digest(after, benchmark).where("contaminated").count()
    old = {r.doc_id: r.text for r in before.collect()}
    assert hit and all((r.text != old[r.doc_id]) == (r.doc_id in hit) and r.n_chars == len(r.text) for r in after.collect())
    before, after = seen["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.mixed(before).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({d: n for d, n in copies.items() if n})
    before, after = seen["sharding"]
    rows = after.collect()
    assert len(rows) == before.count()
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_run_is_the_stages_and_reruns_agree(spark):
    one, two = (sorted((r.doc_id, r.text, r.shard) for r in P.run(spark, SF).collect()) for _ in range(2))
    assert one == two and one


def test_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in P.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
