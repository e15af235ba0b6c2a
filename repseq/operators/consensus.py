"""Multiple alignment and weighted plurality consensus of the reads of a cluster."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repseq.functions.align import align_global
from repseq.functions.multiple import aligned, heaviest, letters_of
from repseq.operators.shared import tasks

GAP = "-"


def star_alignment(seqs: Sequence[str], weights: Sequence[int]) -> list[str]:
    """Strings of one length: each sequence laid along the heaviest (of equals, the least), with the gaps that any of them asks for."""
    centre = min(zip([-w for w in weights], seqs, strict=True))[1]
    pairs = [(centre, centre) if s == centre else (lambda g: (g.a, g.b))(align_global(centre, s)) for s in seqs]
    gaps = [0] * (len(centre) + 1)
    for a, _ in pairs:
        at = run = 0
        for c in [*a, ""]:
            if c == GAP:
                run += 1
            else:
                gaps[at] = max(gaps[at], run)
                at, run = at + 1, 0
    out = []
    for a, b in pairs:
        row, at, run = [], 0, []
        for c, d in [*zip(a, b, strict=True), ("", "")]:
            if c == GAP:
                run.append(d)
                continue
            row += run + [GAP] * (gaps[at] - len(run)) + [d]
            at, run = at + 1, []
        out.append("".join(row))
    return out


def plurality(aligned: Sequence[str], weights: Sequence[int]) -> str:
    """The heaviest symbol of each column, gaps counted as one and then left out; of equals a base, the least."""
    out = []
    for column in zip(*aligned, strict=True):
        votes: Counter[str] = Counter()
        for c, w in zip(column, weights, strict=True):
            votes[c] += w
        best = min(votes, key=lambda c: (-votes[c], c == GAP, c))
        if best != GAP:
            out.append(best)
    return "".join(out)


def consensus_of(seqs: Sequence[str], weights: Sequence[int]) -> str:
    """The plurality of the progressive alignment of weighted sequences."""
    if len(seqs) == 1:
        return seqs[0]
    letters = letters_of(seqs)
    return heaviest(aligned(seqs, weights, letters), letters)


def pair_consensus(a: str, b: str, trusted: Iterable[str], k: int = 11) -> str:
    """Of two single reads: where their alignment differs, the side with more trusted k-mers in the 2k columns around; of equals, ``a``. Gaps are left out."""
    trusted = set(trusted)
    got = align_global(a, b)
    known = lambda s: sum(s[i : i + k] in trusted for i in range(len(s) - k + 1))
    out = []
    for i, (p, q) in enumerate(zip(got.a, got.b, strict=True)):
        if p != q:
            lo, hi = max(0, i - k), i + k
            p = q if known(got.b[lo:hi].replace(GAP, "")) > known(got.a[lo:hi].replace(GAP, "")) else p
        out.append(p)
    return "".join(out).replace(GAP, "")


def consensus_plurality(aligned: DataFrame, cluster: str = "cluster_id", row: str = "aln", weight: str = "qty") -> DataFrame:
    """``(cluster, consensus)`` of aligned rows, natively: positions, summed votes, first of each position."""
    chars = aligned.select(cluster, F.posexplode(F.split(row, "")).alias("pos", "ch"), weight).where("ch <> ''")
    votes = chars.groupBy(cluster, "pos", "ch").agg(F.sum(weight).alias("w"))
    best = Window.partitionBy(cluster, "pos").orderBy(F.desc("w"), F.col("ch") == GAP, "ch")
    won = votes.withColumn("n", F.row_number().over(best)).where(F.col("n") == 1)
    letters = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("ch") != GAP, F.col("ch")).otherwise("").alias("ch"))))
    return won.groupBy(cluster).agg(F.array_join(F.transform(letters, lambda x: x.ch), "").alias("consensus"))


def cluster_abundance(members: DataFrame, keys: Sequence[str], weight: str = "qty", compat: bool = True) -> DataFrame:
    """Reads of each cluster; with ``compat`` a cluster of one unique sequence counts 1 as its ``qty``. ``n_reads`` is always the true number."""
    total, kinds = F.sum(weight).cast("long"), F.count("*")
    qty = F.when(kinds == 1, F.lit(1)).otherwise(total).cast("long") if compat else total
    return members.groupBy(*keys).agg(qty.alias("qty"), total.alias("n_reads"))


def consensus_clusters(members: DataFrame, keys: Sequence[str], seq: str = "seq", weight: str = "qty") -> DataFrame:
    """``(*keys, consensus, n_reads, n_unique, kind)`` of each cluster. Single sequences pass by without Python.

    ``kind``: ``single`` (one unique sequence), ``plurality``, or ``pair`` (two single
    reads, left to ``pair_consensus``; ``consensus`` is then null and ``a``, ``b`` are its reads in order).
    """
    keys = list(keys)
    stats = members.groupBy(*keys).agg(F.count("*").alias("n_unique"), F.sum(weight).cast("long").alias("n_reads"), F.min(seq).alias("a"), F.max(seq).alias("b"))
    simple = stats.where("n_unique = 1").select(*keys, F.col("a").alias("consensus"), "n_reads", "n_unique", F.lit("single").alias("kind"), "a", "b")
    pairs = stats.where("n_unique > 1 AND n_reads = 2").select(*keys, F.lit(None).cast("string").alias("consensus"), "n_reads", "n_unique", F.lit("pair").alias("kind"), "a", "b")
    big = members.join(stats.where("n_reads > 2 AND n_unique > 1").select(*keys), keys)
    kinds = {f.name: f.dataType.simpleString() for f in members.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(seq)
        seqs, weights = table[seq].to_pylist(), table[weight].to_pylist()
        head = {k: table[k][:1] for k in keys}
        return pa.table({**head, "consensus": [consensus_of(seqs, weights)], "n_reads": [int(sum(weights))], "n_unique": [len(seqs)], "kind": ["plurality"], "a": seqs[:1], "b": seqs[-1:]})

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", consensus string, n_reads long, n_unique long, kind string, a string, b string"
    dealt = big.repartition(tasks(members.sparkSession), *keys)  # few bytes, but alignments are the work
    return simple.unionByName(pairs).unionByName(dealt.groupBy(*keys).applyInArrow(run, schema))
