"""Merging CDR variants, and correcting reads inside clusters."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repseq.functions.align import differing_columns, levenshtein_within, substitutions
from repseq.functions.dna import kmers
from repseq.functions.multiple import Profile, aligned, heaviest, joined, letters_of
from repseq.operators import consensus as C
from repseq.operators.cluster import graph_cluster, hierarchical_cluster
from repseq.operators.shared import materialise, tasks
from repseq.operators.simjoin import edit_distance_join

TRUSTED_K = 11


def choose_true(c1: Column, w1: Column, c2: Column, w2: Column, ratio: float) -> Column:
    """Of a pair, the heavier first: the first if ``ratio`` times as heavy, else the only one in frame, else the first."""
    heavy = w1.cast("double") / w2.cast("double") >= ratio
    in_frame = lambda c: F.length(c) % 3 == 0
    return F.when(heavy, c1).when(~in_frame(c1) & in_frame(c2), c2).otherwise(c1)


def _true_of(c1: str, w1: int, c2: str, w2: int, ratio: float) -> str:
    if w1 / w2 >= ratio or len(c1) % 3 == 0 or len(c2) % 3:
        return c1
    return c2


class Rows:
    """Sequences as rows of letters, padded with 0, to compare one with many."""

    def __init__(self, seqs: Sequence[str]):
        self.seqs = list(seqs)
        self.size = np.array([len(s) for s in seqs], np.int64)
        self.table = np.zeros((len(seqs), int(self.size.max(initial=0)) + 1), np.uint32)
        self.counts: dict[int, np.ndarray] = {}
        for k, s in enumerate(self.seqs):
            self.table[k, : len(s)] = self._codes(s)

    @staticmethod
    def _codes(s: str) -> np.ndarray:
        return np.frombuffer(s.encode("utf-32-le"), np.uint32)

    def put(self, k: int, s: str) -> None:
        """Another sequence in place of one."""
        if len(s) >= self.table.shape[1]:
            self.table = np.pad(self.table, ((0, 0), (0, len(s) + 1 - self.table.shape[1])))
        self.seqs[k], self.size[k] = s, len(s)
        self.table[k] = 0
        self.table[k, : len(s)] = self._codes(s)

    def one_gap(self, k: int, others: np.ndarray) -> np.ndarray:
        """Of each of ``others``, the fewest differing letters of an alignment with ``k`` whose only gap is one run, as long as their lengths differ by."""
        out = np.zeros(len(others), np.int64)
        own, n = self.table[k], int(self.size[k])
        for d in np.unique(self.size[others] - n).tolist():
            at = np.flatnonzero(self.size[others] - n == d)
            rows, short = self.table[others[at]], min(n, n + d)
            left = rows[:, :short] != own[:short]
            right = rows[:, d : d + short] != own[:short] if d > 0 else rows[:, :short] != own[-d : short - d]
            before = np.concatenate([np.zeros((len(at), 1), np.int64), np.cumsum(left, axis=1)], axis=1)
            after = np.concatenate([np.zeros((len(at), 1), np.int64), np.cumsum(right, axis=1)], axis=1)
            out[at] = (before + after[:, -1:] - after).min(axis=1)
        return out

    def contained(self, k: int, others: np.ndarray) -> np.ndarray:
        """Whether the shorter of ``k`` and each of ``others`` is what is left of the longer without some letters."""
        own, n = self.table[k], int(self.size[k])
        longer = self.size[others] >= n
        out = np.zeros(len(others), bool)
        for flag in (True, False):
            at = np.flatnonzero(longer == flag)
            rows, row = self.table[others[at]], np.arange(len(at))
            done = np.zeros(len(at), np.int64)
            for j in range(rows.shape[1] if flag else n):
                done += (rows[:, j] == own[done]) & (done < n) if flag else (rows[row, done] == own[j]) & (done < self.size[others[at]])
            out[at] = done == (n if flag else self.size[others[at]])
        return out

    def costs(self, k: int, others: np.ndarray, differ: int) -> np.ndarray:
        """Least costs of alignments with ``k``: 2 a gap, ``differ`` a pair of different letters."""
        rows, own = self.table[others], self.table[k, : int(self.size[k])]
        along = 2 * np.arange(rows.shape[1] + 1)
        row = np.tile(along, (len(others), 1))
        for i in range(1, len(own) + 1):
            new = row + 2
            new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + differ * (rows != own[i - 1]))
            new[:, 0] = 2 * i
            row = np.minimum.accumulate(new - along, axis=1) + along
        return row[np.arange(len(others)), self.size[others]]

    def apart(self, k: int, others: np.ndarray) -> np.ndarray:
        """At least so many edits lie between ``k`` and each of ``others``: by the letters they have."""
        more, less = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64)
        for c in np.unique(self.table[k]).tolist():
            if c:
                own = (self.table[others] == c).sum(axis=1) - int((self.table[k] == c).sum())
                more, less = more + np.maximum(own, 0), less + np.maximum(-own, 0)
        return np.maximum(np.maximum(more, less), np.abs(self.size[others] - self.size[k]))


def alike_but_gaps(rows: Rows, k: int, others: np.ndarray) -> np.ndarray:
    """Whether the global alignment (0, -1, -2) of ``k`` with each of ``others`` has no two different letters in a column.

    So it is where the shorter is contained in the longer: no alignment costs less than the gaps their
    lengths ask for. Otherwise it needs a gap on either side more, at a cost of 4, so an alignment with
    1 to 3 differing letters and the asked gaps is better. What is left is decided by the costs with and
    without differing letters, and where those are equal by the alignment itself.
    """
    few = rows.one_gap(k, others)
    out = few == 0
    some = np.flatnonzero(~out & (np.abs(rows.size[others] - rows.size[k]) > 1))
    if len(some):
        out[some] = rows.contained(k, others[some])
    left = np.flatnonzero(~out & (few > 3))
    if len(left):
        left = left[rows.costs(k, others[left], 1) == rows.costs(k, others[left], 4)]
        for i in left.tolist():
            out[i] = substitutions(rows.seqs[k], rows.seqs[int(others[i])]) == 0
    return out


def near_in_columns(rows: Rows, k: int, others: np.ndarray, limit: int) -> np.ndarray:
    """Whether the global alignment of ``k`` with each of ``others`` has at most ``limit`` columns that differ.

    It has no more than it costs, and no fewer than the edits between them; only what lies between those bounds is aligned.
    """
    gaps = np.abs(rows.size[others] - rows.size[k])
    out = rows.one_gap(k, others) + 2 * gaps <= limit
    left = np.flatnonzero(~out & (gaps <= limit))
    left = left[rows.apart(k, others[left]) <= limit]
    for i in left.tolist():
        a, b = rows.seqs[k], rows.seqs[int(others[i])]
        out[i] = levenshtein_within(a, b, limit) and differing_columns(a, b) <= limit
    return out


def merge_variants(reads: Sequence[tuple[str, str, int]], ratio: float, limit: int) -> dict[str, str]:
    """CDR -> the CDR it merges into, for ``(cdr, seq, qty)`` rows of one component.

    First pass, heaviest first (of equals, the least CDR): pairs whose alignment has no
    substitution merge. Second pass, ordered anew: pairs whose consensus reads differ in
    at most ``limit`` columns merge. ``_true_of`` says which stays; reads and weight move
    to it. Its consensus then comes from the alignment of the two profiles, so a merge costs one alignment, however many reads meet.

    Each CDR in turn is compared with all that are left at once, and again with those behind
    the place of a merge that changed its consensus.
    """
    members: dict[str, list[tuple[str, int]]] = {}
    for cdr, seq, qty in sorted(reads):
        members.setdefault(cdr, []).append((seq, qty))
    weight = {c: sum(q for _, q in m) for c, m in members.items()}
    into = {c: c for c in members}
    follow: dict[str, list[str]] = {c: [c] for c in members}

    letters = letters_of([s for m in members.values() for s, _ in m])
    profiles: dict[str, Profile] = {}

    def profiled(c: str) -> str:
        whole = aligned([s for s, _ in members[c]], [q for _, q in members[c]], letters)
        profiles[c] = Profile([], [], whole.weights, whole.total)
        return heaviest(whole, letters)

    for first in (True, False):
        order = sorted(members, key=lambda c: (-weight[c], c))
        rows = Rows(order if first else [profiled(c) for c in order])
        gone = np.zeros(len(order), bool)
        for i, c1 in enumerate(order):
            at = i + 1
            while not gone[i]:
                others = np.flatnonzero(~gone[at:]) + at
                if not len(others):
                    break
                same = alike_but_gaps(rows, i, others) if first else near_in_columns(rows, i, others, limit)
                met = others[same]
                if not len(met):
                    break
                for j in met.tolist():
                    c2, at = order[j], j + 1
                    stays = _true_of(c1, weight[c1], c2, weight[c2], ratio)
                    goes = c2 if stays == c1 else c1
                    members[stays] += members.pop(goes)
                    weight[stays] += weight.pop(goes)
                    gone[j if goes == c2 else i] = True
                    for c in follow.pop(goes):
                        into[c] = stays
                        follow[stays].append(c)
                    kept = i if stays == c1 else j
                    before = rows.seqs[kept]
                    if not first:
                        profiles[stays] = joined(profiles[stays], profiles.pop(goes))
                        rows.put(kept, heaviest(profiles[stays], letters))
                    if gone[i] or rows.seqs[kept] != before:
                        break
                else:
                    break
    return into


def correct_cdrs(reads: DataFrame, ratio: float = 2.0, limit: int = 4, keys: Sequence[str] = ("sample", "cluster")) -> DataFrame:
    """``reads`` (keys, cdr, seq, qty) plus ``true_cdr``. Components of one CDR pass by without Python; the rest are independent tasks, each of one component."""
    keys = list(keys)
    n = reads.groupBy(*keys).agg(F.countDistinct("cdr").alias("__n"))
    sized = reads.join(n, keys)
    alone = sized.where("__n = 1").select(*reads.columns, F.col("cdr").alias("true_cdr"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        into = merge_variants(list(zip(pdf["cdr"], pdf["seq"], pdf["qty"], strict=True)), ratio, limit)
        return pdf.assign(true_cdr=pdf["cdr"].map(into))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reads.schema.fields) + ", true_cdr string"
    dealt = sized.where("__n > 1").drop("__n").repartition(tasks(reads.sparkSession), *keys)  # few bytes, but comparing is the work
    return alone.unionByName(dealt.groupBy(*keys).applyInPandas(run, schema))


def trusted_kmers(clusters: DataFrame, k: int = TRUSTED_K, seq: str = "consensus", group: str = "sample") -> DataFrame:
    """Distinct k-mers of consensus sequences, by sample."""
    return clusters.select(group, F.explode(kmers(F.col(seq), k)).alias("kmer")).distinct()


def trusted_kmer_count(reads: DataFrame, trusted: DataFrame, k: int = TRUSTED_K, keys: Sequence[str] = ("sample", "seq")) -> DataFrame:
    """How many of a sequence's k-mers are trusted in its sample. K-mers are shuffled with a number, not with the sequence; sequences are written once, so that the numbers stay."""
    own = materialise(reads.select(*keys).distinct().withColumn("__id", F.monotonically_increasing_id()))
    asked = own.select("__id", F.col("sample").alias("__s"), F.explode(kmers(F.col("seq"), k)).alias("__k"))
    known = trusted.select(F.col("sample").alias("__s"), F.col("kmer").alias("__k"))
    counts = asked.join(known, ["__s", "__k"], "left_semi").groupBy("__id").agg(F.count("*").alias("__n"))
    return own.join(counts, "__id", "left").select(*keys, F.coalesce("__n", F.lit(0)).cast("long").alias("n_trusted"))


def correct_reads(members: DataFrame, threshold: int = 4, cutoff: float = 4.0, compat: bool = True) -> DataFrame:
    """``(sample, cluster, part, seq, qty, n_reads)``: a consensus for each part of each cluster of ``members`` (sample, cluster, seq, qty).

    A cluster is split by edit-distance components at ``threshold``, then by average
    linkage at ``cutoff``. Consensus: the sequence itself, a plurality, or for two single
    reads the side with more trusted k-mers; trusted are those of the sample's pluralities of
    more than two reads. Pairs are few and look up only their own k-mers.
    """
    return correct_parts(split_clusters(members, threshold, cutoff), compat)


def split_clusters(members: DataFrame, threshold: int = 4, cutoff: float = 4.0) -> DataFrame:
    """``members`` (sample, cluster, seq, qty) summed per sequence, plus ``pre``, its component at ``threshold`` edits in the cluster, and ``part``, its average-linkage cluster in that. Written to the shared folder. One join gives the pairs for both."""
    members = materialise(members.groupBy("sample", "cluster", "seq").agg(F.sum("qty").cast("long").alias("qty")))
    scoped = members.withColumn("scope", F.struct("sample", "cluster"))
    edges = materialise(edit_distance_join(scoped, max(threshold, math.floor(cutoff)), "scope"))
    parted = graph_cluster(scoped, threshold, "scope", edges=edges.where(F.col("dist") <= threshold)).withColumnRenamed("cluster", "pre")
    pre = materialise(scoped.join(parted, ["scope", "seq"]).select("sample", "cluster", "pre", "seq", "qty"))
    inside = pre.select(F.struct("sample", "cluster").alias("scope"), F.col("seq").alias("src"), "pre")
    other = inside.select("scope", F.col("src").alias("dst"), F.col("pre").alias("__other"))
    within = edges.join(inside, ["scope", "src"]).join(other, ["scope", "dst"]).where("pre = __other").select("scope.sample", "scope.cluster", "pre", "src", "dst", "dist")
    return materialise(hierarchical_cluster(pre, cutoff, ("sample", "cluster", "pre"), edges=within))


def correct_parts(fine: DataFrame, compat: bool = True) -> DataFrame:
    """The consensus of each part of ``split_clusters``."""
    made = materialise(C.consensus_clusters(fine, ["sample", "cluster", "part"]))
    pairs = made.where("kind = 'pair'")
    trusted = trusted_kmers(made.where("kind = 'plurality'"))
    asked = pairs.select("sample", "cluster", "part", "a", "b", F.explode(F.array_union(kmers(F.col("a"), TRUSTED_K), kmers(F.col("b"), TRUSTED_K))).alias("kmer"))
    known = asked.join(trusted, ["sample", "kmer"], "left_semi").groupBy("sample", "cluster", "part").agg(F.collect_set("kmer").alias("known"))
    judged = pairs.join(known, ["sample", "cluster", "part"], "left").repartition(tasks(fine.sparkSession), "sample", "cluster", "part")

    @F.pandas_udf("string")
    def decide(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b, own in batches:
            yield pd.Series([C.pair_consensus(x, y, [] if k is None else k) for x, y, k in zip(a, b, own, strict=True)], dtype=object)

    columns = ["sample", "cluster", "part", "consensus", "n_reads", "n_unique"]
    solved = judged.withColumn("consensus", decide("a", "b", "known")).select(columns)
    out = made.where("kind <> 'pair'").select(columns).unionByName(solved)
    qty = F.when(F.col("n_unique") == 1, F.lit(1)).otherwise(F.col("n_reads")) if compat else F.col("n_reads")
    return out.select("sample", "cluster", "part", F.col("consensus").alias("seq"), qty.cast("long").alias("qty"), "n_reads")
