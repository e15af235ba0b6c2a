"""SimHash fingerprints, and all links between them by a general pigeonhole."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.llm.jaccard import SIMILAR, similar_groups
from repseq.llm.textcore import LOWER, NOT_SPACE, Block, blocks, lean
from repseq.operators.components import connected_components
from repseq.operators.shared import compact, free_shuffles, materialise, released, small_side

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
#: Shingles that are joined and hashed at a time, also of one long text.
HASHED = 200_000
#: A block value of more fingerprints than this is linked without pairs.
HOT = 32
#: Bits whose values are counted together when collisions are estimated.
CHUNK = 12


def shingle_hashes(block: Block, width: int = SHINGLE, seed: int = SEED, most: int = HASHED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a block's texts, and the number of the first of each text (and the end). ``most`` shingles at a time."""
    buf = LOWER[block.buf]
    starts, ends, firsts = block.words(NOT_SPACE, buf)
    n_words = np.diff(firsts)
    per = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    offs = np.concatenate([[0], np.cumsum(per)])
    hashes = np.empty(int(offs[-1]), np.uint64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(hashes), most):
        hi = min(lo + most, len(hashes))
        text = np.searchsorted(offs, np.arange(lo, hi), "right") - 1
        at = np.arange(lo, hi) - offs[text] + firsts[text]
        last = at + np.minimum(width, n_words[text]) - 1
        a, b = int(at[0]), int(last.max()) + 1
        own, lens = buf[starts[a] : ends[b - 1]], ends[a:b] - starts[a:b]
        new_ends = np.cumsum(lens + 1) - 1
        new_starts = new_ends - lens
        joined = np.full(int(new_ends[-1]) + 1, 32, np.uint8)
        joined[np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)] = own[NOT_SPACE[own]]
        data = joined.tobytes()
        hashes[lo:hi] = np.fromiter((digest(data[s:e], seed) for s, e in zip(new_starts[at - a].tolist(), new_ends[last - a].tolist(), strict=True)), np.uint64, hi - lo)
    return hashes, offs


def majority(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A bit of a text's fingerprint is 1 if it is set in over half its hashes; 0 without hashes."""
    out = np.zeros(len(offs) - 1, np.uint64)
    size = np.diff(offs)
    some = np.flatnonzero(size)
    if not len(some):
        return out
    step = 60_000  # below the 16 bits of a lane
    pieces = -(-size[some] // step)
    owner = np.repeat(np.arange(len(some)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = np.repeat(offs[some], pieces) + nth * step
    firsts = np.cumsum(pieces) - pieces
    lanes = np.uint64(0x0001000100010001)
    for s in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(s)) & lanes, cuts)
        for lane in range(4):
            ones = np.add.reduceat(((sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64), firsts)
            out[some] |= (2 * ones > size[some]).astype(np.uint64) << np.uint64(s + 16 * lane)
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp long)``. A text without words, and null, has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                fps = majority(*shingle_hashes(block, width))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.lo, block.n), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


# --- the plan of the search ---------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """Bits that are compared together, and how many of them may differ (-1: not probed)."""

    bits: tuple[int, ...]
    most: int


def agreement(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and, for bits i and j, in how many both are set. 64 x 64 sums over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint64)
            for lo in range(0, len(x), 8192):
                bits = np.unpackbits(x[lo : lo + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
            n += len(x)
        cells = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "n"])

    sums = {r.cell: r.n for r in fps.mapInArrow(lean(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    cells = np.array([sums.get(k, 0) for k in range(BITS * BITS + 1)])
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of near equal size; each grows from the bit most correlated with the rest by the bit most correlated with the group."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())]
        left.discard(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(best)
            left.discard(best)
        out.append(tuple(sorted(group)))
    return out


def collisions(fps: DataFrame, chunks: Sequence[tuple[int, ...]]) -> list[float]:
    """For each chunk of at most ``CHUNK`` bits, the chance that two fingerprints agree on it: from the counts of its values in all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(c), np.int64) for c in chunks]
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint64)
            for c, count in zip(chunks, counts, strict=True):
                value = np.zeros(len(x), np.int64)
                for k, b in enumerate(c):
                    value |= ((x >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
                count += np.bincount(value, minlength=len(count))
        for k, count in enumerate(counts):
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(count[at])], ["chunk", "value", "n"])

    n = F.sum("n").cast("double")
    per = fps.mapInArrow(lean(run), "chunk int, value int, n long").groupBy("chunk", "value").agg(n.alias("n"))
    found = {r.chunk: r.both / max(r.total, 1.0) ** 2 for r in per.groupBy("chunk").agg(F.sum(F.col("n") * F.col("n")).alias("both"), F.sum("n").alias("total")).collect()}
    return [found.get(k, 1.0) for k in range(len(chunks))]


def allocate(n: float, agree: Sequence[float], differ: Sequence[Sequence[float]], radius: int = RADIUS) -> tuple[float, list[int]]:
    """Thresholds of the parts, and what they cost, by dynamic programming.

    Two fingerprints within ``radius`` are within a part's threshold in at least one
    part if the thresholds plus one sum to ``radius + 1``. Part i at threshold t costs
    the probes (n for each flip of up to t bits) plus the estimated candidates: n squared
    by the chance that two rows differ in at most t bits of it, from the chance
    ``agree[i]`` to agree and the chances ``differ[i]`` of each bit to differ.
    """

    def cost(i: int, t: int) -> float:
        if t < 0:
            return 0.0
        odds = [q / max(1 - q, 1e-9) for q in differ[i]]
        near, probes = 1.0, 1.0
        for k in range(1, t + 1):
            sums = [np.prod(c) for c in combinations(odds, k)]
            near, probes = near + float(sum(sums)), probes + len(sums)
        return n * probes + n * n * min(1.0, agree[i] * near)

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(agree)):
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, ts) in best.items():
            for t in range(-1, radius + 1 - spent):
                got = (total + cost(i, t), [*ts, t])
                if spent + t + 1 not in step or got[0] < step[spent + t + 1][0]:
                    step[spent + t + 1] = got
        best = step
    return best[radius + 1]


def plan(fps: DataFrame, radius: int = RADIUS, tries: Sequence[int] = (2, 3, 4)) -> list[Part]:
    """The cheapest of the partitions into ``tries`` groups, with its thresholds. Statistics cover all rows."""
    n, both = agreement(fps)
    groups = {m: correlated_groups(n, both, m) for m in tries}
    chunks = {(m, i): [g[k : k + CHUNK] for k in range(0, len(g), CHUNK)] for m, gs in groups.items() for i, g in enumerate(gs)}
    flat = [c for cs in chunks.values() for c in cs]
    chance = dict(zip(flat, collisions(fps, flat), strict=True))
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    plans = []
    for m, gs in groups.items():
        agree = [float(np.prod([chance[c] for c in chunks[m, i]])) for i in range(m)]
        cost, most = allocate(float(n), agree, [differ[list(g)] for g in gs], radius)
        plans.append((cost, m, [Part(g, t) for g, t in zip(gs, most, strict=True)]))
    return min(plans, key=lambda x: x[:2])[2]


# --- probe and verify ---------------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def flips(bits: Sequence[int], most: int) -> list[int]:
    """Masks of at most ``most`` of ``bits``, the empty one included."""
    return [_signed(sum(1 << b for b in c)) for k in range(most + 1) for c in combinations(bits, k)]


def links(fps: DataFrame, parts: Sequence[Part], radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """``(src, dst)`` whose components are those of all pairs of distinct ``fp`` that differ in at most ``radius`` bits.

    Values of a part held by at most ``hot`` fingerprints: probe, then verify; at most
    ``hot`` candidates a probe. Fingerprints that meet a value held by more: two within
    radius 2 have a common neighbour that differs from each in at most one bit, and any
    two with such a neighbour are within 2, so each of them is linked to the least
    fingerprint around each of its neighbours. That is ``BITS`` + 1 rows each and no
    pairs, however large the group.
    """
    if radius != 2:
        raise ValueError("the search without pairs is for radius 2")
    used = [(k, p) for k, p in enumerate(parts) if p.most >= 0]

    def keyed(variants: bool) -> Column:
        def of(k: int, p: Part) -> Column:
            mask = _signed(sum(1 << b for b in p.bits))
            masks = F.array(*(F.lit(m) for m in (flips(p.bits, p.most) if variants else [0])))
            return F.transform(masks, lambda m: F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseXOR(m).bitwiseAND(F.lit(mask)).alias("value")))

        return F.explode(F.concat(*(of(k, p) for k, p in used)))

    index = fps.select("fp", keyed(False).alias("k")).select("fp", "k.*")
    probe = index if all(p.most == 0 for _, p in used) else fps.select("fp", keyed(True).alias("k")).select("fp", "k.*")
    held = index.groupBy("part", "value").agg(F.count("*").alias("held"))
    cool = index.join(held.where(f"held <= {hot}"), ["part", "value"]).select("part", "value", F.col("fp").alias("dst"))
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius
    pairs = probe.select("part", "value", F.col("fp").alias("src")).join(cool, ["part", "value"]).where((F.col("src") < F.col("dst")) & near).select("src", "dst")
    crowded = probe.join(held.where(f"held > {hot}"), ["part", "value"], "left_semi").select("fp").distinct()
    around = crowded.select("fp", F.explode(F.array(*(F.lit(m) for m in flips(range(BITS), 1)))).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("centre"))
    least = around.groupBy("centre").agg(F.min("fp").alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = around.join(least, "centre").where("fp != dst").select(F.col("fp").alias("src"), "dst")
    return pairs.unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, hot: int = HOT, similar: tuple[int, int] | None = SIMILAR) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row a document.

    Documents link at a Jaccard similarity of ``similar`` or more of their sets of five-word
    shingles: what the fingerprints of these link is verified, and what they can't see is found by
    shared shingles (see ``jaccard``). If ``similar`` is None, fingerprints link at
    ``radius`` or fewer differing bits instead, as op 8 asks. ``component_id`` is the
    smallest doc_id reachable, itself included. Exact and near copies of equal
    fingerprint (of equal set) are one node, so copies never meet as pairs. Empty, blank and null
    texts have fingerprint zero and no shingles, and are alike; null doc_ids are passed
    over when the smallest is taken; an empty table gives no rows.
    """
    if similar is not None:
        kept: list[DataFrame] = []
        rooted = similar_groups(docs, kept, similar=similar).select("root", "doc_id", "at").distinct()
        lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        of_row = materialise(rooted.join(lowest, "root").select(F.col("doc_id").alias("__id"), F.col("at").alias("__at"), "component_id").distinct())
        released(kept)
        by_row = fingerprints(docs.select(F.struct("doc_id", F.xxhash64("text").alias("at")).alias("doc_id"), "text"), width)
        out = by_row.join(of_row, F.col("doc_id.doc_id").eqNullSafe(F.col("__id")) & (F.col("doc_id.at") == F.col("__at")))
        return out.select("doc_id.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    by_doc = materialise(fingerprints(docs, width))
    nodes = materialise(by_doc.groupBy("fp").agg(F.min("doc_id").alias("first")))
    edges = links(nodes.select("fp"), plan(nodes.select("fp"), radius), radius, hot)
    joined = connected_components(edges).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = nodes.join(joined, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = rooted.join(lowest, "root").select(F.col("fp").alias("__fp"), "component_id")
    return by_doc.join(of_fp, F.col("fp") == F.col("__fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``docs`` with one row of each group of near copies by Jaccard similarity: of the smallest doc_id.

    Rows are told apart by doc_id and text, so different texts under one doc_id are
    decided each by its own group. Rows of null doc_id stay, as nothing tells them apart.
    Of rows equal in both one stays, the same in every run. Only keys are grouped; texts are not shuffled
    unless the rows that go are too many to be broadcast.
    """
    stored: list[DataFrame] = []
    free_shuffles(docs.sparkSession)
    rooted, _ = compact(similar_groups(docs, stored, similar=similar).where("doc_id IS NOT NULL").groupBy("root", "doc_id", "at").agg(F.count("*").alias("n")))
    released(stored)
    first = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "at")).alias("k"))
    judged = rooted.join(first, "root").select(F.col("doc_id").alias("__id"), F.col("at").alias("__key"), "n", (F.struct("doc_id", "at") == F.col("k")).alias("kept"))
    given = docs.withColumn("__at", F.xxhash64("text"))
    own = (F.col("doc_id") == F.col("__id")) & (F.col("__at") == F.col("__key"))
    gone = small_side(judged.where("NOT kept OR n > 1").select("__id", "__key", "kept"))
    single = given.join(gone.select("__id", "__key"), own, "left_anti").drop("__at")
    repeated = given.join(gone.where("kept").select("__id", "__key"), own, "left_semi")
    row = F.struct(*docs.columns)
    repeated = repeated.groupBy("doc_id", "__at").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("r")).select("r.*")
    return single.unionAll(repeated)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), similar=None)
