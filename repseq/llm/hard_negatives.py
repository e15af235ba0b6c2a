"""Hard negatives by maximum inner product, searched exactly through a pivot table.

A vector x of length |x| <= M is augmented by sqrt(M^2 - |x|^2) and a query by 0. Then
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so inner products fall as Euclidean distances rise,
and the triangle inequality over distances to a few pivots brackets every score. Rows are
packed into bins of near ones with the least and greatest distance to each pivot; a bin whose
bracket misses what an anchor still seeks is passed over, the others are checked exactly in integers.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repseq.llm.textcore import lean
from repseq.operators.numbering import numbered
from repseq.operators.shared import checkpoint_dir, materialise, small_batches

SCALE = 256
LABELS = 10
POSITIVES, NEGATIVES = 5, 10
#: Least and greatest score of a negative, in hundredths of the positive's.
BAND = (30, 90)
#: Distances stored of each row; rows of a bin; rows that the pivots are drawn from and that say where searches may begin.
PIVOTS, BIN, SAMPLE = 8, 64, 2048
#: Rows that a task holds to cut bins from.
BIN_FROM = 1 << 15
#: Anchors searched at a time: what is broadcast has at most so many vectors.
ANCHORS = 1024
#: Largest squared length of a vector: by Cauchy-Schwarz all its inner products with others of the kind fit 64 bits.
LONGEST = float(1 << 62)


def prepared(vectors: DataFrame, flip: Column | None = None) -> DataFrame:
    """``(vec_id, label, v)`` of the rows that take part: ``v`` = floor(256 x) of each component as long; where ``flip`` holds the label moves on by one modulo 10."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * float(SCALE)))
    length = F.aggregate(F.transform(x, lambda c: F.pow(F.floor(c.cast("double") * float(SCALE)).cast("double"), F.lit(2.0))), F.lit(0.0), lambda a, c: a + c)
    label = F.col("label") if flip is None else F.when(flip, F.pmod(F.col("label") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    taking = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(taking, label).cast("long").alias("label"), F.when(taking, whole).alias("v"), F.when(taking, length).alias("length"))
    return rows.where(F.col("v").isNotNull() & (F.col("length") < LONGEST))


# --- the pivot table ----------------------------------------------------------------


@dataclass
class Pivots:
    """Pivots of each dimension, in augmented space; ``m2`` is the square of the greatest length."""

    m2: float
    at: dict[int, np.ndarray] = field(default_factory=dict)

    def augmented(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        return np.hstack([x, np.sqrt(np.maximum(self.m2 - (x * x).sum(axis=1, keepdims=True), 0))])

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Of augmented points to the pivots of their dimension."""
        p = self.at.get(points.shape[1] - 1)
        if p is None:  # a dimension that the sample has not met: the origin stands in
            p = np.zeros((1, points.shape[1]))
        square = (points * points).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2 * points @ p.T
        return np.sqrt(np.maximum(square, 0))


def farthest_first(points: np.ndarray, k: int) -> np.ndarray:
    """``k`` points, each the one farthest from those before; the first is the one farthest from the mean."""
    near = ((points - points.mean(axis=0)) ** 2).sum(axis=1)
    chosen: list[int] = []
    while len(chosen) < min(k, len(points)):
        chosen.append(int(near.argmax()))
        d = ((points - points[chosen[-1]]) ** 2).sum(axis=1)
        near = d if len(chosen) == 1 else np.minimum(near, d)
    return points[chosen]


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists of a column, and all their numbers in a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.value_lengths(), np.int64), np.asarray(column.flatten(), np.int64)


def by_dimension(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each dimension: it, the places of its rows, and their matrix."""
    size, flat = vectors_of(column)
    begin = np.concatenate([[0], np.cumsum(size)])
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        yield d, at, flat[begin[at][:, None] + np.arange(d)]


def gathered(batches: Iterator[pa.RecordBatch], rows: int = BIN_FROM) -> Iterator[pa.Table]:
    """Batches put together until they have ``rows`` rows: bins are nearer together when they are cut from more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


_BIN = "dim int, ids binary, labels binary, v binary, low array<double>, high array<double>"
_BIN_SCHEMA = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("v", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])


def pivot_table(rows: DataFrame, pivots: Pivots, size: int = BIN) -> DataFrame:
    """Bins of rows: ids, labels, vectors, and the least and greatest distance to each pivot. Kept in the shared folder; rows are not shuffled, each partition is binned by itself."""

    @lean
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            ids, labels = (batch.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
            out: dict[str, list] = {c: [] for c in _BIN_SCHEMA.names}
            for d, at, v in by_dimension(batch.column("v")):
                far = pivots.distances(pivots.augmented(v))
                order = np.lexsort([far.min(axis=1), far.argmin(axis=1)])
                for lo in range(0, len(order), size):
                    own = order[lo : lo + size]
                    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.abs(v[own]).max(initial=0) <= np.iinfo(k).max)
                    cells = [d, ids[at[own]].tobytes(), labels[at[own]].tobytes(), v[own].astype(kind).tobytes(), far[own].min(axis=0).tolist(), far[own].max(axis=0).tolist()]
                    for c, x in zip(out, cells, strict=True):
                        out[c].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=_BIN_SCHEMA)

    return materialise(rows.select("vec_id", "label", "v").mapInArrow(build, _BIN))


# --- searching ----------------------------------------------------------------------


@dataclass
class Sought:
    """Anchors of one dimension (``place``: their numbers), with what each looks for: scores from ``low`` to ``high`` (a column a positive, or one), of rows of its label or of others."""

    place: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    low: np.ndarray
    high: np.ndarray
    far: np.ndarray
    top: int
    same: bool

    def reach(self, pivots: Pivots, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Flags (anchors, bins): the bracket of a bin's scores meets what the anchor seeks."""
        lower, upper = np.zeros((len(self.ids), len(low))), np.full((len(self.ids), len(low)), np.inf)
        for k in range(self.far.shape[1]):
            d = self.far[:, k : k + 1]
            np.maximum(lower, np.maximum(low[None, :, k] - d, d - high[None, :, k]), out=lower)
            np.minimum(upper, d + high[None, :, k], out=upper)
        own = (self.v.astype(np.float64) ** 2).sum(axis=1)[:, None] + pivots.m2
        slack = 1e-6 * own + 1  # for rounding of distances; scores are checked exactly
        most, least = (own - np.maximum(lower, 0) ** 2) / 2 + slack, (own - upper**2) / 2 - slack
        return (most >= self.low.min(axis=1)[:, None]) & (least <= self.high.max(axis=1)[:, None])

    def scores(self, some: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Exact integer inner products: in doubles where every sum is a whole number that they hold."""
        q = self.v[some]
        if math.sqrt(float((q.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) * math.sqrt(float((v.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) < 1 << 52:
            return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
        return q.astype(np.int64) @ v.astype(np.int64).T


class Best:
    """The best rows so far of each (anchor, column of what it seeks)."""

    def __init__(self, sought: Sought):
        self.s = sought
        self.held: list[tuple[np.ndarray, ...]] = []
        self.rows = 0
        self.floor = sought.low.copy()

    def add(self, some: np.ndarray, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        s = self.s
        kin = labels[None, :] == s.labels[some][:, None]
        fit = kin & (ids[None, :] != s.ids[some][:, None]) if s.same else ~kin
        for k in range(s.low.shape[1]):
            i, j = np.nonzero(fit & (scores >= self.floor[some, k : k + 1]) & (scores <= s.high[some, k : k + 1]))
            if len(i):
                self.held.append((some[i] * s.low.shape[1] + k, scores[i, j], ids[j]))
                self.rows += len(i)
        if self.rows > 4 * s.low.size * s.top + 100_000:
            self.cut()

    def cut(self) -> None:
        """Keeps the first of each, and raises the floor to the last of them."""
        if not self.held:
            return
        key, score, ids = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort([ids, -score, key])
        key, score, ids = key[order], score[order], ids[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        keep = rank < self.s.top
        full = rank == self.s.top - 1
        self.floor.reshape(-1)[key[full]] = score[full]
        self.held, self.rows = [(key[keep], score[keep], ids[keep])], int(keep.sum())

    def found(self) -> tuple[np.ndarray, ...]:
        self.cut()
        return self.held[0] if self.held else (np.zeros(0, np.int64),) * 3


_FOUND = "anchor long, column int, score long, id long"
_FOUND_SCHEMA = pa.schema([("anchor", pa.int64()), ("column", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def searched(table: DataFrame, pivots: Pivots, sought: dict[int, Sought], top: int) -> DataFrame:
    """``(anchor, column, score, id, rank)``: of each anchor (a number) and column the first ``top`` rows by score, then id."""
    sent = table.sparkSession.sparkContext.broadcast((pivots, sought))

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, sought = sent.value
        best = {d: Best(s) for d, s in sought.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d, s in sought.items():
                at = np.flatnonzero(dims == d)
                if not len(at):
                    continue
                low, high = (np.array(batch.column(c).take(pa.array(at)).to_pylist(), np.float64) for c in ("low", "high"))
                near = s.reach(pivots, low, high)
                for j, k in enumerate(at.tolist()):
                    some = np.flatnonzero(near[:, j])
                    if not len(some):
                        continue
                    ids, labels = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in ("ids", "labels"))
                    raw = batch.column("v")[k].as_buffer()
                    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[raw.size // (len(ids) * d)] if d else np.int8
                    v = np.frombuffer(raw, kind).reshape(len(ids), d)
                    best[d].add(some, ids, labels, s.scores(some, v))
        for d, b in best.items():
            key, score, ids = b.found()
            wide = sought[d].low.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(sought[d].place[key // wide]), pa.array((key % wide).astype(np.int32)), pa.array(score), pa.array(ids)], schema=_FOUND_SCHEMA)

    rows = table.mapInArrow(search, _FOUND)
    first = Window.partitionBy("anchor", "column").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)


# --- hard negatives -----------------------------------------------------------------

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Anchors:
    """Anchors of one pass, by dimension, and the sample's rows of that dimension, whose scores say where a search may begin."""

    def __init__(self, rows: pa.Table, sample: pa.Table, pivots: Pivots):
        self.pivots = pivots
        self.ids, self.labels = (rows[c].to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        self.parts = list(by_dimension(rows["v"]))
        ids, labels = (sample[c].to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        self.sample = {d: (ids[at], labels[at], v) for d, at, v in by_dimension(sample["v"])}

    def sought(self, bounds, top: int, same: bool) -> dict[int, Sought]:
        """``bounds``: places -> low and high (rows, columns). Low rises to the ``top``-th best score that the sample has in them."""
        out = {}
        for d, at, v in self.parts:
            low, high = bounds(at)
            s = Sought(at, self.ids[at], self.labels[at], v, low, high, self.pivots.distances(np.hstack([v.astype(np.float64), np.zeros((len(v), 1))])), top, same)
            if d in self.sample:
                ids, labels, known = self.sample[d]
                best = Best(s)
                best.add(np.arange(len(at)), ids, labels, s.scores(np.arange(len(at)), known))
                best.cut()
                s.low = best.floor
            out[d] = s
        return out


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND, chunk: int = ANCHORS, sample_rows: int = SAMPLE, pivots: int = PIVOTS, size: int = BIN) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``rows`` (vec_id, label, v: whole numbers).

    Scores are integer inner products, higher first, ties by the smaller vec_id. Positives of an
    anchor are its first ``positives`` rows of its label with another vec_id; negatives of both are the first
    ``negatives`` rows of another label with ``band[0]`` * positive <= 100 * score <= ``band[1]`` * positive.

    Defined results: rows of different length have no score with one another. Repeated rows are rows of
    their own as positives and negatives; equal anchor rows are one anchor. A positive of a score below 0
    has no negatives, one of 0 those of score 0. An empty table, or none with anchors, gives no rows.

    Every row is compared, by its bin's bracket or exactly, with every anchor. Anchors are numbered and
    searched ``chunk`` at a time: that many vectors and their positives pass through the driver and are
    broadcast, never more. Each pass reads the stored table twice and adds its rows to a table in the shared
    folder. The sample (``sample_rows`` rows in order of a hash) gives pivots and first lower bounds; it changes cost, never rows.
    """
    spark = small_batches(rows.sparkSession)
    m2 = rows.agg(F.max("length")).first()[0] or 0.0
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label").limit(sample_rows).select("vec_id", "label", "v").toArrow()
    places = Pivots(m2)
    for d, _, v in by_dimension(sample["v"]):
        places.at[d] = farthest_first(places.augmented(v), pivots)
    table = pivot_table(rows, places, size)
    anchors = numbered(rows.where(is_anchor).select("vec_id", "label", "v").distinct(), [], ["vec_id", "label"], "n")
    passes = -(-(anchors.agg(F.max("n") + 1).first()[0] or 0) // chunk)
    folder = f"{checkpoint_dir(spark)}/negatives-{uuid.uuid4().hex}"
    for k in range(passes):
        own = Anchors(anchors.where((F.col("n") >= k * chunk) & (F.col("n") < (k + 1) * chunk)).orderBy("n").select("vec_id", "label", "v").toArrow(), sample, places)
        every = lambda at: (np.full((len(at), 1), _LEAST), np.full((len(at), 1), _MOST))
        near = searched(table, places, own.sought(every, positives, True), positives).toPandas()
        score = np.zeros((len(own.ids), positives), np.int64)
        known = np.zeros(score.shape, bool)
        at = near["anchor"].to_numpy(), near["rank"].to_numpy() - 1
        score[at], known[at] = near["score"].to_numpy(), True
        low, high = np.full(score.shape, _MOST), np.full(score.shape, _LEAST)
        for i, j in zip(*np.nonzero(known), strict=True):  # whole numbers of any size
            p = int(score[i, j])
            low[i, j], high[i, j] = -(-band[0] * p // 100), band[1] * p // 100
        far = searched(table, places, own.sought(lambda at, low=low, high=high: (low[at], high[at]), negatives, False), negatives)
        pairs = [(int(a), int(r) - 1, int(own.ids[a]), int(i), int(s)) for a, r, i, s in zip(near["anchor"], near["rank"], near["id"], near["score"], strict=True)]
        pairs = spark.createDataFrame(pairs, "a int, c int, anchor_id long, positive_id long, positive_score long")
        met = far.join(F.broadcast(pairs), (F.col("anchor") == F.col("a")) & (F.col("column") == F.col("c")))
        met.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(folder)
    return spark.read.schema(_OUT).parquet(folder) if passes else spark.createDataFrame([], _OUT)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives(prepared(vectors, F.pmod(F.col("vec_id"), F.lit(7)) == 0), F.pmod(F.col("vec_id"), F.lit(100)) == 0)


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS nth
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE nth <= 10
"""
