"""CDR3 candidates and choice, natively: hits of a read are arrays on its row, so no join and no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repseq.functions import motif as M

#: Distance of the two motifs, and the motifs of a heavy chain's CDR3.
NEAREST, FARTHEST = 30, 90
STARTS, ENDS = ("YYC",), ("WG[QKR]",)


def motif_hits(seq: Column, motifs: Sequence[str]) -> Column:
    """Hits of all motifs, with the motif's number: ``array<struct<motif,begin,end,score>>``."""
    of = lambda k, m: F.transform(M.scan(seq, m), lambda h: F.struct(F.lit(k).alias("motif"), h.begin.alias("begin"), h.end.alias("end"), h.score.alias("score")))
    return F.flatten(F.array(*(of(k, m) for k, m in enumerate(motifs))))


def candidates(seq: Column, starts: Column, ends: Column, nearest: int = NEAREST, farthest: int = FARTHEST) -> Column:
    """All pairs of a start in the second half of the read and an end ``nearest`` to ``farthest`` bases on, in order of start, then end."""
    half = F.floor(F.length(seq) / 2)

    def of(s: Column) -> Column:
        distance = lambda e: e.begin - s.begin
        reach = F.filter(ends, lambda e: (distance(e) >= nearest) & (distance(e) <= farthest))
        return F.transform(reach, lambda e: F.struct(s.motif.alias("start_motif"), s.begin.alias("begin"), e.motif.alias("end_motif"), e.begin.alias("stop"), (s.score + e.score).alias("score")))

    return F.flatten(F.transform(F.filter(starts, lambda s: s.begin > half), of))


def with_cdr3(reads: DataFrame, starts: Sequence[str] = STARTS, ends: Sequence[str] = ENDS, seq: str = "seq") -> DataFrame:
    """``reads`` plus ``cdr``, ``cdr_begin``, ``cdr_score``; null where there is no candidate.

    The candidate of the highest score, of equals the first by start motif, start, end
    motif and end. The CDR holds the start motif but not the end motif.
    """
    s = F.col(seq)
    once = lambda x, name: F.explode(F.array(x)).alias(name)  # noqa: E731  a row stays a row, but no filter on what is found moves the search below it
    hits = reads.select("*", once(F.struct(motif_hits(s, starts).alias("starts"), motif_hits(s, ends).alias("ends")), "__hits"))
    key = lambda c: F.struct((-c.score).alias("a"), c.start_motif.alias("b"), c.begin.alias("c"), c.end_motif.alias("d"), c.stop.alias("e"))
    pairs = candidates(s, F.col("__hits.starts"), F.col("__hits.ends"))
    best = hits.select("*", once(F.array_min(F.transform(pairs, key)), "__best"))
    cdr = F.substring(s, F.col("__best.c") + 1, F.col("__best.e") - F.col("__best.c"))
    return best.select(*reads.columns, cdr.alias("cdr"), F.col("__best.c").alias("cdr_begin"), (-F.col("__best.a")).alias("cdr_score"))


def cdr_weights(found: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Reads and unique reads of each CDR."""
    return found.where("cdr IS NOT NULL").groupBy(*keys, "cdr").agg(F.sum("qty").cast("long").alias("weight"), F.count("*").alias("n_unique"))


def cdr_rank(weights: DataFrame) -> DataFrame:
    """Place of each CDR in its sample, by weight, of equals by CDR."""
    return weights.withColumn("rank", F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("weight"), "cdr")).cast("long"))


def hit_islands(hits: DataFrame, key: str = "read_id") -> DataFrame:
    """Of neighbours (by ``ord``) of one begin, the first of the best score."""
    order = Window.partitionBy(key).orderBy("ord")
    turned = hits.withColumn("__new", F.coalesce((F.col("begin") != F.lag("begin").over(order)).cast("int"), F.lit(1)))
    island = turned.withColumn("__island", F.sum("__new").over(order))
    best = Window.partitionBy(key, "__island").orderBy(F.desc("score"), "ord")
    return island.withColumn("__n", F.row_number().over(best)).where("__n = 1").select(*hits.columns)
