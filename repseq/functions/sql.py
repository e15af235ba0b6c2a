"""The functions under SQL names: ``register(spark)``, then ``SELECT reverse_complement(seq) ...``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from repseq.functions import align, dna
from repseq.functions import motif as M

_CODONS = "map(" + ", ".join(f"'{c}', '{a}'" for c, a in dna.CODONS.items()) + ")"
_FROM, _TO = dna.IUPAC + dna.IUPAC.lower(), dna.COMPLEMENT + dna.COMPLEMENT.lower()

#: Native ones: SQL that the optimiser sees through.
NATIVE = {
    "reverse_complement(seq STRING) RETURNS STRING": f"reverse(translate(seq, '{_FROM}', '{_TO}'))",
    "trim_soft_ends(seq STRING) RETURNS STRING": f"trim(BOTH '{dna.SOFT_ENDS}' FROM seq)",
    "kmers(seq STRING, k INT) RETURNS ARRAY<STRING>": "CASE WHEN length(seq) >= k THEN transform(sequence(1, greatest(length(seq) - k + 1, 1)), i -> substring(seq, i, k)) ELSE array() END",
    "translate_protein(seq STRING) RETURNS STRING": f"CASE WHEN length(seq) >= 3 THEN array_join(transform(sequence(0, greatest(length(seq) div 3 - 1, 0L)), i -> coalesce(element_at({_CODONS}, upper(substring(seq, cast(i * 3 + 1 as int), 3))), 'X')), '') WHEN seq IS NOT NULL THEN '' END",
    "kmer_rows(seq STRING, k INT) RETURNS TABLE(pos INT, kmer STRING)": "SELECT pos, kmer FROM posexplode(CASE WHEN length(seq) >= k THEN transform(sequence(1, greatest(length(seq) - k + 1, 1)), i -> substring(seq, i, k)) ELSE array() END) AS t(pos, kmer)",
}


@F.pandas_udf(M.HITS)
def motif_hits(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Hits of a motif at the default scores and threshold."""
    for seqs, motifs in batches:
        out: list[list | None] = [None] * len(seqs)
        for m in motifs.dropna().unique():
            at = [k for k, (s, own) in enumerate(zip(seqs, motifs, strict=True)) if own == m and s is not None]
            for k, hits in zip(at, M.align_many([seqs.iloc[k] for k in at], m, M.default_threshold(m)), strict=True):
                out[k] = [{"begin": b, "end": e, "score": x} for b, e, x in hits]
        yield pd.Series(out)


def register(spark: SparkSession) -> list[str]:
    """Adds all to the session; their names."""
    for head, body in NATIVE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    udfs = {
        "local_align": align.udf_of(align.ALIGNED, align.align_local),
        "global_align": align.udf_of(align.ALIGNED, align.align_global),
        "align_edit_distance": align.udf_of("int", align.differing_columns),
        "motif_hits": motif_hits,
    }
    for name, f in udfs.items():
        spark.udf.register(name, f)
    return [h.split("(")[0] for h in NATIVE] + list(udfs)
