import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from repseq.functions import align as A
from repseq.functions import dna, motif
from repseq.sources import fasta


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_reverse_complement(spark):
    assert one(spark, "ACGTNacgt", dna.reverse_complement) == "acgtNACGT"
    assert one(spark, "RYKMSWBDHVX-.", dna.reverse_complement) == ".-XBDHVWSKMRY"
    for s in ("ACGTRYKMSWBDHVN", "", "acgtX"):
        assert one(spark, s, lambda c: dna.reverse_complement(dna.reverse_complement(c))) == s


def test_trim_and_filter(spark):
    assert one(spark, "acgACGTnACnn", dna.trim_soft_ends) == "ACGTnAC"
    assert one(spark, "ACnGT", dna.is_ambiguous) is False
    assert one(spark, "ACNGT", dna.is_ambiguous) is True
    assert one(spark, "acgt", dna.trim_soft_ends) == ""


def test_alphabet(spark):
    assert one(spark, "ACGV", dna.is_valid) is True
    assert one(spark, "ACGV", lambda c: dna.is_valid(c, compat=True)) is False
    assert one(spark, "", dna.is_valid) is False
    rows = fasta.validate_reads(spark.createDataFrame([("a", "ac\n gt"), ("", "A"), ("b", None), ("c", "A!")], "read_id string, seq string")).collect()
    assert [(r.norm_seq, r.valid) for r in rows] == [("ACGT", True), ("A", False), (None, False), ("A!", False)]


def test_kmers_cut_by_place(spark):
    assert one(spark, "Äb𝒞d", lambda c: dna.kmers(c, 2)) == ["Äb", "b𝒞", "𝒞d"]
    assert one(spark, "", lambda c: dna.kmers(c, 2)) == []
    assert one(spark, None, lambda c: dna.kmers(c, 2)) == []
    rows = spark.range(0, 20, 1, 1).select(F.concat(F.repeat(F.lit("ACGTTGCA"), 2500), F.col("id").cast("string")).alias("c"))
    began = time.perf_counter()
    last = rows.select(F.element_at(dna.kmers(F.col("c"), 21), -1).alias("k"), F.size(dna.kmers(F.col("c"), 21)).alias("n")).collect()
    assert last[19] == ("GCA" + "ACGTTGCA" * 2 + "19", 20_002 - 20) and last[0].n == 20_001 - 20
    assert time.perf_counter() - began < 12  # places counted from the start would take a second a row


def test_kmers_translate_gaps(spark):
    assert one(spark, "ACGT", lambda c: dna.kmers(c, 3)) == ["ACG", "CGT"]
    assert one(spark, "AC", lambda c: dna.kmers(c, 3)) == []
    assert one(spark, "TATTGTTGGGG", dna.translate_protein) == "YCW"
    assert one(spark, "ATAANTAA", lambda c: dna.translate_protein(c, 1)) == "*X"
    assert one(spark, "AT", dna.translate_protein) == ""
    assert one(spark, "A-C--", dna.strip_gaps) == "AC"
    assert one(spark, "A-C--", lambda c: dna.strip_gaps(c, True)) == "A-C"
    assert one(spark, "AACAAC", lambda c: dna.locate(c, F.lit("AAC"))) == 0
    assert one(spark, "Seq_5_17", dna.multiplicity) == 5


def test_codons():
    assert len(dna.CODONS) == 64 and sorted(set(dna.CODONS.values())) == sorted("*ACDEFGHIKLMNPQRSTVWY")
    assert motif.codons_of("W") == ["TGG"] and motif.codons_of("*") == ["TAA", "TAG", "TGA"]


def test_motif_language():
    assert motif.parse("YYC") == ["Y", "Y", "C"]
    assert motif.parse("W[GA][QKR]*") == ["W", "GA", "QKR", "*"]
    assert motif.parse("[W]C") == ["W", "C"]
    assert motif.default_threshold("YYC") == motif.default_threshold("WG[KQR]") == motif.default_threshold("[AC]G[KQR]") == 17
    for bad in ("", "YB", "W[]", "W[K", "K]", "Y1"):
        with pytest.raises(ValueError):
            motif.parse(bad)


CASES = [("TATTATTGT", [(0, 8, 18)]), ("TAGTTATTGT", [(0, 9, 17)]), ("TATATTGT", []), ("TATTAGTGT", []), ("GGTTATTATTGTGG", [(3, 11, 18)]), ("TATTAT", []), ("", [])]


@pytest.mark.parametrize(("seq", "hits"), CASES)
def test_motif_hits(spark, seq, hits):
    assert motif.align_hits(seq, "YYC", 17) == hits
    assert [tuple(h) for h in one(spark, seq, lambda c: motif.scan(c, "YYC"))] == hits


@pytest.mark.parametrize("name", ["YYC", "WG[KQR]", "L[SR]*", "GT[KQ]"])
def test_native_scan_equals_alignment(spark, name):
    rng = np.random.default_rng(5)
    core = [motif.codons_of(r)[0] for r in motif.parse(name)]
    seqs = []
    for k in range(120):
        s = "".join(rng.choice(list("ACGT"), rng.integers(0, 60)))
        hit = "".join(core)
        if k % 3 == 0:
            at = rng.integers(1, len(hit))
            hit = hit[:at] + rng.choice(list("ACGT")) + hit[at:]
        cut = rng.integers(0, len(s) + 1)
        seqs.append(s[:cut] + hit * (k % 2) + s[cut:])
    rows = spark.createDataFrame([(s,) for s in seqs], "s string").select("s", motif.scan(F.col("s"), name).alias("a"), motif.scan_general(F.col("s"), name).alias("b")).collect()
    for r in rows:
        assert sorted(map(tuple, r.a)) == sorted(map(tuple, r.b)), r.s


def test_lower_thresholds_find_partial_motifs():
    assert motif.align_hits("TATTAT", "YYC", 12) == [(0, 5, 12)]
    assert max(h[2] for h in motif.align_hits("TATTATTG", "YYC", 12)) == 16


def test_alignment():
    got = A.align_local("GGACGTGG", "TACGTA")
    assert (got.a, got.b, got.start_a, got.start_b, got.score) == ("ACGT", "ACGT", 2, 1, 4)
    got = A.align_global("ACGT", "AGT")
    assert (got.a, got.b, got.score) == ("ACGT", "A-GT", -2)
    assert A.differing_columns("ACGT", "AGT") == 1 and A.substitutions("ACGT", "AGT") == 0
    assert A.differing_columns("ACGT", "AGGT") == A.substitutions("ACGT", "AGGT") == 1
    assert A.align_global("", "AC").a == "--"
    got = A.align("ACGTA", "AGA", 0, -1, -2, mutual=False)
    assert len(got.a) == len(got.b) == 5 and got.a == "ACGTA" and got.score == -4
    with pytest.raises(ValueError):
        A.align("A", "AC", 0, -1, -2, mutual=False)


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_levenshtein_to_many(spark):
    rng = np.random.default_rng(2)
    seqs = ["", "A", *("".join(rng.choice(list("ACGT"), rng.integers(1, 30))) for _ in range(20))]
    for s in seqs:
        assert A.levenshtein_to(s, seqs).tolist() == [lev(s, t) for t in seqs]


def test_aligned_mismatches(spark):
    row = spark.createDataFrame([("AC-T", "AG-A")], "a string, b string").select(A.aligned_mismatches(F.col("a"), F.col("b")).alias("x"), A.aligned_mismatches(F.col("a"), F.lit("A-GA"), gaps=False).alias("y")).first()
    assert (row.x, row.y) == (2, 1)


def test_sql_names(spark):
    from repseq.functions.sql import register

    assert "kmer_rows" in register(spark)
    row = spark.sql("SELECT reverse_complement('ACGTNac') a, trim_soft_ends('acgACGTn') b, kmers('ACGT', 3) c, translate_protein('TATTGTTGGGG') d, global_align('ACGT', 'AGT').b e, align_edit_distance('ACGT', 'AGT') f, local_align('GGACGT', 'ACGT').start_a g, motif_hits('TATTATTGT', 'YYC')[0].score h, translate_protein('A') i").first()
    assert tuple(row) == ("gtNACGT", "ACGT", ["ACG", "CGT"], "YCW", "A-GT", 1, 2, 18, "")
    assert [tuple(r) for r in spark.sql("SELECT t.* FROM kmer_rows('ACGT', 3) t ORDER BY pos").collect()] == [(0, "ACG"), (1, "CGT")]
