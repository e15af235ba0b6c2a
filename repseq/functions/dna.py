"""DNA scalar functions as Spark expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC codes and their complements, the soft-trim letters, the reader's alphabet.
IUPAC = "ACGTURYKMSWBDHVNX"
COMPLEMENT = "TGCAAYRMKSWVHDBNX"
SOFT_ENDS = "acgtn"
ALPHABET = "ACGTURYKMSWBDHVNX-"
#: The alphabet without V, as older readers have it.
COMPAT_ALPHABET = "ACGTURYKMSWBDHNX-"

# The standard genetic code, codons in the order TTT, TTC, TTA, TTG, TCT, ...
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): aa for c, aa in zip(product("TCAG", repeat=3), AMINO_ACIDS, strict=True)}


def reverse_complement(seq: Column) -> Column:
    """Case is kept; letters that are no IUPAC code stay as they are."""
    return F.reverse(F.translate(seq, IUPAC + IUPAC.lower(), COMPLEMENT + COMPLEMENT.lower()))


def trim_soft_ends(seq: Column) -> Column:
    """Lower-case acgtn cut from both ends; inside they stay."""
    return F.trim(seq, F.lit(SOFT_ENDS))


def is_ambiguous(seq: Column) -> Column:
    """An upper-case N is left."""
    return F.contains(seq, F.lit("N"))


def normalised(seq: Column) -> Column:
    """Upper case, without white space."""
    return F.upper(F.regexp_replace(seq, r"\s+", ""))


def is_valid(seq: Column, compat: bool = False) -> Column:
    """Not empty and of the alphabet only, whatever the case."""
    return F.upper(seq).rlike(f"^[{COMPAT_ALPHABET if compat else ALPHABET}]+$")


def header_id(header: Column) -> Column:
    """The first token."""
    return F.substring_index(F.trim(header), " ", 1)


def kmers(seq: Column, k: int) -> Column:
    """All substrings of length ``k``, in order; none if the sequence is shorter. Letters of one byte are cut by place; a substring of text would count letters from the start each time."""
    places = F.sequence(F.lit(1), F.greatest(F.length(seq) - k + 1, F.lit(1)))
    by_byte = F.transform(places, lambda i: F.substring(seq.cast("binary"), i, F.lit(k)).cast("string"))
    by_letter = F.transform(places, lambda i: F.substring(seq, i, F.lit(k)))
    every = F.when(F.octet_length(seq) == F.length(seq), by_byte).otherwise(by_letter)
    return F.when(F.length(seq) >= k, every).otherwise(F.array().cast("array<string>"))


def translate_protein(seq: Column, offset: int = 0) -> Column:
    """Amino acids from ``offset`` on; an unknown codon is X, a partial one is dropped."""
    table = F.create_map(*(F.lit(x) for pair in CODONS.items() for x in pair))
    n = F.floor((F.length(seq) - offset) / 3).cast("int")
    codon = lambda i: F.upper(F.substring(seq, i * 3 + offset + 1, F.lit(3)))
    acids = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.coalesce(F.element_at(table, codon(i)), F.lit("X")))
    return F.when(n >= 1, F.array_join(acids, "")).otherwise(F.lit(""))


def strip_gaps(seq: Column, trailing_only: bool = False) -> Column:
    return F.rtrim(seq, F.lit("-")) if trailing_only else F.replace(seq, F.lit("-"), F.lit(""))


def locate(seq: Column, part: Column) -> Column:
    """0-based place of the first occurrence, -1 if there is none."""
    return F.position(part, seq) - 1


def multiplicity(name: Column) -> Column:
    """The count in an id of the form ``Seq12_7``."""
    return F.split_part(name, F.lit("_"), F.lit(2)).cast("long")
