"""Nucleotides and codons as column expressions.

Bases are coded N=0 A=1 T=2 C=3 G=4; this order, not ACGT, rules all ties.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NTS = "NATCG"
#: The amino acids of the 64 codons, bases in the order TCAG.
#: The bacterial table differs from the standard one in its starts only.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): AMINO_ACIDS[i] for i, c in enumerate(product("TCAG", repeat=3))}


def nt_to_int(nt: Column) -> Column:
    """The code of a letter, either case; 0 for anything else."""
    up = F.upper(nt)
    return F.when(up == "A", 1).when(up == "T", 2).when(up == "C", 3).when(up == "G", 4).otherwise(0)


def int_to_nt(code: Column) -> Column:
    return F.substring(F.lit(NTS), F.coalesce(code, F.lit(0)).cast("int") + 1, F.lit(1))


def reverse_complement(sequence: Column) -> Column:
    """Unknown letters become N."""
    return F.translate(F.reverse(F.regexp_replace(F.upper(sequence), "[^ATCG]", "N")), "ATCG", "TAGC")


def complement(nt: Column) -> Column:
    return F.translate(nt, "ATCG", "TAGC")


def translate_codon(codon: Column) -> Column:
    """X where the codon holds an unknown base."""
    at = [F.instr(F.lit("TCAG"), F.substring(F.upper(codon), i, 1)) for i in (1, 2, 3)]
    place = (at[0] - 1) * 16 + (at[1] - 1) * 4 + at[2]
    whole = (F.length(codon) == 3) & (at[0] > 0) & (at[1] > 0) & (at[2] > 0)
    return F.when(whole, F.substring(F.lit(AMINO_ACIDS), place, F.lit(1))).otherwise("X")


def translate_cds(sequence: Column) -> Column:
    """A coding sequence's amino acids; a last part of a codon is left out."""
    n = F.floor(F.length(sequence) / 3).cast("int")
    return F.when(n < 1, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), n * 3, F.lit(3)), lambda i: translate_codon(F.substring(sequence, i, F.lit(3)))), "")
    )


def ordered_letters(text: Column) -> Column:
    """The distinct letters of a text, first seen first."""
    return F.array_join(F.array_distinct(F.split(text, "")), "")


def codons(spark: SparkSession) -> DataFrame:
    """codon, aa: 64 rows."""
    return spark.createDataFrame(sorted(CODONS.items()), "codon string, aa string")


def mutation_class(anc: Column, new: Column) -> Column:
    """One of the six classes of a substitution, strands taken together."""
    pair = F.concat(anc, new)
    out = F.lit(None).cast("string")
    for name in ("AT/TA", "AC/TG", "AG/TC", "GC/CG", "GT/CA", "GA/CT"):
        out = F.when(pair.isin(*name.split("/")), name).otherwise(out)
    return out
