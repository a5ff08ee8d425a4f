"""Derived attributes of a cell: one sample at one position.

A cell has the read counts c1..c8 (A T C G forward, then reverse).  Ranks are
packed integers, count * 8 + code, so that the greater count wins and, on ties,
the greater code; all of it stays inside generated code.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = [f"c{i}" for i in range(1, 9)]


def _ranked(counts: list[Column]) -> Column:
    return F.sort_array(F.array(*(n * 8 + i for i, n in enumerate(counts, 1))), asc=False)


def _sum(columns: list[Column]) -> Column:
    return reduce(add, columns)


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def attributes(cells: DataFrame) -> DataFrame:
    """cells with coverage, alleles, their counts and frequencies.

    Frequencies of the major allele are 0 in a cell without reads; that of the
    minor allele is null there.  Alleles are 0 without reads on the strand; a
    minor allele may have no read and still a code.
    """
    c = [F.col(x).cast("long") for x in COUNTS]
    both, fwd, rev = [c[i] + c[i + 4] for i in range(4)], c[:4], c[4:]
    df = cells.withColumns({"fwd_cov": _sum(fwd), "rev_cov": _sum(rev), "__b": _ranked(both), "__f": _ranked(fwd), "__r": _ranked(rev)})
    df = df.withColumn("cov", F.col("fwd_cov") + F.col("rev_cov"))

    def code(rank: str, i: int, live: Column) -> Column:
        return F.when(live, F.get(rank, F.lit(i)) % 8).otherwise(0).cast("int")

    def count(rank: str, i: int) -> Column:
        return F.shiftright(F.get(rank, F.lit(i)), 3)

    any_, f, r = F.col("cov") > 0, F.col("fwd_cov") > 0, F.col("rev_cov") > 0
    out = df.withColumns(
        {
            "counts_major": count("__b", 0),
            "counts_minor": count("__b", 1),
            "major_nt": code("__b", 0, any_),
            "minor_nt": code("__b", 1, any_),
            "major_freq": F.coalesce(ratio(count("__b", 0), F.col("cov")), F.lit(0.0)),
            "minor_freq": ratio(count("__b", 1), F.col("cov")),
            "major_nt_fwd": code("__f", 0, f),
            "major_nt_rev": code("__r", 0, r),
            "minor_nt_fwd": code("__f", 1, f & (count("__f", 1) > 0)),
            "minor_nt_rev": code("__r", 1, r & (count("__r", 1) > 0)),
            "counts_major_max": F.greatest(count("__f", 0), count("__r", 0)),
            "counts_minor_max": F.greatest(count("__f", 1), count("__r", 1)),
            "major_freq_fwd": F.coalesce(ratio(count("__f", 0), F.col("fwd_cov")), F.lit(0.0)),
            "major_freq_rev": F.coalesce(ratio(count("__r", 0), F.col("rev_cov")), F.lit(0.0)),
        }
    )
    return out.drop("__b", "__f", "__r")


def allele_count(calls: Column) -> Column:
    """An aggregate: how many distinct calls other than N."""
    return F.bit_count(F.coalesce(F.bit_or(F.when(calls > 0, F.call_function("shiftleft", F.lit(1), calls))), F.lit(0)))
