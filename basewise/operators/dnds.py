"""Mutation spectra, codon usage, expected and observed dN/dS."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.functions.bases import CODONS, mutation_class
from basewise.functions.stats import beta_quantile

#: Fixed value: mutations from which the spectrum is taken as measured.
MEASURED_FROM = 100
CLASSES = ("AT/TA", "AC/TG", "AG/TC", "GC/CG", "GT/CA", "GA/CT")


def mutations(annotated: DataFrame) -> DataFrame:
    """group_id, p, anc_nt, new_nt, n_new, mutation_type: a row for each new letter of nts."""
    new = F.filter(F.split("nts", ""), lambda x: (x != F.col("anc_nt")) & x.isin("A", "T", "C", "G"))
    df = annotated.where((F.col("anc_nt") != ".") & F.col("nts").contains(F.col("anc_nt")))
    return df.select("group_id", "p", "anc_nt", "mutation_type", F.size(new).alias("n_new"), F.explode(new).alias("new_nt"))


def mutation_matrix(annotated: DataFrame) -> DataFrame:
    return mutations(annotated).groupBy("group_id", "anc_nt", "new_nt").agg(F.count(F.lit(1)).alias("n"))


def every_group(annotated: DataFrame, groups: DataFrame | None) -> DataFrame:
    """group_id, once each: of groups (samples, say), mutated or not; unless given, of annotated."""
    return (annotated if groups is None else groups).select("group_id").distinct()


def mutation_spectrum(annotated: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The six classes of each group with their counts, none left out."""
    classes = F.explode(F.array(*map(F.lit, CLASSES))).alias("class")
    counted = mutations(annotated).groupBy("group_id", mutation_class(F.col("anc_nt"), F.col("new_nt")).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    every = every_group(annotated, groups).select("group_id", classes)
    return every.join(counted, ["group_id", "class"], "left").select("group_id", "class", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def type_counts(annotated: DataFrame) -> DataFrame:
    """Positions of one new letter by group and mutation type."""
    return mutations(annotated).where("n_new = 1").groupBy("group_id", "mutation_type").agg(F.count(F.lit(1)).alias("n"))


def codon_usage(features: DataFrame) -> DataFrame:
    """codon, n over all coding sequences, in frame."""
    n = F.floor(F.length("sequence") / 3).cast("int")
    cut = F.transform(F.sequence(F.lit(1), n * 3, F.lit(3)), lambda i: F.substring(F.col("sequence"), i, F.lit(3)))
    df = features.where((F.col("type") == "CDS") & (F.length("sequence") >= 3)).select(F.explode(cut).alias("codon"))
    return df.where(F.col("codon").rlike("^[ATCG]{3}$")).groupBy("codon").agg(F.count(F.lit(1)).alias("n"))


def codon_mutations() -> list[tuple[str, str, str, int, int]]:
    """codon, base, new base, places of the base, changes of amino acid."""
    out = []
    for codon, aa in sorted(CODONS.items()):
        for base in sorted(set(codon)):
            for new in "ACGT":
                if new != base:
                    places = [i for i, c in enumerate(codon) if c == base]
                    out.append((codon, base, new, len(places), sum(CODONS[codon[:i] + new + codon[i + 1 :]] != aa for i in places)))
    return out


def expected_nonsynonymous(usage: DataFrame, spectrum: DataFrame) -> DataFrame:
    """group_id, p_nonsyn: the chance that a neutral mutation changes an amino acid.

    A group's spectrum is taken as measured from MEASURED_FROM mutations on, else
    as even.  Each class's share is split evenly over its two mutations; within
    a mutation codons weigh by their use and their places of the base.
    """
    spark = usage.sparkSession
    table = spark.createDataFrame(codon_mutations(), "codon string, base string, new string, places int, changes int")
    total = spectrum.groupBy("group_id").agg(F.sum("n").alias("total"))
    share = spectrum.join(total, "group_id").select("group_id", "class", F.when(F.col("total") >= MEASURED_FROM, F.col("n") / F.col("total")).otherwise(F.lit(1 / 6)).alias("share"))
    df = table.join(F.broadcast(usage), "codon").withColumn("class", mutation_class(F.col("base"), F.col("new")))
    one = df.groupBy("base", "new", "class").agg(F.try_divide(F.sum(F.col("changes") * F.col("n")).cast("double"), F.sum(F.col("places") * F.col("n")).cast("double")).alias("chance"))
    return share.join(F.broadcast(one), "class").groupBy("group_id").agg(F.sum(F.coalesce("chance", F.lit(0.0)) * F.col("share") / 2).alias("p_nonsyn"))


def observed_nonsynonymous(annotated: DataFrame, alpha: float = 0.05, groups: DataFrame | None = None) -> DataFrame:
    """group_id, n_nonsyn, n_syn, p_nonsyn and its exact binomial interval."""
    inside = annotated.where(F.col("gene_idx").isNotNull())
    n, s = F.count_if(F.col("mutation_type") == "N"), F.count_if(F.col("mutation_type") == "S")
    df = every_group(annotated, groups).join(inside.groupBy("group_id").agg(n.alias("n_nonsyn"), s.alias("n_syn")), "group_id", "left").na.fill(0, ["n_nonsyn", "n_syn"])
    df = df.withColumn("p_nonsyn", F.coalesce(F.try_divide(F.col("n_nonsyn").cast("double"), (F.col("n_nonsyn") + F.col("n_syn")).cast("double")), F.lit(0.0)))

    @F.pandas_udf("low double, high double")
    def interval(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in batches:
            yield pd.DataFrame([binomial_interval(int(a), int(a + b), alpha) for a, b in zip(x, y, strict=True)], columns=["low", "high"])

    return df.withColumn("ci", interval("n_nonsyn", "n_syn")).select("group_id", "n_nonsyn", "n_syn", "p_nonsyn", F.col("ci.low").alias("ci_low"), F.col("ci.high").alias("ci_high"))


def binomial_interval(x: int, n: int, alpha: float = 0.05) -> tuple[float, float]:
    """Clopper-Pearson bounds; at the edges one-sided; (0, 0) of nothing."""
    if n == 0:
        return 0.0, 0.0
    if x == 0:
        return 0.0, 1 - (alpha / 2) ** (1 / n)
    if x == n:
        return (alpha / 2) ** (1 / n), 1.0
    return beta_quantile(alpha / 2, x, n - x + 1), beta_quantile(1 - alpha / 2, x + 1, n - x)


def odds(p: str) -> Column:
    return F.try_divide(F.col(p), 1 - F.col(p))


def dnds(annotated: DataFrame, features: DataFrame, alpha: float = 0.05, groups: DataFrame | None = None) -> DataFrame:
    """A row a group (see every_group): observed and expected odds of a change, their ratio, its bounds."""
    expected = expected_nonsynonymous(codon_usage(features), mutation_spectrum(annotated, groups)).select("group_id", F.col("p_nonsyn").alias("p_expected"))
    df = observed_nonsynonymous(annotated, alpha, groups).join(expected, "group_id")
    ratios = {name: F.try_divide(odds(p), odds("p_expected")) for name, p in (("dnds", "p_nonsyn"), ("dnds_low", "ci_low"), ("dnds_high", "ci_high"))}
    return df.withColumns(ratios)
