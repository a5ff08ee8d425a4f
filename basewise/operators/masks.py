"""Filters of calls: element, sample and position masks, and their tokens.

Masks never change a column; each stage adds one, call_<stage>, where masked
calls are 0.  The order is quality, strand coverage, major-allele frequency,
indels, fraction N, median coverage, copy number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.functions.cells import allele_count, ratio
from basewise.operators.coverage import chromosome_median

STAGES = ("qual", "cov", "maf", "indel", "mfas", "mmcp", "cpn")
SITE = ["group_id", "p"]


@dataclass(frozen=True)
class FilterParams:
    """Thresholds of the masks."""

    min_qual: int = 30
    min_strand_cov: int = 5
    min_major_freq: float = 0.85
    max_indel: float = 0.33
    max_frac_n: float = 1.0
    min_median_cov: float = 5.0
    max_mean_copy: float = 4.0
    max_max_copy: float = 7.0


def mask(call: Column, bad: Column) -> Column:
    """The call, or N where bad; an unknown condition masks nothing."""
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(0)).otherwise(call)


def indel_fraction() -> Column:
    return F.coalesce(ratio(F.col("ins") + F.col("del"), F.col("cov")), F.lit(0.0))


def element_masks(cells: DataFrame, params: FilterParams) -> DataFrame:
    """call_start, then the four element stages."""
    stages = {
        "qual": F.col("qual") < params.min_qual,
        "cov": (F.col("fwd_cov") < params.min_strand_cov) | (F.col("rev_cov") < params.min_strand_cov),
        "maf": F.col("major_freq") < params.min_major_freq,
        "indel": indel_fraction() > params.max_indel,
    }
    out, last = cells.withColumn("call_start", F.col("major_nt")), "start"
    for name, bad in stages.items():
        out, last = out.withColumn(f"call_{name}", mask(F.col(f"call_{last}"), bad)), name
    return out


def copy_numbers(cells: DataFrame, coverage: DataFrame, contigs: DataFrame) -> DataFrame:
    """cells with their sample's chromosomal median and copy number.

    copy is null where the median is 0; copy_inf tells x / 0 from 0 / 0.
    """
    median = chromosome_median(coverage, contigs).select("group_id", "sample_id", F.col("median_cov").alias("chrom_median"))
    df = cells.join(F.broadcast(median), ["group_id", "sample_id"], "left")
    zero = F.coalesce(F.col("chrom_median"), F.lit(0.0)) == 0
    return df.withColumns({"copy": ratio(F.col("cov"), F.col("chrom_median")), "copy_inf": zero & (F.col("cov") > 0), "copy_nan": zero & (F.col("cov") == 0)})


def site_copy(prefix: str = "") -> dict[str, Column]:
    """Aggregates: mean and greatest copy number of a position.

    A 0 / 0 among the samples makes both 0; else an x / 0 makes both infinite.
    """
    nan, inf = F.max("copy_nan"), F.max("copy_inf")

    def fixed(x: Column) -> Column:
        return F.when(nan, F.lit(0.0)).when(inf, F.lit(float("inf"))).otherwise(x)

    return {f"{prefix}mean_copy": fixed(F.avg("copy")), f"{prefix}max_copy": fixed(F.max("copy"))}


def apply_masks(cells: DataFrame, coverage: DataFrame, contigs: DataFrame, params: FilterParams = FilterParams()) -> DataFrame:
    """All seven stages: one aggregate by position, joined back."""
    df = copy_numbers(element_masks(cells, params), coverage, contigs)
    site = df.groupBy(*SITE).agg(
        F.avg((F.col("call_indel") == 0).cast("double")).alias("frac_n"),
        F.median("cov").alias("median_cov"),
        *(v.alias(k) for k, v in site_copy().items()),
    )
    df = df.join(site, SITE)
    df = df.withColumn("call_mfas", mask(F.col("call_indel"), F.col("frac_n") > params.max_frac_n))
    df = df.withColumn("call_mmcp", mask(F.col("call_mfas"), F.col("median_cov") < params.min_median_cov))
    over = (F.col("mean_copy") > params.max_mean_copy) | (F.col("max_copy") > params.max_max_copy)
    return df.withColumn("call_cpn", mask(F.col("call_mmcp"), over))


def extra_masks(cells: DataFrame, call: str, params: FilterParams = FilterParams()) -> DataFrame:
    """cells with extra_call: strand coverage and indels, then, of what they
    leave, the fraction of N and the median coverage of the position."""
    bad = (F.col("fwd_cov") < params.min_strand_cov) | (F.col("rev_cov") < params.min_strand_cov) | (indel_fraction() > params.max_indel)
    df = cells.withColumn("extra_call", mask(F.col(call), bad))
    site = df.groupBy(*SITE).agg(F.avg((F.col("extra_call") == 0).cast("double")).alias("__n"), F.median("cov").alias("__cov"))
    over = (F.col("__n") > params.max_frac_n) | (F.col("__cov") < params.min_median_cov)
    return df.join(site, SITE).withColumn("extra_call", mask(F.col("extra_call"), over)).drop("__n", "__cov")


def mask_samples(cells: DataFrame, call: str, lost: DataFrame) -> DataFrame:
    """cells with sample_call: all calls of the samples in lost are N."""
    held = lost.select("group_id", "sample_id", F.lit(True).alias("__lost")).distinct()
    return cells.join(F.broadcast(held), ["group_id", "sample_id"], "left").withColumn("sample_call", mask(F.col(call), F.col("__lost"))).drop("__lost")


def filter_tokens(masked: DataFrame) -> DataFrame:
    """A token per stage and position, by one aggregate.

    0: two alleles before and after; 1: lost here; -1: lost before.
    """
    names = ("start", *STAGES)
    site = masked.groupBy(*SITE).agg(*((allele_count(F.col(f"call_{s}")) >= 2).alias(s) for s in names))
    tokens = [
        F.when(F.col(a) & F.col(b), 0).when(F.col(a), 1).otherwise(-1).alias(f"{b}_filter") for a, b in zip(names[:-1], names[1:], strict=True)
    ]
    return site.select(*SITE, *tokens)


def fix_token(tokens: DataFrame, good: DataFrame) -> DataFrame:
    """tokens with fix_filter: the last stage's, 0 becoming 1 off the good positions."""
    marked = good.select(*SITE, F.lit(True).alias("__good")).distinct()
    last = F.col(f"{STAGES[-1]}_filter")
    return tokens.join(marked, SITE, "left").withColumn("fix_filter", F.when((last == 0) & F.col("__good").isNull(), 1).otherwise(last)).drop("__good")


def polymorphic(cells: DataFrame, call: str) -> DataFrame:
    """Positions with two distinct calls other than N."""
    return cells.groupBy(*SITE).agg(allele_count(F.col(call)).alias("n_alleles")).where("n_alleles >= 2")


def drop_monomorphic(cells: DataFrame, call: str) -> DataFrame:
    return cells.join(polymorphic(cells, call).select(*SITE), SITE, "left_semi")


def keep_samples(cells: DataFrame, keep: DataFrame) -> DataFrame:
    return cells.join(keep.select("group_id", "sample_id").distinct(), ["group_id", "sample_id"], "left_semi")


def drop_samples(cells: DataFrame, lost: DataFrame) -> DataFrame:
    return cells.join(lost.select("group_id", "sample_id").distinct(), ["group_id", "sample_id"], "left_anti")


def keep_positions(cells: DataFrame, keep: DataFrame) -> DataFrame:
    return cells.join(keep.select(*SITE).distinct(), SITE, "left_semi")


def drop_positions(cells: DataFrame, lost: DataFrame) -> DataFrame:
    return cells.join(lost.select(*SITE).distinct(), SITE, "left_anti")


def fraction_n(cells: DataFrame, call: str, by: str) -> DataFrame:
    """The share of N calls by "p" or "sample_id"."""
    return cells.groupBy("group_id", by).agg(F.avg((F.col(call) == 0).cast("double")).alias("frac_n"))


def good_samples_by_coverage(coverage: DataFrame, contigs: DataFrame, least: float = 0.0) -> DataFrame:
    """Samples whose chromosomal median reaches least."""
    return chromosome_median(coverage, contigs).where(F.col("median_cov") >= least)


def good_samples_by_n(cells: DataFrame, call: str, most: float = 1.0) -> DataFrame:
    """Samples with a share of N of at most most; outgroups always stay."""
    share = cells.groupBy("group_id", "sample_id").agg(F.avg((F.col(call) == 0).cast("double")).alias("frac_n"), F.max("in_outgroup").alias("in_outgroup"))
    return share.where((F.col("frac_n") <= most) | F.col("in_outgroup"))


def strand_conflict() -> Column:
    """Both strands have reads and disagree on the major allele."""
    f, r = F.col("major_nt_fwd"), F.col("major_nt_rev")
    return (f != r) & (f > 0) & (r > 0)


def tree_calls(cells: DataFrame, min_cov: int = 1, min_qual: int = 30, min_freq: float = 0.75) -> DataFrame:
    """Loose calls for trees and for filling N."""
    bad = (F.col("cov") < min_cov) | (F.col("qual") < min_qual) | (F.col("major_freq") < min_freq)
    return cells.withColumn("tree_call", mask(F.col("major_nt"), bad))
