"""Coverage: medians, copy number, traces, double normalisation.

coverage is (group_id, sample_id, p, cov), dense: a position without reads is a
row of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.cells import ratio

SAMPLE = ["group_id", "sample_id"]


def with_contig(positions: DataFrame, contigs: DataFrame) -> DataFrame:
    """positions with contig_idx and contig_pos, by a range join.

    Contigs are the rows of one reference genome, a few thousand at most.
    """
    c = contigs.select("contig_idx", "contig_start", "contig_len")
    on = (F.col("p") >= F.col("contig_start")) & (F.col("p") < F.col("contig_start") + F.col("contig_len"))
    return positions.join(F.broadcast(c), on).withColumn("contig_pos", F.col("p") - F.col("contig_start") + 1).drop("contig_start", "contig_len")


def to_global(positions: DataFrame, contigs: DataFrame) -> DataFrame:
    """(contig_idx, contig_pos) with p."""
    c = contigs.select("contig_idx", "contig_start")
    return positions.join(F.broadcast(c), "contig_idx").withColumn("p", F.col("contig_start") + F.col("contig_pos") - 1).drop("contig_start")


def contig_medians(coverage: DataFrame, contigs: DataFrame) -> DataFrame:
    """Exact median coverage of each sample on each contig."""
    return with_contig(coverage, contigs).groupBy(*SAMPLE, "contig_idx").agg(F.median("cov").alias("median_cov"))


def longest_contig(contigs: DataFrame) -> DataFrame:
    """The chromosome: the longest contig, the first on ties."""
    return contigs.agg(F.min_by("contig_idx", F.struct(-F.col("contig_len"), F.col("contig_idx"))).alias("contig_idx"))


def chromosome_median(coverage: DataFrame, contigs: DataFrame) -> DataFrame:
    return contig_medians(coverage, contigs).join(F.broadcast(longest_contig(contigs)), "contig_idx").select(*SAMPLE, "median_cov")


def contig_copy_number(coverage: DataFrame, contigs: DataFrame) -> DataFrame:
    """Each contig's median over the chromosome's; null over 0."""
    medians = contig_medians(coverage, contigs)
    chrom = medians.join(F.broadcast(longest_contig(contigs)), "contig_idx").select(*SAMPLE, F.col("median_cov").alias("__chrom"))
    return medians.join(chrom, SAMPLE).withColumn("copy_number", ratio(F.col("median_cov"), F.col("__chrom"))).drop("__chrom")


def coverage_trace(coverage: DataFrame, contigs: DataFrame, contig_idx: int = 1, bins: int = 100) -> DataFrame:
    """Mean coverage of equal bins along a contig over the sample's median.

    Bin k begins floor(k * length / bins) bases into the contig.
    """
    one = contigs.where(F.col("contig_idx") == contig_idx)
    length = F.broadcast(one.select("contig_idx", "contig_len"))
    df = with_contig(coverage, one).join(length, "contig_idx")
    # The last bin whose start, k * length / bins rounded down, isn't past it.
    k = F.floor((F.col("contig_pos") * bins - 1) / F.col("contig_len")).cast("int")
    chrom = chromosome_median(coverage, contigs).select(*SAMPLE, F.col("median_cov").alias("__m"))
    means = df.groupBy(*SAMPLE, k.alias("bin")).agg(F.avg("cov").alias("mean_cov"))
    return means.join(chrom, SAMPLE).select(*SAMPLE, "bin", ratio(F.col("mean_cov"), F.col("__m")).alias("trace"))


def double_normalised(coverage: DataFrame) -> DataFrame:
    """z over samples at each position, then over positions of each sample.

    The result is rounded to three places and kept as thousandths; anything
    over a spread of 0 is 0.
    """
    site = coverage.groupBy("group_id", "p").agg(F.avg("cov").alias("__m"), F.stddev_pop("cov").alias("__s"))
    once = coverage.join(site, ["group_id", "p"]).withColumn("z", F.coalesce(F.try_divide(F.col("cov") - F.col("__m"), F.col("__s")), F.lit(0.0)))
    sample = once.groupBy(*SAMPLE).agg(F.avg("z").alias("__zm"), F.stddev_pop("z").alias("__zs"))
    both = once.join(F.broadcast(sample), SAMPLE)
    z = F.coalesce(F.try_divide(F.col("z") - F.col("__zm"), F.col("__zs")), F.lit(0.0))
    return both.select(*SAMPLE, "p", F.round(F.round(z, 3) * 1000).cast("long").alias("norm_cov"))
