"""Reports: filter table, merged and mutation tables, pivots, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.functions.bases import int_to_nt
from basewise.operators.masks import SITE, STAGES


def filter_table(labelled: DataFrame, tokens: DataFrame) -> DataFrame:
    """The group and the sixteen columns of its filter table, kept positions only."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("skip"))
    df = labelled.where("good_all").join(tokens.select(*SITE, *(f"{s}_filter" for s in STAGES if s != "qual"), "fix_filter"), SITE)
    return df.select(
        "group_id",
        F.col("p").alias("genome_pos"),
        F.col("label").alias("pred_label"),
        told("cnn_out").alias("cnn_pred"),
        F.col("rule").alias("rule_pred"),
        told("prob_out").alias("cnn_prob"),
        *(F.col(f"{s}_filter") for s in STAGES),
        "fix_filter",
        F.coalesce("recomb", F.lit(False)).cast("int").alias("whether_recomb"),
        F.format_string("%.6f", "frac_ambiguous").alias("fraction_ambiguous_samples"),
        F.coalesce("gap", F.lit(False)).cast("int").alias("gap_filter"),
    )


def merged_report(filters: DataFrame, annotated: DataFrame) -> DataFrame:
    """The filter table with annotations; positions without one stay."""
    return filters.join(annotated.withColumnRenamed("p", "genome_pos"), ["group_id", "genome_pos"], "left")


def calls_pivot(cells: DataFrame, call: str, names: list[str]) -> DataFrame:
    """A column of letters a sample; names are given, so nothing is scanned first."""
    return cells.groupBy(*SITE).pivot("sample_name", names).agg(F.first(int_to_nt(F.col(call))))


def mutation_table(annotated: DataFrame, cells: DataFrame, call: str, names: list[str], quality: DataFrame) -> DataFrame:
    """The annotated mutation table: a row a position, a column a sample.

    nts here are the letters that the samples' calls show, in alphabetical order
    and without N; what the fixed mutations alone show is in aa_gt and muts.
    """
    letters = cells.where(F.col(call) > 0).groupBy(*SITE).agg(F.array_join(F.sort_array(F.collect_set(int_to_nt(F.col(call)))), "").alias("nts"))
    held = ["contig_idx", "contig_pos", "gene_idx", "locustag", "gene", "strand", "loc1", "loc2", "nt_pos", "aa_pos", "aa_gt", "muts", "anc_nt", "mutation_type", "locustag1", "locustag2", "distance1", "distance2"]
    df = annotated.select(*SITE, *(c for c in held if c in annotated.columns)).join(quality.select(*SITE, "mut_qual"), SITE, "left")
    return df.join(letters, SITE, "left").join(calls_pivot(cells, call, names), SITE, "left")


def predictions(labels: DataFrame, cells: DataFrame, call: str, names: list[str]) -> DataFrame:
    """The fast mode's table: label, probability and a base a sample."""
    held = labels.select(*SITE, F.col("label").alias("pred"), F.coalesce(F.col("prob").cast("string"), F.lit("skip")).alias("prob"))
    return held.join(calls_pivot(cells, call, names), SITE)


def final_table(cmt: DataFrame, labels: DataFrame) -> DataFrame:
    """The candidate table of the kept positions with prob, label and recomb.

    One table holds what re-analysis reads: see table_labels.
    """
    held = labels.where("good_all").select(*SITE, F.col("prob_out").alias("prob"), "label", F.coalesce("recomb", F.lit(False)).alias("recomb"))
    return cmt.join(held, SITE)


def table_labels(final: DataFrame) -> DataFrame:
    """group_id, p, prob, label and recomb of a final table."""
    return final.groupBy(*SITE).agg(*(F.first(c).alias(c) for c in ("prob", "label", "recomb")))


def split_by_label(merged: DataFrame) -> dict[str, DataFrame]:
    return {"final": merged.where("pred_label = 1"), "label0": merged.where("pred_label = 0"), "draft": merged}


def histogram(df: DataFrame, value: Column, bins: int | None = None, low: float | None = None, high: float | None = None, width: float | None = None) -> DataFrame:
    """bin, n: equal bins, the last with its upper edge; empty bins are absent.

    The range is the data's own where low or high isn't given.  With a width
    there is no last bin: they go on from low, or 0, to the greatest value.
    """
    df = df.select(value.cast("double").alias("v")).where("v is not null")
    if width is not None:
        first = 0.0 if low is None else low
        return df.where(F.col("v") >= first).groupBy(F.floor((F.col("v") - first) / width).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ends = df.agg((F.min("v") if low is None else F.lit(float(low))).alias("low"), (F.max("v") if high is None else F.lit(float(high))).alias("high"))
    df = df.join(F.broadcast(ends), F.col("v").between(F.col("low"), F.col("high")))
    k = F.least(F.floor(F.coalesce(F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(k.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def chart_positions(sites: DataFrame, most: int = 2000) -> DataFrame:
    """The first positions, as many as a chart shows."""
    return sites.select(*SITE).distinct().orderBy(*SITE).limit(most)


def renamed(name: Column) -> Column:
    """A sample name of ten characters: S first unless a letter leads, zeros left."""
    led = F.when(name.rlike("^[A-Za-z]"), name).otherwise(F.concat(F.lit("S"), name))
    return F.when(F.length(led) < 10, F.lpad(led, 10, "0")).otherwise(led)
