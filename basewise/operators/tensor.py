"""The scoring path: feature tensor, low-quality and gap filters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.functions.cells import ratio
from basewise.functions.stats import normal_cdf, one_sample, welch
from basewise.operators.masks import SITE, drop_monomorphic, drop_positions, drop_samples, keep_positions, mask, strand_conflict
from basewise.operators.variants import allele_votes, ambiguity, modal_and_second
from basewise.sources.store import written

CLIP = 10.0
FEATURES = ["fwd_share", "rev_share", "fwd_depth", "rev_depth", "fwd", "rev", "qual", "indel"]


def base_order(cells: DataFrame) -> DataFrame:
    """group_id, p, o1..o4: bases by how many samples have them as major.

    Ties keep the lower code first.
    """
    votes = allele_votes(cells, "major_nt")
    ranked = F.sort_array(F.array(*(F.col(f"n{i}") * 8 + 7 - i for i in (1, 2, 3, 4))), asc=False)
    return votes.select(*SITE, *((7 - F.get(ranked, F.lit(k)) % 8).cast("int").alias(f"o{k + 1}") for k in range(4)))


def features(cells: DataFrame, medians: DataFrame) -> DataFrame:
    """A row for each position, sample and slot of the base order.

    A base without reads has all its features 0.  Shares are of all reads at
    the position over all samples; depths are over the sample's median coverage,
    clipped; then raw counts, quality and indels.
    """
    total = cells.groupBy(*SITE).agg(F.sum("cov").alias("__total"))
    df = cells.join(base_order(cells), SITE).join(total, SITE).join(F.broadcast(medians), ["group_id", "sample_id"], "left")
    pick = lambda base, off: F.get(F.array(*(F.col(f"c{i + off}") for i in (1, 2, 3, 4))), F.col(base) - 1)
    slots = F.array(*(F.struct(F.lit(k).alias("slot"), F.col(f"o{k}").alias("base"), pick(f"o{k}", 0).alias("fwd"), pick(f"o{k}", 4).alias("rev")) for k in (1, 2, 3, 4)))
    df = df.select(*SITE, "sample_id", "__total", "median_cov", "qual", (F.col("ins") + F.col("del")).alias("indel"), F.col("cov").alias("__cov"), F.explode(slots).alias("s"))
    live = (F.col("s.fwd") + F.col("s.rev")) > 0
    # A sample without any read here has a median of 0 in its features.
    median = F.when(F.col("__cov") > 0, F.col("median_cov"))
    share = lambda n: F.coalesce(ratio(F.col(n), F.col("__total")), F.lit(0.0))
    depth = lambda n: F.least(F.coalesce(ratio(F.col(n), median), F.when((F.col(n) > 0) & (median == 0), CLIP).otherwise(0.0)), F.lit(CLIP))
    zeroed = lambda n: F.when(live, F.col(n)).otherwise(0)
    return df.select(
        *SITE, "sample_id", F.col("s.slot").alias("slot"), F.col("s.base").alias("base"),
        share("s.fwd").alias("fwd_share"), share("s.rev").alias("rev_share"), depth("s.fwd").alias("fwd_depth"), depth("s.rev").alias("rev_depth"),
        F.col("s.fwd").alias("fwd"), F.col("s.rev").alias("rev"), zeroed("qual").alias("qual"), zeroed("indel").alias("indel"),
    )


def low_quality_samples(tensor: DataFrame, most: float = 45.0) -> DataFrame:
    """Samples of which that percentage of positions or more holds nothing.

    most = 100 drops none.
    """
    site = tensor.groupBy("group_id", "sample_id", "p").agg(F.sum(F.col("fwd") + F.col("rev")).alias("n"))
    share = site.groupBy("group_id", "sample_id").agg(F.avg((F.col("n") == 0).cast("double")).alias("empty"))
    return share.where((F.col("empty") * 100 >= most) & F.lit(most < 100)).select("group_id", "sample_id", "empty")


def low_quality_positions(tensor: DataFrame, any_dropped: Column | bool = False) -> DataFrame:
    """Positions that the surviving samples can't support.

    If samples were dropped: none has a read of the second base, or every strand
    is empty or has a major of at least its minor.  Always: some sample shows
    one base on each strand, two different ones, one of them the second, and
    under two samples show the second alone on both.  any_dropped: for all, or
    a boolean of the tensor's rows, the same within a group.
    """
    at = lambda strand, k: F.sum(F.when(F.col("slot") == k, F.col(strand)).otherwise(0))
    dropped = any_dropped if isinstance(any_dropped, Column) else F.lit(any_dropped)
    cell = tensor.groupBy(*SITE, "sample_id").agg(*(at(s, k).alias(f"{s}{k}") for s in ("fwd", "rev") for k in (1, 2, 3, 4)), F.max(dropped).alias("__dropped"))
    strands = ("fwd", "rev")
    covered = [sum((F.col(f"{s}{k}") for k in (2, 3, 4)), F.col(f"{s}1")) > 0 for s in strands]
    single = [sum(((F.col(f"{s}{k}") > 0).cast("int") for k in (2, 3, 4)), (F.col(f"{s}1") > 0).cast("int")) == 1 for s in strands]
    top = [F.array_position(F.array(*(F.col(f"{s}{k}") for k in (1, 2, 3, 4))), F.greatest(*(F.col(f"{s}{k}") for k in (1, 2, 3, 4)))) for s in strands]
    clean = covered[0] & covered[1] & single[0] & single[1]
    split = clean & ((F.col("fwd2") > 0) | (F.col("rev2") > 0)) & (top[0] != top[1])
    pure = clean & (F.col("fwd2") > 0) & (F.col("rev2") > 0)
    calm = [((F.col(f"{s}1") != 0) | ~c) & (F.col(f"{s}2") <= F.col(f"{s}1")) for s, c in zip(strands, covered, strict=True)]
    site = cell.groupBy(*SITE).agg(F.sum(F.col("fwd2") + F.col("rev2")).alias("minors"), F.min(calm[0] & calm[1]).alias("calm"), F.count_if(split).alias("split"), F.count_if(pure).alias("pure"), F.max("__dropped").alias("dropped"))
    return site.where((F.col("dropped") & ((F.col("minors") == 0) | F.col("calm"))) | ((F.col("split") > 0) & (F.col("pure") < 2))).select(*SITE)


def contaminated_cells(cells: DataFrame, call: str) -> DataFrame:
    """cells with minor_max and contaminated.

    minor_max: the position's minor allele (the second by count, ties to the
    higher code first) has over one sample, and this sample holds it or has
    fewer major reads than the least of those that do.
    """
    votes = allele_votes(cells, call)
    ranked = F.sort_array(F.array(*(F.col(f"n{i}") * 8 + i for i in (1, 2, 3, 4))), asc=False)
    second = F.get(ranked, F.lit(1))
    site = votes.select(*SITE, F.when(second >= 8, second % 8).cast("int").alias("__minor"))
    df = cells.join(site, SITE)
    only = F.col(call) == F.col("__minor")
    least = df.groupBy(*SITE).agg(F.count_if(only).alias("__n"), F.min(F.when(only & (F.col("counts_major") > 0), F.col("counts_major"))).alias("__least"))
    df = df.join(least, SITE)
    minor_max = (F.col("__n") > 1) & (F.coalesce(only, F.lit(False)) | (F.col("counts_major") < F.coalesce("__least", F.lit(0))))
    many = (F.col("counts_minor") > 30) & (F.col("counts_major") > 3 * F.col("counts_minor")) & (F.col("counts_major") > 250)
    return df.withColumns({"minor_max": minor_max, "contaminated": many & minor_max}).drop("__minor", "__n", "__least")


def depth_masks(cells: DataFrame, call: str, median_depth: float | Column, n_samples: int | Column) -> DataFrame:
    """cells with depth_call: strand, frequency and depth masks of the path."""
    f, r = F.col("fwd_cov"), F.col("rev_cov")
    depth, n = F.lit(median_depth), F.lit(n_samples)
    bad = (f < 1) | (r < 1) | strand_conflict() | (F.col("major_freq") < 0.7)
    bad = bad | ((depth > 9) & (((f == 1) & (r < 4)) | ((f < 4) & (r == 1))))
    bad = bad | ((depth > 20) & (n > 50) & ((f < 4) | (r < 4)))
    return cells.withColumn("depth_call", mask(F.col(call), bad))


def adaptive_mask(cells: DataFrame, call: str) -> DataFrame:
    """cells with adaptive_call: thin cells of ambiguous positions masked.

    Only in groups whose data are deep: over ten positions, or a tenth of them,
    keep over half their modal samples without the cells under 11 on both
    strands.  Calls without a strand count as N.
    """
    f, r = F.col("fwd_cov"), F.col("rev_cov")
    both = cells.withColumn("__both", mask(F.col(call), (f < 1) | (r < 1)))
    deep = both.withColumn("__deep", mask(F.col("__both"), (f < 11) & (r < 11)))
    modal = lambda code: allele_votes(deep, code).select(*SITE, F.greatest(*(f"n{i}" for i in (1, 2, 3, 4))).alias(f"of{code}"))
    site = modal("__both").join(modal("__deep"), SITE)
    kept = F.count_if(ratio(F.col("of__deep"), F.col("of__both")) > 0.5)
    on = site.groupBy("group_id").agg(((kept > 10) | (kept >= 0.1 * F.count(F.lit(1)))).alias("__on"))
    seen = ambiguity(cells).select(*SITE, (F.col("frac_ambiguous") > 0).alias("__seen"))
    df = both.join(F.broadcast(on), "group_id").join(seen, SITE)
    return df.withColumn("adaptive_call", mask(F.col("__both"), F.col("__on") & F.col("__seen") & (f < 3) & (r < 3))).drop("__both", "__on", "__seen")


def scorable(cells: DataFrame, medians: DataFrame, most: float = 45.0) -> tuple[DataFrame, DataFrame]:
    """The tensor of what the scorer is given, and the positions flagged as gaps.

    In order: samples and positions of low quality leave the tensor (most = 100
    keeps all); the masks of strands, frequency and depth, over all samples
    again, and the positions they leave monomorphic; contaminated cells; gaps.
    A position that the last two remove is flagged.  cells is a table that is
    read several times, best a written one.
    """
    cube = written(features(cells, medians), "tensor")
    if most < 100:
        lost = low_quality_samples(cube, most)
        groups = lost.select("group_id", F.lit(True).alias("__lost")).distinct()
        kept = drop_samples(cube, lost).join(F.broadcast(groups), "group_id", "left").withColumn("__lost", F.coalesce("__lost", F.lit(False)))
        cube = written(drop_positions(kept, low_quality_positions(kept, F.col("__lost"))).drop("__lost"), "scored")
    depth = medians.join(cells.select("group_id", "sample_id").distinct(), ["group_id", "sample_id"], "left_semi").groupBy("group_id").agg(F.median("median_cov").alias("__depth"))
    n = cube.groupBy("group_id").agg(F.count_distinct("sample_id").alias("__n"))
    held = adaptive_mask(written(keep_positions(cells, cube), "held"), "major_nt").join(F.broadcast(depth), "group_id", "left").join(F.broadcast(n), "group_id")
    masked = written(depth_masks(held, "adaptive_call", F.col("__depth"), F.col("__n")).drop("__depth", "__n", "adaptive_call"), "depths")
    before = drop_monomorphic(masked, "depth_call")
    clean = contaminated_cells(before, "depth_call").withColumn("clean_call", mask(F.col("depth_call"), F.col("contaminated")))
    clean = written(clean, "clean")
    after = written(drop_positions(drop_monomorphic(clean, "clean_call"), gaps(gap_statistics(clean, medians, "clean_call"))).select(*SITE).distinct(), "after")
    return keep_positions(cube, after), drop_positions(clean.select(*SITE).distinct(), after)


def gap_statistics(cells: DataFrame, medians: DataFrame, call: str) -> DataFrame:
    """Depths of the modal allele's samples against the second allele's.

    r is the major count over the sample's median; zeros are left out.  p is
    Student's (one-sample for a single minor sample, else Welch's), p_gap the
    normal tail of the means' distance in spreads of the modal samples.  Both
    are null where undefined.
    """
    site = modal_and_second(allele_votes(cells, call)).select(*SITE, "modal", "second")
    r = ratio(F.col("counts_major"), F.col("median_cov"))
    df = cells.join(site, SITE).join(F.broadcast(medians), ["group_id", "sample_id"]).withColumn("r", r).where("r > 0")
    of = lambda which: F.when(F.col(call) == F.col(which), F.col("r"))
    out = df.where(F.col(call) > 0).groupBy(*SITE).agg(
        *(fn(of(which)).alias(f"{name}_{which}") for which in ("modal", "second") for name, fn in (("n", F.count), ("mean", F.avg), ("var", F.var_samp), ("low", F.min), ("high", F.max)))
    )

    @F.pandas_udf("p double, p_gap double")
    def tests(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            rows = []
            for n1, m1, v1, n2, m2, v2 in zip(*columns, strict=True):
                got = None
                if n2 == 1 and n1 >= 2:
                    got = one_sample(m1, v1, n1, m2)
                elif n2 >= 2:
                    got = welch(m1, v1, n1, m2, v2, n2)
                gap = 1 - normal_cdf(abs(m1 - m2) / v1**0.5) if n1 >= 2 and n2 >= 1 and v1 > 0 else None
                rows.append((got[1] if got else None, gap))
            yield pd.DataFrame(rows, columns=["p", "p_gap"]).astype(float)

    told = tests("n_modal", "mean_modal", "var_modal", "n_second", "mean_second", "var_second")
    return out.withColumn("t", told).select("*", F.col("t.p").alias("p_value"), F.col("t.p_gap").alias("p_gap")).drop("t")


def near_three(positions: DataFrame, within: int = 100) -> DataFrame:
    """Positions with over two others within reach.

    Counted in buckets of the reach's width that also hold their neighbours'
    positions, so that no task has a whole group.
    """
    held = positions.select(*SITE).distinct()
    bucket = F.floor(F.col("p") / (within + 1))
    spread = held.select(*SITE, bucket.alias("home"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
    w = Window.partitionBy("group_id", "bucket").orderBy("p").rangeBetween(-within, within)
    return spread.withColumn("n", F.count(F.lit(1)).over(w) - 1).where((F.col("bucket") == F.col("home")) & (F.col("n") > 2)).select(*SITE)


def gaps(statistics: DataFrame) -> DataFrame:
    """Positions whose minor samples look like gaps in coverage."""
    low = F.col("p_gap") < 0.01
    a = low & (F.col("high_second") < F.col("low_modal")) & (F.col("high_second") < 0.05) & (F.col("high_modal") > 0.2)
    b = (low | (F.col("p_value") < 0.05)) & (F.col("high_second") < 0.1) & (F.col("n_second") <= 3) & (F.col("high_modal") > 0.2)
    return statistics.where(a).select(*SITE).union(near_three(statistics.where(b))).distinct()


def lowest(cells: DataFrame, value: str, x: int) -> DataFrame:
    """The x samples of least value at each position."""
    w = Window.partitionBy(*SITE).orderBy(value, "sample_id")
    return cells.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= x).drop("__n")


def frequent(cells: DataFrame, call: str) -> DataFrame:
    """Each position's most and least frequent call that isn't N, ties to the
    lower code; null without calls."""
    votes = cells.where(F.col(call) > 0).groupBy(*SITE, F.col(call).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    told = votes.groupBy(*SITE).agg(F.max_by("code", F.struct("n", -F.col("code"))).alias("most"), F.min_by("code", F.struct("n", "code")).alias("least"))
    return cells.select(*SITE).distinct().join(told, SITE, "left")


def nonzero_summary(cells: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Median, mean, spread and quartile range of the values that aren't 0."""
    x = F.when(F.col(value) != 0, F.col(value))
    return cells.groupBy(*by).agg(F.median(x).alias("median"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.percentile(x, F.lit(0.75)) - F.percentile(x, F.lit(0.25))).alias("iqr"))
