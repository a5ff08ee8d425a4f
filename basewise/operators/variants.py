"""Ancestral alleles, mutation quality, recombination, fixed mutations, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.functions.cells import ratio
from basewise.operators.candidates import ref_base
from basewise.operators.masks import SITE


def ancestral(cells: DataFrame, call: str, contigs: DataFrame) -> DataFrame:
    """group_id, p, anc: the outgroup's commonest call, else the reference.

    Ties go to the lower code.
    """
    votes = cells.where(F.col("in_outgroup") & (F.col(call) > 0)).groupBy(*SITE, F.col(call).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    mode = votes.groupBy(*SITE).agg((7 - F.max(F.col("n") * 8 + 7 - F.col("code")) % 8).cast("int").alias("mode"))
    sites = ref_base(cells.select(*SITE).distinct(), contigs).select(*SITE, "ref_code")
    return sites.join(mode, SITE, "left").select(*SITE, F.coalesce("mode", "ref_code").alias("anc"))


def mutation_quality(cells: DataFrame, call: str) -> DataFrame:
    """group_id, p, mut_qual: the best quality of two samples that disagree.

    The best pair takes each allele's best sample, so the answer is the second
    of the alleles' greatest qualities: no pair of samples is ever formed.  Null
    without two alleles.
    """
    best = cells.groupBy(*SITE).agg(*(F.max(F.when(F.col(call) == i, F.col("qual"))).alias(f"m{i}") for i in (1, 2, 3, 4)))
    ranked = F.sort_array(F.array_compact(F.array("m1", "m2", "m3", "m4")), asc=False)
    return best.select(*SITE, F.get(ranked, F.lit(1)).alias("mut_qual"))


def quality_pair(cells: DataFrame, call: str) -> DataFrame:
    """The first pair of samples, in their order, with that quality.

    The pair that a row-by-row search of all pairs would meet first: the least
    first sample, then the least second, whose lesser quality is the best.
    """
    held = cells.where(F.col(call) > 0).join(mutation_quality(cells, call).where("mut_qual is not null"), SITE)
    held = held.where(F.col("qual") >= F.col("mut_qual")).select(*SITE, "mut_qual", "sample_id", F.col(call).alias("code"))
    firsts = held.groupBy(*SITE, "mut_qual", "code").agg(F.min("sample_id").alias("s"))
    ordered = firsts.groupBy(*SITE, "mut_qual").agg(F.sort_array(F.collect_list("s")).alias("s"))
    return ordered.select(*SITE, "mut_qual", F.get("s", F.lit(0)).alias("sample_a"), F.get("s", F.lit(1)).alias("sample_b"))


def fixed_mutations(cells: DataFrame, call: str, anc: DataFrame, quality: DataFrame | None = None, recomb: DataFrame | None = None, min_qual: int = 1) -> DataFrame:
    """Cells whose call is set and differs from the ancestor's.

    With quality and recomb, also of enough quality and not recombinant.
    """
    df = cells.join(anc, SITE).where((F.col(call) > 0) & (F.col(call) != F.col("anc")))
    if quality is not None:
        df = df.join(quality, SITE).where(F.col("mut_qual") >= min_qual)
    if recomb is not None:
        df = df.join(recomb.select(*SITE), SITE, "left_anti")
    return df


def mutant_frequency(anc: Column) -> Column:
    """The share of reads of the two main alleles that aren't the ancestor's."""
    major = F.when(F.col("major_nt") != anc, F.col("major_freq")).otherwise(0.0)
    minor = F.when(F.col("minor_nt") != anc, F.coalesce("minor_freq", F.lit(0.0))).otherwise(0.0)
    return major + minor


def recombinant_pairs(cells: DataFrame, anc: DataFrame, good: DataFrame, distance: int = 1000, min_r: float = 0.75) -> DataFrame:
    """Pairs a < b of good positions, near one centre, that vary together.

    Both lie less than distance from some good position, and the correlation of
    their mutant frequencies over ingroup samples is over min_r.  The pairs come
    from a bucketed interval self-join; a spread of 0 correlates with nothing.
    """
    sites = good.select(*SITE).distinct()
    # The least good position within reach to the left, itself at most: looked
    # for in buckets that also hold the bucket before, so no task has a group.
    home = F.floor(F.col("p") / distance)
    spread = sites.select(*SITE, home.alias("home"), F.explode(F.array(home, home + 1)).alias("bucket"))
    w = Window.partitionBy("group_id", "bucket").orderBy("p").rangeBetween(-(distance - 1), 0)
    sites = spread.withColumn("reach", F.min("p").over(w)).where("bucket = home").select(*SITE, "reach")
    freq = cells.where(~F.col("in_outgroup")).join(sites, SITE).join(anc, SITE).select(*SITE, "sample_id", mutant_frequency(F.col("anc")).alias("f"))
    held = freq.groupBy(*SITE).agg(F.sort_array(F.collect_list(F.struct("sample_id", "f"))).alias("v"), F.avg("f").alias("m"), F.stddev_pop("f").alias("s"))
    held = held.join(sites, SITE).where("s > 0").withColumn("v", F.expr("transform(v, x -> (x.f - m) / s)"))
    size = 2 * distance
    left = held.select("group_id", F.col("p").alias("a"), F.col("v").alias("va"), F.explode(F.array(F.floor(F.col("p") / size), F.floor(F.col("p") / size) + 1)).alias("bucket"))
    right = held.select("group_id", F.col("p").alias("b"), F.col("v").alias("vb"), F.col("reach").alias("centre"), F.floor(F.col("p") / size).alias("bucket"))
    # The centre is the first within b's reach: it must reach a as well.
    pairs = left.join(right, ["group_id", "bucket"]).where((F.col("a") < F.col("b")) & (F.col("centre") - F.col("a") < distance))
    r = F.expr("aggregate(zip_with(va, vb, (x, y) -> x * y), 0D, (n, x) -> n + x) / size(va)")
    return pairs.select("group_id", "a", "b", r.alias("r")).where(F.col("r") > min_r)


def recombinant_positions(pairs: DataFrame) -> DataFrame:
    return pairs.select("group_id", F.explode(F.array("a", "b")).alias("p")).distinct()


def allele_votes(cells: DataFrame, code: str) -> DataFrame:
    """n1..n4: how many samples hold each allele at a position."""
    return cells.groupBy(*SITE).agg(*(F.count_if(F.col(code) == i).alias(f"n{i}") for i in (1, 2, 3, 4)))


def modal_and_second(votes: DataFrame) -> DataFrame:
    """votes with the modal allele, the lower code on ties (1 without votes),
    and the second of the order by count, where ties keep the higher code last.

    On a two-way tie for the first place the two can coincide; without a second
    allele the second is 0.
    """
    mode = 7 - F.greatest(*(F.col(f"n{i}") * 8 + 7 - i for i in (1, 2, 3, 4))) % 8
    second = F.get(F.sort_array(F.array(*(F.col(f"n{i}") * 8 + i for i in (1, 2, 3, 4))), asc=False), F.lit(1))
    return votes.withColumns({"modal": mode.cast("int"), "second": F.when(second >= 8, second % 8).otherwise(0).cast("int")})


def snvs_per_sample(cells: DataFrame, call: str = "major_nt") -> DataFrame:
    """How often a sample holds the second most frequent allele of a position.

    The allele is the lowest code with exactly the second-highest count, among
    the alleles of positions with two or more.
    """
    votes = allele_votes(cells, call).where("int(n1 > 0) + int(n2 > 0) + int(n3 > 0) + int(n4 > 0) >= 2")
    counts = F.sort_array(F.array(*(F.col(f"n{i}") for i in (1, 2, 3, 4))), asc=False)
    target = F.array_position(F.array(*(F.col(f"n{i}") for i in (1, 2, 3, 4))), F.get(counts, F.lit(1)))
    hit = cells.join(votes.select(*SITE, target.cast("int").alias("target")), SITE, "left")
    return hit.groupBy("group_id", "sample_id").agg(F.count_if(F.col(call) == F.col("target")).alias("n_snvs"))


def samples_to_exclude(counts: DataFrame, least: int) -> DataFrame:
    """Samples of that many SNVs or more."""
    return counts.where(F.col("n_snvs") >= least).select("group_id", "sample_id")


def distance_to_ancestor(fixed: DataFrame, samples: DataFrame) -> DataFrame:
    """Fixed mutations of each ingroup sample."""
    n = fixed.groupBy("group_id", "sample_id").agg(F.count(F.lit(1)).alias("n"))
    used = samples.where(~F.col("in_outgroup")).select("group_id", "sample_id")
    return used.join(n, ["group_id", "sample_id"], "left").select("group_id", "sample_id", F.coalesce("n", F.lit(0)).cast("long").alias("distance"))


def dmrca(distances: DataFrame) -> DataFrame:
    return distances.groupBy("group_id").agg(F.median("distance").alias("median"), F.min("distance").alias("least"), F.max("distance").alias("most"))


def ambiguity(cells: DataFrame, max_freq: float = 0.95) -> DataFrame:
    """frac_ambiguous and check by position, from unmasked cells.

    The first is the share of modal samples whose major frequency is inside
    (0, max_freq).  check: every sample off the mode has fewer reads of its major
    allele, on its better strand, than the most reads of the second allele seen
    as a minor one in a modal sample; that count is raised by 2 where over 2.
    """
    site = modal_and_second(allele_votes(cells, "major_nt")).select(*SITE, "modal", "second")
    df = cells.join(site, SITE)
    modal = F.col("major_nt") == F.col("modal")
    off = F.max(F.when(F.col("major_nt") != F.col("modal"), F.col("counts_major_max")))
    seen = F.max(F.when(modal & (F.col("minor_nt") == F.col("second")), F.col("counts_minor_max")))
    out = df.groupBy(*SITE).agg(
        F.count_if(modal).alias("n_modal"),
        F.count_if(modal & (F.col("major_freq") > 0) & (F.col("major_freq") < max_freq)).alias("n_ambiguous"),
        off.alias("off"),
        seen.alias("seen"),
    )
    raised = F.when(F.col("seen") > 2, F.col("seen") + 2).otherwise(F.col("seen"))
    return out.select(*SITE, F.coalesce(ratio(F.col("n_ambiguous"), F.col("n_modal")), F.lit(0.0)).alias("frac_ambiguous"), (F.coalesce("off", F.lit(0)) < F.coalesce(raised, F.lit(0))).alias("check"))


def cutoff(n_samples: int | Column) -> Column:
    """The most ambiguous samples that a position may have."""
    return F.when(F.lit(n_samples) > 20, 0.1).otherwise(0.25)


def final_labels(sites: DataFrame, n_samples: int | Column) -> DataFrame:
    """sites with label, cnn_out, prob_out, good and good_all.

    sites: rule (0/1), cnn (0/1, null: skipped), prob, qual_filter, recomb, gap,
    frac_ambiguous, check.  A position whose quality token is 1 falls; else the
    network's 1 stands; else the rules' 1 stands unless recombination, a gap,
    ambiguity over the cutoff or the check speaks against it, and then the
    network's word is turned over with its probability.
    """
    no = F.coalesce(F.col("recomb"), F.lit(False)) | F.coalesce(F.col("gap"), F.lit(False)) | (F.col("frac_ambiguous") > cutoff(n_samples)) | F.col("check")
    falls, says = F.col("qual_filter") == 1, F.coalesce(F.col("cnn"), F.lit(0)) == 1
    turned = ~falls & ~says & (F.col("rule") == 1) & ~no
    df = sites.withColumns(
        {
            "label": F.when(falls, 0).when(says, 1).when(turned, 1).otherwise(0),
            "cnn_out": F.when(falls, 0).when(turned, 1).otherwise(F.col("cnn")),
            "prob_out": F.when(falls, 0.0).when(turned, F.coalesce(1 - F.col("prob"), F.lit(1.0))).otherwise(F.col("prob")),
        }
    )
    kept = (F.col("label") == 1) | (F.coalesce(F.col("cnn_out"), F.lit(0)) == 1) | (F.col("rule") == 1)
    good = kept & (F.coalesce(F.col("cnn"), F.lit(0)) == 1) & ~F.coalesce(F.col("recomb"), F.lit(False))
    return df.withColumns({"good_all": kept, "good": good})


def fast_labels(sites: DataFrame, n_samples: int | Column) -> DataFrame:
    """Labels without rules, for very many positions: the network's 0 becomes 1
    unless ambiguity or the check speaks against it."""
    no = (F.col("frac_ambiguous") > cutoff(n_samples)) | F.col("check")
    return sites.withColumn("label", F.when((F.col("cnn") == 1) | ~no, 1).otherwise(0))
