"""The two analyses: calling from a candidate table, and its re-analysis."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.cells import attributes
from basewise.operators import annotate as an
from basewise.operators import dnds, masks, report, tensor, tree, variants
from basewise.operators.coverage import chromosome_median
from basewise.operators.masks import SITE, FilterParams
from basewise.operators.score import score
from basewise.sources.store import written


@dataclass(frozen=True)
class CallParams:
    """Thresholds of a whole analysis."""

    filters: FilterParams = field(default_factory=FilterParams)
    min_mut_qual: int = 1
    recomb_distance: int = 1000
    recomb_r: float = 0.75
    promoter: int = 250
    #: Samples of less median coverage, or of more N, are left out; and those named.
    min_sample_cov: float = 0.0
    max_sample_n: float = 1.0
    exclude: tuple[int, ...] = ()
    #: Samples of so many SNVs or more are left out; None: all stay.
    exclude_from_snvs: int | None = None
    #: Empty positions, in percent, from which a sample leaves the scorer's tensor.
    low_quality_share: float = 45.0
    #: Groups of more positions take the fast mode: labels without rules.
    fast_from: int = 100_000


class Caller:
    """Every table of the caller, each worked out when it is first asked for.

    cmt is dense (see candidates.dense); samples has in_outgroup.  Tables that
    several others read are written to the shared folder, so that each plan
    stays small.  scorer turns the tensor into (group_id, p, prob, cnn); unless
    given it is the network with the weights, or skips all without.
    """

    def __init__(self, cmt: DataFrame, coverage: DataFrame, samples: DataFrame, contigs: DataFrame, features: DataFrame, params: CallParams = CallParams(), weights: dict[str, np.ndarray] | None = None, scorer: Callable[[DataFrame], DataFrame] | None = None):
        self.params, self.contigs, self.features = params, contigs, features
        self.scorer = scorer or (lambda cube: score(cube, weights))
        if params.exclude:
            cmt, coverage, samples = (x.where(~F.col("sample_id").isin(*params.exclude)) for x in (cmt, coverage, samples))
        self._given = cmt, coverage, samples

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def every_cell(self) -> DataFrame:
        """Cells of all samples that weren't excluded by name."""
        return written(attributes(self._given[0]), "cells")

    @cached_property
    def snvs_per_sample(self) -> DataFrame:
        return variants.snvs_per_sample(self.every_cell)

    @cached_property
    def kept(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Cells, coverage and samples of the samples that stay."""
        held, params = (self.every_cell, *self._given[1:]), self.params
        if params.exclude_from_snvs is not None:
            lost = variants.samples_to_exclude(self.snvs_per_sample, params.exclude_from_snvs)
            held = tuple(masks.drop_samples(x, lost) for x in held)
        if params.min_sample_cov > 0:
            keep = masks.good_samples_by_coverage(held[1], self.contigs, params.min_sample_cov)
            held = tuple(masks.keep_samples(x, keep) for x in held)
        if params.max_sample_n < 1:
            keep = masks.good_samples_by_n(masks.element_masks(held[0], params.filters), "call_indel", params.max_sample_n)
            held = tuple(masks.keep_samples(x, keep) for x in held)
        return held if held[0] is self.every_cell else (written(held[0], "cells"), *held[1:])

    @cached_property
    def cells(self) -> DataFrame:
        """Cells with their calls after all masks."""
        cells, coverage, _ = self.kept
        return written(masks.apply_masks(cells, coverage, self.contigs, self.params.filters).withColumn("call", F.col("call_cpn")), "masked")

    @cached_property
    def ingroup(self) -> DataFrame:
        return self.cells.where(~F.col("in_outgroup"))

    @cached_property
    def sizes(self) -> DataFrame:
        """group_id, n_samples, fast: a row a group."""
        samples = self.kept[2].groupBy("group_id").agg(F.count(F.lit(1)).alias("n_samples"))
        sites = self.kept[0].groupBy("group_id").agg(F.count_distinct("p").alias("n_sites"))
        return sites.join(samples, "group_id").select("group_id", "n_samples", (F.col("n_sites") > self.params.fast_from).alias("fast"))

    @cached_property
    def sites(self) -> DataFrame:
        """A row a position: anc, mut_qual and the filters' tokens."""
        tokens, quality = masks.filter_tokens(self.cells), variants.mutation_quality(self.ingroup, "call")
        return written(tokens.join(variants.ancestral(self.cells, "call", self.contigs), SITE).join(quality, SITE, "left"), "sites")

    @cached_property
    def ancestral(self) -> DataFrame:
        return self.sites.select(*SITE, "anc")

    @cached_property
    def quality(self) -> DataFrame:
        return self.sites.select(*SITE, "mut_qual")

    @cached_property
    def tokens(self) -> DataFrame:
        return self.sites.drop("anc", "mut_qual")

    @cached_property
    def preliminary(self) -> DataFrame:
        """Fixed mutations before recombination is known."""
        return variants.fixed_mutations(self.ingroup, "call", self.ancestral, self.quality, None, self.params.min_mut_qual)

    @cached_property
    def recombination(self) -> DataFrame:
        sites = written(self.preliminary.select(*SITE).distinct(), "preliminary")
        pairs = variants.recombinant_pairs(self.cells, self.ancestral, sites, self.params.recomb_distance, self.params.recomb_r)
        return written(variants.recombinant_positions(pairs), "recombination")

    @cached_property
    def fixed(self) -> DataFrame:
        return written(self.preliminary.join(self.recombination, SITE, "left_anti"), "fixed")

    @cached_property
    def scorable(self) -> tuple[DataFrame, DataFrame]:
        cells, coverage, _ = self.kept
        inner = cells.where(~F.col("in_outgroup"))
        poly = written(masks.drop_monomorphic(inner, "major_nt"), "polymorphic")
        return tensor.scorable(poly, chromosome_median(coverage, self.contigs), self.params.low_quality_share)

    @cached_property
    def tensor(self) -> DataFrame:
        return self.scorable[0]

    @cached_property
    def gaps(self) -> DataFrame:
        return self.scorable[1]

    @cached_property
    def scores(self) -> DataFrame:
        return self.scorer(self.tensor)

    @cached_property
    def labels(self) -> DataFrame:
        """Positions that the network or the rules speak for, with their labels.

        Groups in the fast mode have all scored positions, without rules.
        """
        good = self.fixed.select(*SITE).distinct().withColumn("rule", F.lit(1))
        told = (
            self.scores.select(*SITE, "prob", "cnn")
            .join(good, SITE, "full")
            .join(variants.ambiguity(self.kept[0]), SITE, "left")
            .join(self.tokens.select(*SITE, "qual_filter"), SITE, "left")
            .join(self.recombination.withColumn("recomb", F.lit(True)), SITE, "left")
            .join(self.gaps.withColumn("gap", F.lit(True)), SITE, "left")
            .join(F.broadcast(self.sizes), "group_id")
            .withColumns({"rule": F.coalesce("rule", F.lit(0)), "recomb": F.coalesce("recomb", F.lit(False)), "gap": F.coalesce("gap", F.lit(False))})
        )
        told = told.where((F.col("cnn") == 1) | (~F.col("fast") & (F.col("rule") == 1)) | (F.col("fast") & F.col("cnn").isNotNull()))
        slow = variants.final_labels(told, F.col("n_samples"))
        both = variants.fast_labels(slow.withColumn("slow", F.col("label")), F.col("n_samples"))
        return written(both.withColumn("label", F.when(F.col("fast"), F.col("label")).otherwise(F.col("slow"))).drop("slow", "n_samples"), "labels")

    @cached_property
    def filters(self) -> DataFrame:
        """The filter table of the groups that took the rules."""
        return report.filter_table(self.labels.where("not fast"), masks.fix_token(self.tokens, self.fixed.select(*SITE).distinct()))

    def predictions(self, names: list[str]) -> DataFrame:
        """The fast mode's table, of the groups that took it."""
        return report.predictions(self.labels.where("fast"), self._named(self.kept[0], "major_nt"), "major_nt", names)

    @cached_property
    def annotation(self) -> DataFrame:
        good = self.labels.where("good_all and not fast")
        return written(an.annotate(good, self.contigs, self.features, self.ancestral, self.fixed, self.params.promoter), "annotation")

    @cached_property
    def merged(self) -> DataFrame:
        return report.merged_report(self.filters, self.annotation)

    @cached_property
    def tree_cells(self) -> DataFrame:
        return masks.tree_calls(masks.keep_positions(self.kept[0], self.labels.where("good_all")))

    def _named(self, cells: DataFrame, call: str) -> DataFrame:
        return cells.select(*SITE, "sample_id", call).join(self.kept[2].select("group_id", "sample_id", "sample_name"), ["group_id", "sample_id"])

    @cached_property
    def named_tree_cells(self) -> DataFrame:
        return self._named(self.tree_cells, "tree_call")

    def mutation_table(self, names: list[str]) -> DataFrame:
        """The annotated mutations, with a column of letters a sample."""
        return report.mutation_table(self.annotation, self.named_tree_cells, "tree_call", names, self.quality)

    @cached_property
    def final(self) -> DataFrame:
        """The candidate table of kept positions with prob, label and recomb."""
        return report.final_table(masks.keep_samples(self._given[0], self.kept[2]), self.labels)

    @cached_property
    def distances(self) -> DataFrame:
        return variants.distance_to_ancestor(self.fixed, self.kept[2])

    @cached_property
    def dnds(self) -> DataFrame:
        final = self.annotation.join(self.labels.where("label = 1").select(*SITE), SITE, "left_semi")
        return dnds.dnds(final, self.features, groups=self.kept[2])

    @cached_property
    def pairwise(self) -> DataFrame:
        return tree.pairwise_distance(masks.tree_calls(self.kept[0]), "tree_call")

    @cached_property
    def alignment(self) -> DataFrame:
        return tree.alignment(self.tree_cells, "tree_call", self.kept[2], self.ancestral)


class Reanalysis:
    """From a final table and its labels to reports again.

    Positions stay if labelled 1, not recombinant and not excluded.  Calls are
    the loose ones; the masks of strand coverage, indels, fraction of N and
    median coverage only with extras.  Fixed mutations need neither quality nor
    recombination here.
    """

    def __init__(self, final: DataFrame, samples: DataFrame, contigs: DataFrame, features: DataFrame, params: CallParams = CallParams(), lost_positions: DataFrame | None = None, extras: bool = False):
        if params.exclude:
            final, samples = (x.where(~F.col("sample_id").isin(*params.exclude)) for x in (final, samples))
        self.final, self.samples, self.contigs, self.features = final, samples, contigs, features
        self.params, self.lost, self.extras = params, lost_positions, extras

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def cells(self) -> DataFrame:
        cells = attributes(self.final.where((F.col("label") == 1) & ~F.coalesce(F.col("recomb"), F.lit(False))))
        if self.lost is not None:
            cells = masks.drop_positions(cells, self.lost)
        cells = masks.tree_calls(cells)
        if self.extras:
            cells = masks.extra_masks(cells, "tree_call", self.params.filters)
        return written(cells.withColumn("call", F.col("extra_call" if self.extras else "tree_call")), "cells")

    @cached_property
    def ancestral(self) -> DataFrame:
        return variants.ancestral(self.cells, "call", self.contigs)

    @cached_property
    def quality(self) -> DataFrame:
        return variants.mutation_quality(self.cells, "call")

    @cached_property
    def fixed(self) -> DataFrame:
        return written(variants.fixed_mutations(self.cells.where(~F.col("in_outgroup")), "call", self.ancestral), "fixed")

    @cached_property
    def annotation(self) -> DataFrame:
        return written(an.annotate(self.fixed.select(*SITE).distinct(), self.contigs, self.features, self.ancestral, self.fixed, self.params.promoter), "annotation")

    @cached_property
    def distances(self) -> DataFrame:
        return variants.distance_to_ancestor(self.fixed, self.samples)

    @cached_property
    def alignment(self) -> DataFrame:
        return tree.alignment(self.cells, "call", self.samples, self.ancestral)

    @cached_property
    def dnds(self) -> DataFrame:
        return dnds.dnds(self.annotation, self.features, groups=self.samples)
