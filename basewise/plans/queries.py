"""The registered queries of the variant operators, each beside its SQL.

Thresholds are set so that every mask has work at the tables' depth.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions import bases
from basewise.functions.cells import attributes
from basewise.operators import annotate as an
from basewise.operators import candidates, dnds, masks, report, score, tensor, tree, variants
from basewise.operators import coverage as co
from basewise.operators.masks import FilterParams
from basewise.plans import sql as s
from basewise.plans.caller import Caller, CallParams, Reanalysis
from basewise.sources import adapter
from basewise.sources.store import written

PARAMS = FilterParams(s.QUAL, s.STRAND, s.MAF, s.INDEL, s.FRAC, s.MEDIAN, s.MEAN_COPY, s.MAX_COPY)
DISTANCE, PROMOTER = 30, 5
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass
class Inputs:
    """The adapter's tables and the steps most queries begin with.

    Steps that a query reads several times are written to the shared folder: a
    cell a sample and position, or a row a position.
    """

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        self.reads = adapter.reads(self.spark, self.sf_dir)
        self.samples, self.contigs, self.features = adapter.samples(self.spark), adapter.contigs(self.spark), adapter.features(self.spark)
        self.cmt, self.coverage = adapter.cmt(self.spark, self.sf_dir), adapter.coverage(self.spark, self.sf_dir)
        self.cells = attributes(self.cmt)

    @cached_property
    def masked(self) -> DataFrame:
        return masks.apply_masks(self.cells, self.coverage, self.contigs, PARAMS)

    @cached_property
    def ingroup(self) -> DataFrame:
        return self.called.where(~F.col("in_outgroup"))

    @cached_property
    def called(self) -> DataFrame:
        """Calls of the element stages up to the allele frequency."""
        return written(masks.element_masks(self.cells, PARAMS).withColumn("call", F.col("call_maf")), "called")

    @cached_property
    def anc(self) -> DataFrame:
        return written(variants.ancestral(self.called, "call", self.contigs), "ancestral")

    @cached_property
    def quality(self) -> DataFrame:
        return variants.mutation_quality(self.ingroup, "call")

    @cached_property
    def prelim(self) -> DataFrame:
        return written(variants.fixed_mutations(self.ingroup, "call", self.anc, self.quality), "preliminary")

    @cached_property
    def pairs(self) -> DataFrame:
        return written(variants.recombinant_pairs(self.called, self.anc, self.prelim, DISTANCE), "pairs")

    @cached_property
    def recomb(self) -> DataFrame:
        return variants.recombinant_positions(self.pairs)

    @cached_property
    def fixed(self) -> DataFrame:
        return written(self.prelim.join(self.recomb, masks.SITE, "left_anti"), "fixed")

    @cached_property
    def annotated(self) -> DataFrame:
        fixed = self.fixed
        return written(an.annotate(fixed.select("group_id", "p").distinct(), self.contigs, self.features, self.anc, fixed, PROMOTER), "annotated")

    @cached_property
    def medians(self) -> DataFrame:
        return co.chromosome_median(self.coverage, self.contigs)

    @cached_property
    def tensor(self) -> DataFrame:
        return tensor.features(self.cells.where(~F.col("in_outgroup")), self.medians)


def query(sql: str | None = None) -> Callable:
    """Registers a query by its name, with what follows the common SQL."""

    def held(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = s.sql(sql)
        return f

    return held


LONG = "CAST({0} AS BIGINT) AS {0}"
COUNTS = ", ".join(f"c{i}" for i in range(1, 9))


@query("SELECT sample_id, p, count(*) AS n_reads, CAST(sum(bq) AS BIGINT) AS sum_bq FROM reads GROUP BY ALL")
def reads_adapter_counts(x: Inputs) -> DataFrame:
    return x.reads.groupBy("sample_id", "p").agg(F.count(F.lit(1)).alias("n_reads"), F.sum("bq").alias("sum_bq"))


@query(f"SELECT sample_id, p, {COUNTS}, CAST(qual AS BIGINT) AS qual, ins, del FROM cmt")
def cmt_cells(x: Inputs) -> DataFrame:
    return x.cmt.select("sample_id", "p", *(f"c{i}" for i in range(1, 9)), "qual", "ins", "del")


@query("SELECT sample_id, p, cov, fwd_cov, rev_cov, counts_major, counts_minor, major_nt, minor_nt, major_freq, minor_freq FROM cells")
def cell_attributes(x: Inputs) -> DataFrame:
    return x.cells.select("sample_id", "p", "cov", "fwd_cov", "rev_cov", "counts_major", "counts_minor", "major_nt", "minor_nt", "major_freq", "minor_freq")


@query("SELECT sample_id, p, major_nt_fwd, major_nt_rev, minor_nt_fwd, minor_nt_rev, counts_major_max, counts_minor_max FROM cells")
def strand_alleles(x: Inputs) -> DataFrame:
    return x.cells.select("sample_id", "p", "major_nt_fwd", "major_nt_rev", "minor_nt_fwd", "minor_nt_rev", "counts_major_max", "counts_minor_max")


def _mask_query(stage: str) -> None:
    def f(x: Inputs) -> DataFrame:
        df = masks.element_masks(x.cells, PARAMS) if stage in ("qual", "cov", "maf", "indel") else x.masked
        return df.select("sample_id", "p", F.col(f"call_{stage}").alias("call"))

    f.__name__ = {"qual": "mask_qual", "cov": "mask_strand_cov", "maf": "mask_maf", "indel": "mask_indel", "mfas": "mask_mfas", "mmcp": "mask_median_cov", "cpn": "mask_copy_number"}[stage]
    query(f"SELECT sample_id, p, CAST(call_{stage} AS INTEGER) AS call FROM masked")(f)


for _stage in masks.STAGES:
    _mask_query(_stage)

_TOKEN = ", ".join(
    f"CAST(CASE WHEN {a} >= 2 AND {b} >= 2 THEN 0 WHEN {a} >= 2 THEN 1 ELSE -1 END AS INTEGER) AS {b}_filter"
    for a, b in zip(("start_", *masks.STAGES[:-1]), masks.STAGES, strict=True)
)
_ALLELES = ", ".join(f"count(DISTINCT CASE WHEN call_{c.strip('_')} > 0 THEN call_{c.strip('_')} END) AS {c}" for c in ("start_", *masks.STAGES))


@query(f"SELECT p, {_TOKEN} FROM (SELECT p, {_ALLELES} FROM masked GROUP BY p)")
def filter_tokens(x: Inputs) -> DataFrame:
    return masks.filter_tokens(x.masked).drop("group_id")


@query("SELECT p, avg(CASE WHEN call_maf = 0 THEN 1.0::DOUBLE ELSE 0 END) AS frac_n FROM masked GROUP BY p")
def frac_n_by_position(x: Inputs) -> DataFrame:
    return masks.fraction_n(x.called, "call", "p").drop("group_id")


@query("SELECT sample_id, round(avg(CASE WHEN call_maf = 0 THEN 1.0::DOUBLE ELSE 0 END), 9) AS frac_n FROM masked GROUP BY sample_id")
def frac_n_by_sample(x: Inputs) -> DataFrame:
    return masks.fraction_n(x.called, "call", "sample_id").select("sample_id", F.round("frac_n", 9).alias("frac_n"))


@query("""SELECT sample_id FROM chrom WHERE chrom_median >= 24 AND sample_id IN (
  SELECT sample_id FROM masked GROUP BY sample_id HAVING avg(CASE WHEN call_maf = 0 THEN 1.0::DOUBLE ELSE 0 END) <= 0.2 OR bool_or(in_outgroup))""")
def good_samples(x: Inputs) -> DataFrame:
    a = masks.good_samples_by_coverage(x.coverage, x.contigs, 24)
    return a.join(masks.good_samples_by_n(x.called, "call", 0.2), ["group_id", "sample_id"], "left_semi").select("sample_id")


@query("SELECT p, CAST(count(DISTINCT call_maf) AS INTEGER) AS n_alleles FROM masked WHERE call_maf > 0 GROUP BY p HAVING count(DISTINCT call_maf) >= 2")
def monomorphic_removed(x: Inputs) -> DataFrame:
    return masks.polymorphic(x.called, "call").select("p", F.col("n_alleles").cast("int").alias("n_alleles"))


@query("SELECT sample_id, contig_idx, median_cov FROM medians")
def contig_median_cov(x: Inputs) -> DataFrame:
    return co.contig_medians(x.coverage, x.contigs).drop("group_id")


@query("SELECT sample_id, contig_idx, median_cov, median_cov / nullif(chrom_median, 0) AS copy_number FROM medians JOIN chrom USING (sample_id)")
def contig_copy_number(x: Inputs) -> DataFrame:
    return co.contig_copy_number(x.coverage, x.contigs).drop("group_id")


@query("""SELECT sample_id, k AS bin, round(avg(cov) / chrom_median, 9) AS trace FROM coverage JOIN chrom USING (sample_id)
  JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(10)) ON contig_pos - 1 >= k * 120 // 10 AND contig_pos - 1 < (k + 1) * 120 // 10
  WHERE contig_idx = 1 GROUP BY sample_id, k, chrom_median""")
def coverage_trace(x: Inputs) -> DataFrame:
    return co.coverage_trace(x.coverage, x.contigs, 1, 10).select("sample_id", "bin", F.round("trace", 9).alias("trace"))


@query("""SELECT sample_id, p, CAST(round(round(coalesce((z - zm) / nullif(zs, 0), 0), 3) * 1000) AS BIGINT) AS norm_cov FROM (
  SELECT sample_id, p, z, avg(z) OVER (PARTITION BY sample_id) AS zm, stddev_pop(z) OVER (PARTITION BY sample_id) AS zs FROM (
    SELECT sample_id, p, coalesce((cov - avg(cov) OVER (PARTITION BY p)) / nullif(stddev_pop(cov) OVER (PARTITION BY p), 0), 0) AS z FROM coverage))""")
def coverage_double_norm(x: Inputs) -> DataFrame:
    return co.double_normalised(x.coverage).drop("group_id")


@query("SELECT p, count(DISTINCT sample_id) AS n_samples FROM (SELECT sample_id, p FROM cells JOIN genome USING (p) WHERE cov > 0 AND major_nt <> ref_code) GROUP BY p")
def variant_counts(x: Inputs) -> DataFrame:
    return candidates.variant_counts(_variants(x)).drop("group_id")


@query("SELECT DISTINCT p FROM cells JOIN genome USING (p) WHERE cov > 0 AND major_nt <> ref_code AND NOT in_outgroup")
def candidate_positions(x: Inputs) -> DataFrame:
    return candidates.candidate_positions(_variants(x), x.samples).select("p")


def _variants(x: Inputs) -> DataFrame:
    df = candidates.ref_base(x.cells.select("group_id", "sample_id", "p", "major_nt", "cov"), x.contigs)
    return df.where((F.col("cov") > 0) & (F.col("major_nt") != F.col("ref_code"))).select("group_id", "sample_id", "p")


@query("SELECT p, anc FROM anc")
def ancestral_allele(x: Inputs) -> DataFrame:
    return x.anc.drop("group_id")


@query("SELECT p, CAST(mut_qual AS BIGINT) AS mut_qual FROM quality")
def mutation_quality(x: Inputs) -> DataFrame:
    return x.quality.drop("group_id")


@query("""SELECT a.p, CAST(q.mut_qual AS BIGINT) AS mut_qual, a.sample_id AS sample_a, b.sample_id AS sample_b FROM masked a JOIN masked b
  ON a.p = b.p AND a.call_maf > 0 AND b.call_maf > 0 AND a.call_maf <> b.call_maf AND NOT a.in_outgroup AND NOT b.in_outgroup
  JOIN quality q ON q.p = a.p AND least(a.qual, b.qual) = q.mut_qual QUALIFY row_number() OVER (PARTITION BY a.p ORDER BY a.sample_id, b.sample_id) = 1""")
def mutation_quality_pair(x: Inputs) -> DataFrame:
    return variants.quality_pair(x.ingroup, "call").drop("group_id")


@query("SELECT sample_id, p, CAST(call_maf AS INTEGER) AS call, anc, CAST(mut_qual AS BIGINT) AS mut_qual FROM fixed")
def fixed_mutations(x: Inputs) -> DataFrame:
    return x.fixed.select("sample_id", "p", "call", "anc", "mut_qual")


@query("""SELECT sample_id, count(*) FILTER (major_nt = target) AS n_snvs FROM cells LEFT JOIN (
  SELECT p, list_position([n1, n2, n3, n4], list_reverse_sort([n1, n2, n3, n4])[2]) AS target FROM alleles
  WHERE (n1 > 0)::INT + (n2 > 0)::INT + (n3 > 0)::INT + (n4 > 0)::INT >= 2) USING (p) GROUP BY sample_id""")
def snvs_per_sample(x: Inputs) -> DataFrame:
    return variants.snvs_per_sample(x.cells).drop("group_id")


@query("SELECT s.sample_id, count(f.p) AS distance FROM samples s LEFT JOIN fixed f USING (sample_id) WHERE NOT s.in_outgroup GROUP BY s.sample_id")
def dist_to_ancestor(x: Inputs) -> DataFrame:
    return variants.distance_to_ancestor(x.fixed, x.samples).drop("group_id")


@query("SELECT median(distance) AS median, min(distance) AS least, max(distance) AS most FROM (SELECT s.sample_id, count(f.p) AS distance FROM samples s LEFT JOIN fixed f USING (sample_id) WHERE NOT s.in_outgroup GROUP BY s.sample_id)")
def dmrca(x: Inputs) -> DataFrame:
    return variants.dmrca(variants.distance_to_ancestor(x.fixed, x.samples)).drop("group_id")


@query("SELECT a, b, round(r, 9) AS r FROM pairs WHERE r > 0.75")
def recomb_pairs(x: Inputs) -> DataFrame:
    return x.pairs.select("a", "b", F.round("r", 9).alias("r"))


@query("SELECT p FROM recomb")
def recomb_positions(x: Inputs) -> DataFrame:
    return x.recomb.select("p")


_CHECK = "off < CASE WHEN seen > 2 THEN seen + 2 ELSE seen END"


@query(f'SELECT p, frac_ambiguous, {_CHECK} AS "check" FROM ambiguity')
def ambiguity_fraction(x: Inputs) -> DataFrame:
    return variants.ambiguity(x.cells).drop("group_id")


_SITES = f"""SELECT a.p, frac_ambiguous, {_CHECK} AS chk, CASE WHEN g.p IS NULL THEN 0 ELSE 1 END AS rule, CASE WHEN a.p % 7 = 0 THEN NULL ELSE CAST(a.p % 2 AS INTEGER) END AS cnn,
  (a.p % 10) / 10.0::DOUBLE AS prob, CASE WHEN a.p % 13 = 0 THEN 1 ELSE 0 END AS qual_filter, r.p IS NOT NULL AS recomb, a.p % 11 = 0 AS gap
  FROM ambiguity a LEFT JOIN good g ON g.p = a.p LEFT JOIN recomb r ON r.p = a.p"""


def _sites(x: Inputs) -> DataFrame:
    """Sites with a stand-in network's word by position."""
    p = F.col("p")
    df = variants.ambiguity(x.cells).join(x.prelim.select("group_id", "p").distinct().withColumn("rule", F.lit(1)), ["group_id", "p"], "left")
    df = df.join(x.recomb.withColumn("recomb", F.lit(True)), ["group_id", "p"], "left")
    return df.withColumns(
        {"rule": F.coalesce("rule", F.lit(0)), "recomb": F.coalesce("recomb", F.lit(False)), "cnn": F.when(p % 7 != 0, (p % 2).cast("int")), "prob": (p % 10) / 10, "qual_filter": (p % 13 == 0).cast("int"), "gap": p % 11 == 0}
    )


@query(f"""SELECT p, CAST(label AS INTEGER) AS label, CAST(CASE WHEN qual_filter = 1 THEN 0 WHEN turned THEN 1 ELSE cnn END AS INTEGER) AS cnn_out,
  CASE WHEN qual_filter = 1 THEN 0 WHEN turned THEN coalesce(1 - prob, 1.0) ELSE prob END AS prob_out
  FROM (SELECT *, CASE WHEN qual_filter = 1 THEN 0 WHEN cnn = 1 OR turned THEN 1 ELSE 0 END AS label FROM (
    SELECT *, qual_filter = 0 AND coalesce(cnn, 0) = 0 AND rule = 1 AND NOT (recomb OR gap OR frac_ambiguous > 0.25 OR chk) AS turned FROM ({_SITES})))""")
def final_label(x: Inputs) -> DataFrame:
    return variants.final_labels(_sites(x), 12).select("p", "label", "cnn_out", "prob_out")


@query(f"SELECT p, CAST(CASE WHEN cnn = 1 THEN 1 WHEN frac_ambiguous > 0.25 OR chk THEN 0 ELSE 1 END AS INTEGER) AS label FROM ({_SITES})")
def fast_label(x: Inputs) -> DataFrame:
    return variants.fast_labels(_sites(x), 12).select("p", "label")


@query("SELECT p, CAST(contig_idx AS INTEGER) AS contig_idx, contig_pos FROM genome")
def p_to_contig(x: Inputs) -> DataFrame:
    return co.with_contig(x.coverage.select("p").distinct(), x.contigs).select("p", "contig_idx", "contig_pos")


@query("SELECT p, ref_nt FROM genome")
def ref_base(x: Inputs) -> DataFrame:
    back = co.to_global(co.with_contig(x.coverage.select("p").distinct(), x.contigs).select("contig_idx", "contig_pos"), x.contigs)
    return candidates.ref_base(back.select("p"), x.contigs).select("p", "ref_nt")


@query("SELECT p, CAST(gene_idx AS INTEGER) AS gene_idx, locustag FROM hits")
def gene_hit(x: Inputs) -> DataFrame:
    return an.gene_hits(x.coverage.select("p").distinct(), x.contigs, x.features).select("p", "gene_idx", "locustag")


@query("SELECT p, locustag1, locustag2, CAST(distance1 AS BIGINT) AS distance1, CAST(distance2 AS BIGINT) AS distance2 FROM between_genes")
def gene_neighbours(x: Inputs) -> DataFrame:
    return an.gene_neighbours(x.coverage.select("p").distinct(), x.contigs, x.features)


@query("SELECT p, CAST(nt_pos AS BIGINT) AS nt_pos, CAST(aa_pos AS BIGINT) AS aa_pos, codon, aas FROM places JOIN effects USING (p)")
def codon_effects(x: Inputs) -> DataFrame:
    return an.codon_effects(an.gene_hits(x.coverage.select("p").distinct(), x.contigs, x.features)).where("gene_idx is not null").select("p", "nt_pos", "aa_pos", "codon", "aas")


@query("SELECT p, locustag, aa_gt, anc_nt, nts, mutation_type FROM annotated")
def mutation_type(x: Inputs) -> DataFrame:
    return x.annotated.select("p", "locustag", "aa_gt", "anc_nt", "nts", "mutation_type")


@query("SELECT anc_nt, new_nt, count(*) AS n FROM muts GROUP BY ALL")
def mutation_matrix(x: Inputs) -> DataFrame:
    return dnds.mutation_matrix(x.annotated).drop("group_id")


@query(f"SELECT class, count(m.class) AS n FROM (SELECT unnest(['AT/TA', 'AC/TG', 'AG/TC', 'GC/CG', 'GT/CA', 'GA/CT']) AS class) c LEFT JOIN (SELECT {s.CLASS} AS class FROM muts) m USING (class) GROUP BY class")
def mutation_spectrum(x: Inputs) -> DataFrame:
    return dnds.mutation_spectrum(x.annotated, x.samples).drop("group_id")


@query("SELECT mutation_type, count(*) AS n FROM muts WHERE n_new = 1 GROUP BY mutation_type")
def mutation_type_counts(x: Inputs) -> DataFrame:
    return dnds.type_counts(x.annotated).drop("group_id")


_USAGE = "SELECT substr(sequence, CAST(i * 3 + 1 AS INTEGER), 3) AS codon, count(*) AS n FROM features, (SELECT range AS i FROM range(7)) GROUP BY ALL"


@query(_USAGE)
def codon_usage(x: Inputs) -> DataFrame:
    return dnds.codon_usage(x.features)


_EXPECTED = f"""SELECT round(sum(chance * share / 2), 9) AS p_nonsyn FROM (
  SELECT anc_nt, new_nt, {s.CLASS} AS class, sum(CASE WHEN c2.aa <> c1.aa THEN u.n ELSE 0 END)::DOUBLE / sum(u.n) AS chance
  FROM ({_USAGE}) u JOIN codons c1 USING (codon), (SELECT unnest([1, 2, 3]) AS i) k, (SELECT unnest(['A', 'C', 'G', 'T']) AS new_nt) b, LATERAL (SELECT substr(codon, i, 1) AS anc_nt) l
  JOIN codons c2 ON c2.codon = substr(c1.codon, 1, i - 1) || new_nt || substr(c1.codon, i + 1) WHERE anc_nt <> new_nt GROUP BY ALL)
  JOIN (SELECT class, CASE WHEN (SELECT count(*) FROM muts) >= 100 THEN count(m.class)::DOUBLE / (SELECT count(*) FROM muts) ELSE 1.0::DOUBLE / 6 END AS share
    FROM (SELECT unnest(['AT/TA', 'AC/TG', 'AG/TC', 'GC/CG', 'GT/CA', 'GA/CT']) AS class) c LEFT JOIN (SELECT {s.CLASS} AS class FROM muts) m USING (class) GROUP BY class) USING (class)"""


@query(_EXPECTED)
def dnds_expected(x: Inputs) -> DataFrame:
    return dnds.expected_nonsynonymous(dnds.codon_usage(x.features), dnds.mutation_spectrum(x.annotated, x.samples)).select(F.round("p_nonsyn", 9).alias("p_nonsyn"))


_OBSERVED = """SELECT n_nonsyn, n_syn, CASE WHEN n_nonsyn + n_syn > 0 THEN n_nonsyn::DOUBLE / (n_nonsyn + n_syn) ELSE 0 END AS p_nonsyn
  FROM (SELECT count(*) FILTER (mutation_type = 'N') AS n_nonsyn, count(*) FILTER (mutation_type = 'S') AS n_syn FROM annotated WHERE gene_idx IS NOT NULL)"""


@query(_OBSERVED)
def dnds_observed(x: Inputs) -> DataFrame:
    return dnds.observed_nonsynonymous(x.annotated, groups=x.samples).select("n_nonsyn", "n_syn", "p_nonsyn")


@query(f"""SELECT n_nonsyn, n_syn, round(o.p_nonsyn, 9) AS p_nonsyn, e.p_nonsyn AS p_expected, round((o.p_nonsyn / nullif(1 - o.p_nonsyn, 0)) / nullif(e.p_nonsyn / nullif(1 - e.p_nonsyn, 0), 0), 6) AS dnds
  FROM ({_OBSERVED}) o, ({_EXPECTED}) e""")
def dnds_ratio(x: Inputs) -> DataFrame:
    """Without its interval, which SQL can't express; see dnds_interval."""
    df = dnds.dnds(x.annotated, x.features, groups=x.samples)
    return df.select("n_nonsyn", "n_syn", F.round("p_nonsyn", 9).alias("p_nonsyn"), F.round("p_expected", 9).alias("p_expected"), F.round("dnds", 6).alias("dnds"))


@query()
def dnds_interval(x: Inputs) -> DataFrame:
    """The exact binomial interval and the ratio's bounds; tested by hand."""
    return dnds.dnds(x.annotated, x.features, groups=x.samples).select("ci_low", "ci_high", "dnds_low", "dnds_high")


@query("""SELECT p, CAST(o[1] % 8 AS INTEGER) AS o1, CAST(o[2] % 8 AS INTEGER) AS o2, CAST(o[3] % 8 AS INTEGER) AS o3, CAST(o[4] % 8 AS INTEGER) AS o4 FROM (
  SELECT p, list_transform(list_reverse_sort([n1 * 8 + 6, n2 * 8 + 5, n3 * 8 + 4, n4 * 8 + 3]), lambda k: 7 - k % 8) AS o FROM alleles)""")
def base_order(x: Inputs) -> DataFrame:
    return tensor.base_order(x.cells).drop("group_id")


_CUBE = """SELECT c.p, c.sample_id, CAST(slot AS INTEGER) AS slot, CAST(base AS INTEGER) AS base,
    CASE base WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 ELSE c4 END AS fwd, CASE base WHEN 1 THEN c5 WHEN 2 THEN c6 WHEN 3 THEN c7 ELSE c8 END AS rev,
    qual AS q, ins + del AS i, total, chrom_median FROM cells c JOIN chrom USING (sample_id) JOIN (SELECT p, sum(cov) AS total FROM cells WHERE NOT in_outgroup GROUP BY p) t ON t.p = c.p
  JOIN (SELECT p, unnest([1, 2, 3, 4]) AS slot, unnest(list_transform(list_reverse_sort([n1 * 8 + 6, n2 * 8 + 5, n3 * 8 + 4, n4 * 8 + 3]), lambda k: 7 - k % 8)) AS base FROM (
    SELECT p, count(*) FILTER (major_nt = 1) AS n1, count(*) FILTER (major_nt = 2) AS n2, count(*) FILTER (major_nt = 3) AS n3, count(*) FILTER (major_nt = 4) AS n4 FROM cells WHERE NOT in_outgroup GROUP BY p)) o ON o.p = c.p
  WHERE NOT in_outgroup"""


@query(f"""SELECT p, sample_id, slot, base, fwd::DOUBLE / total AS fwd_share, rev::DOUBLE / total AS rev_share,
  least(CASE WHEN fwd = 0 THEN 0 WHEN chrom_median = 0 THEN 10 ELSE fwd / chrom_median END, 10.0::DOUBLE) AS fwd_depth, least(CASE WHEN rev = 0 THEN 0 WHEN chrom_median = 0 THEN 10 ELSE rev / chrom_median END, 10.0::DOUBLE) AS rev_depth,
  fwd, rev, CAST(CASE WHEN fwd + rev > 0 THEN q ELSE 0 END AS BIGINT) AS qual, CASE WHEN fwd + rev > 0 THEN i ELSE 0 END AS indel FROM ({_CUBE})""")
def cnn_tensor(x: Inputs) -> DataFrame:
    return x.tensor.drop("group_id")


@query(f"SELECT sample_id, round(avg(CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE 0 END), 9) AS empty FROM (SELECT p, sample_id, sum(fwd + rev) AS n FROM ({_CUBE}) GROUP BY ALL) GROUP BY sample_id HAVING avg(CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE 0 END) * 100 >= 0")
def low_quality_samples(x: Inputs) -> DataFrame:
    return tensor.low_quality_samples(x.tensor, 0).select("sample_id", F.round("empty", 9).alias("empty"))


@query(f"""SELECT p FROM (SELECT p, sample_id, count(*) FILTER (fwd > 0) = 1 AND count(*) FILTER (rev > 0) = 1 AS clean, sum(fwd) FILTER (slot = 2) AS f2, sum(rev) FILTER (slot = 2) AS r2,
    max_by(slot, fwd) <> max_by(slot, rev) AS differ FROM ({_CUBE}) GROUP BY p, sample_id) GROUP BY p
  HAVING count(*) FILTER (clean AND (f2 > 0 OR r2 > 0) AND differ) > 0 AND count(*) FILTER (clean AND f2 > 0 AND r2 > 0) < 2""")
def low_quality_positions(x: Inputs) -> DataFrame:
    return tensor.low_quality_positions(x.tensor).select("p")


@query("""SELECT p, sample_id, minor_max, coalesce(minor_max AND counts_minor > 30 AND counts_major > 3 * counts_minor AND counts_major > 250, false) AS contaminated FROM (
  SELECT c.p, c.sample_id, counts_major, counts_minor, n > 1 AND (coalesce(major_nt = minor, false) OR counts_major < coalesce(least_, 0)) AS minor_max FROM cells c JOIN (
    SELECT c.p, minor, count(*) FILTER (major_nt = minor) AS n, min(counts_major) FILTER (major_nt = minor AND counts_major > 0) AS least_
    FROM cells c JOIN (SELECT p, CASE WHEN k2 >= 8 THEN k2 % 8 END AS minor FROM ranks) m ON m.p = c.p GROUP BY c.p, minor) s ON s.p = c.p)""")
def contaminated_cells(x: Inputs) -> DataFrame:
    return tensor.contaminated_cells(x.cells, "major_nt").select("p", "sample_id", "minor_max", "contaminated")


@query("""SELECT sample_id, p, CAST(CASE WHEN fwd_cov < 1 OR rev_cov < 1 OR (major_nt_fwd <> major_nt_rev AND major_nt_fwd > 0 AND major_nt_rev > 0) OR major_freq < 0.7
  OR (fwd_cov = 1 AND rev_cov < 4) OR (fwd_cov < 4 AND rev_cov = 1) THEN 0 ELSE major_nt END AS INTEGER) AS call FROM cells""")
def depth_masks(x: Inputs) -> DataFrame:
    return tensor.depth_masks(x.cells, "major_nt", 25, 12).select("sample_id", "p", F.col("depth_call").alias("call"))


@query("SELECT a.p FROM good a JOIN good b ON b.p <> a.p AND abs(a.p - b.p) <= 4 GROUP BY a.p HAVING count(*) > 2")
def gap_cluster(x: Inputs) -> DataFrame:
    return tensor.near_three(x.prelim, 4).select("p")


_MOMENTS = [(n, w) for w in ("modal", "second") for n in ("n", "mean", "var", "low", "high")]


@query(f"""SELECT p, {", ".join(f"n_{w}" if n == "n" else f"round({n}_{w}, 9) AS {n}_{w}" for n, w in _MOMENTS)} FROM (
  SELECT p, {", ".join(f"{dict(n='count', mean='avg', var='var_samp', low='min', high='max')[n]}(r) FILTER (major_nt = {w}) AS {n}_{w}" for n, w in _MOMENTS)}
  FROM (SELECT c.p, major_nt, counts_major::DOUBLE / nullif(chrom_median, 0) AS r, k.modal, CASE WHEN k.k2 >= 8 THEN k.k2 % 8 ELSE 0 END AS second FROM cells c JOIN chrom USING (sample_id) JOIN (
    SELECT p, CASE greatest(n1, n2, n3, n4) WHEN n1 THEN 1 WHEN n2 THEN 2 WHEN n3 THEN 3 ELSE 4 END AS modal, list_reverse_sort([n1 * 8 + 1, n2 * 8 + 2, n3 * 8 + 3, n4 * 8 + 4])[2] AS k2 FROM (
      SELECT p, {", ".join(f"count(*) FILTER (major_nt = {i}) AS n{i}" for i in (1, 2, 3, 4))} FROM cells WHERE NOT in_outgroup GROUP BY p)) k ON k.p = c.p WHERE NOT in_outgroup)
  WHERE r > 0 AND major_nt > 0 GROUP BY p)""")
def gap_statistics(x: Inputs) -> DataFrame:
    """The moments that the tests are worked out from; see gap_tests."""
    df = tensor.gap_statistics(x.ingroup, x.medians, "major_nt")
    return df.select("p", *(F.col(f"n_{w}") if n == "n" else F.round(f"{n}_{w}", 9).alias(f"{n}_{w}") for n, w in _MOMENTS))


@query()
def gap_tests(x: Inputs) -> DataFrame:
    """Student's p and the normal tail; tested against the definitions."""
    return tensor.gap_statistics(x.ingroup, x.medians, "major_nt").select("p", "p_value", "p_gap")


@query("SELECT p, sample_id, cov FROM cells QUALIFY row_number() OVER (PARTITION BY p ORDER BY cov, sample_id) <= 3")
def lowest_samples(x: Inputs) -> DataFrame:
    return tensor.lowest(x.cells, "cov", 3).select("p", "sample_id", "cov")


@query("SELECT sample_id, median(v) AS median, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS std, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM (SELECT sample_id, nullif(ins + del, 0)::DOUBLE AS v FROM cells) GROUP BY sample_id")
def nonzero_summary(x: Inputs) -> DataFrame:
    df = tensor.nonzero_summary(x.cells.withColumn("v", F.col("ins") + F.col("del")), "v", ["sample_id"])
    return df.select("sample_id", "median", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"), "iqr")


@query()
def cnn_score(x: Inputs) -> DataFrame:
    return score.score(x.tensor, score.random_weights()).drop("group_id")


@query("SELECT DISTINCT p FROM (SELECT p FROM good UNION SELECT p FROM genome WHERE p % 17 = 0)")
def set_union_positions(x: Inputs) -> DataFrame:
    return x.prelim.select("p").union(x.coverage.where("p % 17 = 0").select("p")).distinct()


@query("SELECT p FROM good EXCEPT SELECT p FROM recomb")
def set_difference_positions(x: Inputs) -> DataFrame:
    return masks.drop_positions(x.prelim.select("group_id", "p").distinct(), x.recomb).select("p")


@query("SELECT p FROM good INTERSECT SELECT p FROM genome WHERE p % 2 = 0")
def set_intersection_positions(x: Inputs) -> DataFrame:
    return masks.keep_positions(x.prelim.select("group_id", "p").distinct(), x.coverage.where("p % 2 = 0")).select("p")


@query("SELECT g.p, a.mutation_type, a.nts FROM good g LEFT JOIN annotated a USING (p)")
def merged_report(x: Inputs) -> DataFrame:
    left = x.prelim.select("group_id", F.col("p").alias("genome_pos")).distinct()
    return report.merged_report(left, x.annotated.select("group_id", "p", "mutation_type", "nts")).drop("group_id").withColumnRenamed("genome_pos", "p")


_NAMES = [f"sample_{i:02d}" for i in range(adapter.SAMPLES)]


@query("SELECT p, " + ", ".join(f"max(CASE WHEN sample_id = {i} THEN 'NATCG'[call_maf + 1] END) AS {n}" for i, n in enumerate(_NAMES)) + " FROM masked GROUP BY p")
def calls_pivot(x: Inputs) -> DataFrame:
    return report.calls_pivot(x.called.join(F.broadcast(x.samples.select("sample_id", "sample_name")), "sample_id"), "call", _NAMES).drop("group_id")


@query("SELECT sample_name AS name, string_agg('NATCG'[call_maf + 1], '' ORDER BY p) AS sequence FROM masked JOIN samples USING (sample_id) GROUP BY sample_name UNION ALL SELECT 'inferred_ancestor', string_agg('NATCG'[anc + 1], '' ORDER BY p) FROM anc")
def sample_fasta(x: Inputs) -> DataFrame:
    return tree.alignment(x.called, "call", x.samples, x.anc).drop("group_id")


@query("SELECT CAST(floor(cov / 5.0) AS INTEGER) AS bin, count(*) AS n FROM coverage GROUP BY ALL")
def histogram_cov(x: Inputs) -> DataFrame:
    return report.histogram(x.coverage, F.col("cov"), width=5)


_SNVS = """SELECT sample_id, count(*) FILTER (major_nt = target) AS n FROM cells LEFT JOIN (
  SELECT p, list_position([n1, n2, n3, n4], list_reverse_sort([n1, n2, n3, n4])[2]) AS target FROM alleles
  WHERE (n1 > 0)::INT + (n2 > 0)::INT + (n3 > 0)::INT + (n4 > 0)::INT >= 2) USING (p) GROUP BY sample_id"""


def _bins(values: str, bins: int, ends: str = "") -> str:
    """SQL of equal bins over values, a SELECT of v; the ends are the data's own unless given."""
    ends = ends or f"SELECT min(v)::DOUBLE AS low, max(v)::DOUBLE AS high FROM ({values})"
    return f"""SELECT CAST(least(floor(coalesce((v - low) / nullif(high - low, 0), 0) * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
  FROM (SELECT v::DOUBLE AS v FROM ({values})), ({ends}) WHERE v BETWEEN low AND high GROUP BY ALL"""


@query(_bins(f"SELECT n AS v FROM ({_SNVS})", 20))
def histogram_snv(x: Inputs) -> DataFrame:
    return report.histogram(variants.snvs_per_sample(x.cells), F.col("n_snvs"), 20)


@query(_bins(f"SELECT n AS v FROM ({_SNVS}) WHERE n <= 1000", 500))
def histogram_snv_zoomed(x: Inputs) -> DataFrame:
    return report.histogram(variants.snvs_per_sample(x.cells).where("n_snvs <= 1000"), F.col("n_snvs"), 500)


@query(_bins("SELECT avg(CASE WHEN call_maf = 0 THEN 1.0::DOUBLE ELSE 0 END) AS v FROM masked GROUP BY p", 20, "SELECT 0::DOUBLE AS low, 1::DOUBLE AS high"))
def histogram_frac_n(x: Inputs) -> DataFrame:
    return report.histogram(masks.fraction_n(x.called, "call", "p"), F.col("frac_n"), 20, 0, 1)


@query(_bins("SELECT qual AS v FROM cells", 50))
def histogram_quality(x: Inputs) -> DataFrame:
    return report.histogram(x.cells, F.col("qual"), 50)


@query("SELECT a.sample_id AS sample_a, b.sample_id AS sample_b, count(*) AS compared, count(*) FILTER (a.call_maf <> b.call_maf) AS different FROM masked a JOIN masked b ON a.p = b.p AND a.sample_id < b.sample_id AND a.call_maf > 0 AND b.call_maf > 0 GROUP BY ALL")
def pairwise_distance(x: Inputs) -> DataFrame:
    return tree.pairwise_distance(x.called, "call").drop("group_id")


@query()
def nj_tree(x: Inputs) -> DataFrame:
    return tree.nj_tree(tree.pairwise_distance(x.called, "call"))


@query("SELECT p, 'NATCG'[1 + CASE WHEN letter = 'A' THEN 1 WHEN letter = 'T' THEN 2 WHEN letter = 'C' THEN 3 ELSE 4 END] AS anc_nt, CAST(total - n AS BIGINT) AS n_changes FROM (SELECT p, 'NATCG'[call_maf + 1] AS letter, count(*) AS n, sum(count(*)) OVER (PARTITION BY p) AS total FROM masked WHERE call_maf > 0 GROUP BY p, call_maf) QUALIFY row_number() OVER (PARTITION BY p ORDER BY n DESC, letter DESC) = 1")
def tip_changes(x: Inputs) -> DataFrame:
    return tree.tip_changes(x.called, "call").drop("group_id")


@query("SELECT sample_id, p, CAST(CASE WHEN cov < 1 OR qual < 30 OR major_freq < 0.75 THEN 0 ELSE major_nt END AS INTEGER) AS call FROM cells")
def tree_calls(x: Inputs) -> DataFrame:
    return masks.tree_calls(x.cells).select("sample_id", "p", F.col("tree_call").alias("call"))


@query("SELECT p FROM good ORDER BY p LIMIT 2000")
def chart_positions(x: Inputs) -> DataFrame:
    return report.chart_positions(x.prelim).select("p")


_Q = ", ".join(f"coalesce(round_even(avg(CASE WHEN sym = {i} THEN bq END), 0), 0)::BIGINT AS bq{i}" for i in range(1, 9))


@query(f"SELECT sample_id, p, {', '.join(f'count(*) FILTER (sym = {i}) AS c{i}' for i in range(1, 9))}, {_Q} FROM (SELECT *, strand * 4 + nt AS sym FROM reads) GROUP BY sample_id, p")
def pileup_diversity(x: Inputs) -> DataFrame:
    df = candidates.diversity(candidates.parse_pileup(pileup_lines(x)), x.contigs)
    return df.where("c1 + c2 + c3 + c4 + c5 + c6 + c7 + c8 > 0").select("sample_id", "p", *(f"c{i}" for i in range(1, 9)), *(f"bq{i}" for i in range(1, 9)))


def pileup_lines(x: Inputs) -> DataFrame:
    """The adapter's reads written as pileup text."""
    df = x.reads.withColumn("q", F.least("bq", F.lit(60)))
    df = candidates.ref_base(df, x.contigs).join(F.broadcast(x.contigs.select("contig_idx", "contig_name")), "contig_idx")
    letter = F.substring(F.lit("ATCGatcg"), F.col("strand") * 4 + F.col("nt"), F.lit(1))
    match = F.when(F.col("strand") == 0, ".").otherwise(",")
    call = F.when(F.col("nt") == F.col("ref_code"), match).otherwise(letter)
    read = F.struct("read_id", "line", call.alias("c"), F.chr(F.col("q") + 33).alias("b"))
    rows = df.groupBy("sample_id", "contig_name", "contig_pos", "ref_nt").agg(F.sort_array(F.collect_list(read)).alias("r"))
    joined = lambda f: F.array_join(F.transform("r", f), "")
    ones = F.array_join(F.transform("r", lambda r: F.lit("1")), ",")
    fields = [F.col("contig_name"), F.col("contig_pos").cast("string"), F.col("ref_nt"), F.size("r").cast("string"), joined(lambda r: r["c"]), joined(lambda r: r["b"]), joined(lambda r: r["b"]), ones]
    return rows.select("sample_id", F.concat_ws("\t", *fields).alias("value"))


_VCF = "SELECT sample_id, p, contig_idx, contig_pos, -qual::DOUBLE AS fq FROM cells JOIN genome USING (p) WHERE cov > 0 AND major_nt <> ref_code"


def _vcf(x: Inputs) -> DataFrame:
    """The adapter's variants written as VCF rows, with headers to skip."""
    df = candidates.ref_base(x.cells, x.contigs).where((F.col("cov") > 0) & (F.col("major_nt") != F.col("ref_code"))).join(F.broadcast(x.contigs.select("contig_idx", "contig_name")), "contig_idx")
    value = F.concat_ws("\t", "contig_name", F.col("contig_pos").cast("string"), F.lit("."), "ref_nt", bases.int_to_nt(F.col("major_nt")), F.lit("50"), F.lit("."), F.format_string("DP=%d;FQ=-%d", "cov", "qual"))
    return df.select("sample_id", value.alias("value")).union(x.samples.select("sample_id", F.lit("##fileformat=VCFv4.2")))


@query(f"SELECT sample_id, p, CAST(least(round_even(min(fq), 0), 0) AS BIGINT) AS fq FROM ({_VCF}) GROUP BY sample_id, p")
def vcf_quals(x: Inputs) -> DataFrame:
    return candidates.quals(candidates.parse_vcf(_vcf(x)), x.contigs)


@query(f"SELECT DISTINCT sample_id, p FROM ({_VCF}) WHERE fq < -50")
def vcf_variable_positions(x: Inputs) -> DataFrame:
    return candidates.variable_positions(candidates.parse_vcf(_vcf(x)), x.contigs, -50)


@query("SELECT sequence, translate(reverse(sequence), 'ATCG', 'TAGC') AS revcomp, (SELECT string_agg(aa, '' ORDER BY i) FROM (SELECT i, aa FROM range(7) r(i) JOIN codons ON codon = substr(sequence, CAST(i * 3 + 1 AS INTEGER), 3))) AS translation, locustag FROM features")
def sequence_functions(x: Inputs) -> DataFrame:
    return x.features.select("sequence", bases.reverse_complement(F.col("sequence")).alias("revcomp"), bases.translate_cds(F.col("sequence")).alias("translation"), "locustag")


def standin(cube: DataFrame) -> DataFrame:
    """A network's word by position alone, so that SQL can say it too."""
    p = F.col("p")
    return cube.select(*masks.SITE).distinct().select(*masks.SITE, ((p % 10) / 10).alias("prob"), F.when(p % 7 != 0, (p % 2).cast("int")).alias("cnn"))


def caller(x: Inputs, **held: object) -> Caller:
    params = CallParams(filters=PARAMS, recomb_distance=DISTANCE, promoter=PROMOTER, **held)
    return Caller(x.cmt, x.coverage, x.samples, x.contigs, x.features, params, scorer=standin)


_LABELS = f"""
, voted AS (SELECT p, (p % 10) / 10.0::DOUBLE AS prob, CASE WHEN p % 7 <> 0 THEN CAST(p % 2 AS INTEGER) END AS cnn FROM after),
ruled AS (SELECT DISTINCT p FROM fixed),
tokens AS (SELECT p, {_TOKEN} FROM (SELECT p, {_ALLELES} FROM masked GROUP BY p)),
told2 AS (SELECT coalesce(v.p, r.p) AS p, prob, cnn, CASE WHEN r.p IS NULL THEN 0 ELSE 1 END AS rule FROM voted v FULL JOIN ruled r ON r.p = v.p),
spoken AS (SELECT t.*, frac_ambiguous, {_CHECK} AS chk, tk.*, t.p IN (SELECT p FROM recomb) AS recomb, t.p IN (SELECT p FROM before) AND t.p NOT IN (SELECT p FROM after) AS gap
  FROM told2 t JOIN ambiguity a ON a.p = t.p JOIN tokens tk ON tk.p = t.p WHERE cnn = 1 OR rule = 1),
turn AS (SELECT *, qual_filter <> 1 AND coalesce(cnn, 0) <> 1 AND rule = 1 AND NOT (recomb OR gap OR frac_ambiguous > 0.25 OR chk) AS turned FROM spoken),
lab AS (SELECT *, CASE WHEN qual_filter = 1 THEN 0 WHEN cnn = 1 OR turned THEN 1 ELSE 0 END AS label, CASE WHEN qual_filter = 1 THEN 0 WHEN turned THEN 1 ELSE cnn END AS cnn_out,
  CASE WHEN qual_filter = 1 THEN 0.0::DOUBLE WHEN turned THEN coalesce(1 - prob, 1.0::DOUBLE) ELSE prob END AS prob_out FROM turn),
good_all AS (SELECT * FROM lab WHERE label = 1 OR coalesce(cnn_out, 0) = 1 OR rule = 1)
"""


def called(select: str) -> str:
    return s.sql_called(_LABELS + select)


def caller_query(sql: str | None = None) -> Callable:
    """As query, with the whole caller's steps as the common SQL."""

    def held(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        query()(f)
        if sql is not None:
            ORACLES[f.__name__] = called(sql)
        return f

    return held


@caller_query("SELECT p FROM after")
def scorable_positions(x: Inputs) -> DataFrame:
    """What is left for the scorer of the polymorphic positions."""
    return caller(x).tensor.select("p").distinct()


@caller_query("SELECT p FROM before WHERE p NOT IN (SELECT p FROM after)")
def gap_positions(x: Inputs) -> DataFrame:
    return caller(x).gaps.select("p")


@caller_query(f"""SELECT CAST(1 AS INTEGER) AS group_id, p AS genome_pos, CAST(label AS INTEGER) AS pred_label, coalesce(CAST(cnn_out AS VARCHAR), 'skip') AS cnn_pred, rule AS rule_pred,
  coalesce(CAST(prob_out AS VARCHAR), 'skip') AS cnn_prob, {", ".join(f"{st}_filter" for st in masks.STAGES)},
  CAST(CASE WHEN cpn_filter = 0 AND p NOT IN (SELECT p FROM ruled) THEN 1 ELSE cpn_filter END AS INTEGER) AS fix_filter, CAST(recomb AS INTEGER) AS whether_recomb,
  printf('%.6f', frac_ambiguous) AS fraction_ambiguous_samples, CAST(gap AS INTEGER) AS gap_filter FROM good_all""")
def filter_table(x: Inputs) -> DataFrame:
    """The caller from end to end, with the stand-in's word for the network's."""
    return caller(x).filters


@caller_query("SELECT c.sample_id, c.p, c1, c8, CAST(qual AS BIGINT) AS qual, prob_out AS prob, CAST(label AS INTEGER) AS label, recomb FROM cmt c JOIN good_all g ON g.p = c.p")
def final_table(x: Inputs) -> DataFrame:
    return caller(x).final.select("sample_id", "p", "c1", "c8", "qual", "prob", "label", "recomb")


@caller_query("SELECT p, CAST(label AS INTEGER) AS label, recomb FROM good_all")
def final_labels_read(x: Inputs) -> DataFrame:
    """The labels of a final table that was written and read again."""
    return report.table_labels(written(caller(x).final, "final")).select("p", "label", "recomb")


_TREE = "CASE WHEN cov < 1 OR qual < 30 OR major_freq < 0.75 THEN 0 ELSE major_nt END"


@caller_query("""SELECT g.p, pl.locustag, CAST(pl.nt_pos AS BIGINT) AS nt_pos, CAST(q.mut_qual AS BIGINT) AS mut_qual, t.nts, """ + ", ".join(f"t.{n}" for n in _NAMES) + f""" FROM good_all g JOIN places pl ON pl.p = g.p JOIN quality q ON q.p = g.p
  JOIN (SELECT p, string_agg(DISTINCT 'NATCG'[l + 1], '' ORDER BY 'NATCG'[l + 1]) FILTER (l > 0) AS nts, """ + ", ".join(f"max(CASE WHEN sample_id = {i} THEN 'NATCG'[l + 1] END) AS {n}" for i, n in enumerate(_NAMES)) + f" FROM (SELECT p, sample_id, {_TREE} AS l FROM cells) GROUP BY p) t ON t.p = g.p")
def mutation_table(x: Inputs) -> DataFrame:
    return caller(x).mutation_table(_NAMES).select("p", "locustag", "nt_pos", "mut_qual", "nts", *_NAMES)


@caller_query("SELECT p, CAST(CASE WHEN cnn = 1 THEN 1 WHEN frac_ambiguous > 0.25 OR " + _CHECK + " THEN 0 ELSE 1 END AS INTEGER) AS pred, CAST(prob AS VARCHAR) AS prob, " + ", ".join(f"t.{n}" for n in _NAMES) + " FROM voted v JOIN ambiguity a USING (p) JOIN (SELECT p, " + ", ".join(f"max(CASE WHEN sample_id = {i} THEN 'NATCG'[major_nt + 1] END) AS {n}" for i, n in enumerate(_NAMES)) + " FROM cells GROUP BY p) t USING (p) WHERE cnn IS NOT NULL")
def fast_predictions(x: Inputs) -> DataFrame:
    """The same tables in the fast mode."""
    return caller(x, fast_from=10).predictions(_NAMES).drop("group_id")


@caller_query("SELECT label, count(*) AS n FROM (SELECT CASE WHEN label = 1 THEN 'final' ELSE 'label0' END AS label FROM good_all UNION ALL SELECT 'draft' FROM good_all) GROUP BY label")
def merged_by_label(x: Inputs) -> DataFrame:
    """How many rows of the merged report go to each of its tables."""
    told = report.split_by_label(written(caller(x).merged, "merged"))
    parts = [df.select(F.lit(name).alias("label")) for name, df in told.items()]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def reanalysis(x: Inputs, **held: object) -> Reanalysis:
    final = written(caller(x).final, "final")
    return Reanalysis(final, x.samples, x.contigs, x.features, CallParams(filters=PARAMS, promoter=PROMOTER), **held)


_AGAIN = f"""
, again AS (SELECT c.*, CAST({_TREE} AS INTEGER) AS l FROM cells c WHERE p IN (SELECT p FROM good_all WHERE label = 1 AND NOT recomb)),
out2 AS (SELECT q.p, CAST(coalesce(v.l, g.ref_code) AS INTEGER) AS anc FROM (SELECT DISTINCT p FROM again) q JOIN genome g ON g.p = q.p LEFT JOIN (
  SELECT p, l FROM again WHERE in_outgroup AND l > 0 GROUP BY p, l QUALIFY row_number() OVER (PARTITION BY p ORDER BY count(*) DESC, l) = 1) v ON v.p = q.p)
"""


@caller_query()
def reanalysed_calls(x: Inputs) -> DataFrame:
    """A final table read again: loose calls of its kept positions."""
    return reanalysis(x).cells.select("sample_id", "p", "call")


@caller_query()
def reanalysed_mutations(x: Inputs) -> DataFrame:
    return reanalysis(x).fixed.select("sample_id", "p", "call", "anc")


@caller_query()
def reanalysed_extras(x: Inputs) -> DataFrame:
    """With the masks of strand coverage, indels, fraction of N and median coverage."""
    return reanalysis(x, extras=True).cells.select("sample_id", "p", "call")


ORACLES["reanalysed_calls"] = s.sql_called(_LABELS + _AGAIN + "SELECT sample_id, p, l AS call FROM again")
ORACLES["reanalysed_mutations"] = s.sql_called(_LABELS + _AGAIN + "SELECT sample_id, a.p, l AS call, anc FROM again a JOIN out2 o ON o.p = a.p WHERE NOT in_outgroup AND l > 0 AND l <> anc")
ORACLES["reanalysed_extras"] = s.sql_called(_LABELS + _AGAIN + f""", e1 AS (SELECT *, CASE WHEN fwd_cov < {s.STRAND} OR rev_cov < {s.STRAND} OR (cov > 0 AND (ins + del)::DOUBLE / cov > {s.INDEL}) THEN 0 ELSE l END AS e FROM again),
e2 AS (SELECT p, avg(CASE WHEN e = 0 THEN 1.0::DOUBLE ELSE 0 END) > {s.FRAC} OR median(cov) < {s.MEDIAN} AS gone FROM e1 GROUP BY p)
SELECT sample_id, e1.p, CAST(CASE WHEN gone THEN 0 ELSE e END AS INTEGER) AS call FROM e1 JOIN e2 ON e2.p = e1.p""")


@query(f"SELECT sample_id FROM ({_SNVS}) WHERE n >= 13")
def samples_excluded(x: Inputs) -> DataFrame:
    return variants.samples_to_exclude(variants.snvs_per_sample(x.cells), 13).select("sample_id")


@query("SELECT sample_id, p, CAST(CASE WHEN sample_id IN (2, 5) THEN 0 ELSE call_maf END AS INTEGER) AS call FROM masked")
def mask_samples(x: Inputs) -> DataFrame:
    lost = x.samples.where("sample_id in (2, 5)")
    return masks.mask_samples(x.called, "call", lost).select("sample_id", "p", F.col("sample_call").alias("call"))


@query("SELECT p, CASE WHEN n > 0 THEN a::DOUBLE / n ELSE 0 END AS frac_ambiguous FROM (SELECT c.p, count(*) FILTER (major_nt = modal) AS n, count(*) FILTER (major_nt = modal AND major_freq > 0 AND major_freq < 1) AS a FROM cells c JOIN ranks ON ranks.p = c.p GROUP BY c.p)")
def ambiguity_fraction_strict(x: Inputs) -> DataFrame:
    """The scoring path's variant: any frequency under 1 is ambiguous."""
    return variants.ambiguity(x.cells, 1.0).select("p", "frac_ambiguous")


@query("SELECT DISTINCT CAST(group_id AS INTEGER) AS group_id FROM cmt")
def distinct_groups(x: Inputs) -> DataFrame:
    return x.cmt.select("group_id").distinct()


@query("""SELECT sample_name, CASE WHEN length(led) < 10 THEN lpad(led, 10, '0') ELSE led END AS renamed FROM (SELECT sample_name, CASE WHEN regexp_matches(n, '^[A-Za-z]') THEN n ELSE 'S' || n END AS led FROM (
  SELECT sample_name, substr(sample_name, CAST(1 + sample_id % 9 AS INTEGER)) AS n FROM samples))""")
def sample_renamed(x: Inputs) -> DataFrame:
    cut = F.substring("sample_name", (F.col("sample_id") % 9 + 1).cast("int"), F.lit(99))
    return x.samples.select("sample_name", report.renamed(cut).alias("renamed"))


@query("SELECT '>' || name || chr(10) || sequence AS value FROM (SELECT sample_name AS name, string_agg('NATCG'[call_maf + 1], '' ORDER BY p) AS sequence FROM masked JOIN samples USING (sample_id) GROUP BY sample_name UNION ALL SELECT 'inferred_ancestor', string_agg('NATCG'[anc + 1], '' ORDER BY p) FROM anc)")
def fasta_text(x: Inputs) -> DataFrame:
    return tree.fasta(tree.alignment(x.called, "call", x.samples, x.anc)).select("value")


@query("SELECT p, CAST(length(aa_gt) - 1 AS INTEGER) AS n, CASE WHEN length(aa_gt) > 1 THEN array_to_string(list_transform(range(2, length(aa_gt) + 1), lambda i: aa_gt[1] || aa_pos || aa_gt[i]), ',') ELSE '.' END AS muts FROM annotated WHERE gene_idx IS NOT NULL")
def mutation_strings(x: Inputs) -> DataFrame:
    return x.annotated.where("gene_idx is not null").select("p", (F.length("aa_gt") - 1).alias("n"), "muts")


SNV = "SELECT p, count(*) FILTER (call_maf = 1) AS n_a, count(*) FILTER (call_maf = 2) AS n_t, count(*) FILTER (call_maf = 3) AS n_c, count(*) FILTER (call_maf = 4) AS n_g FROM masked GROUP BY p HAVING count(DISTINCT CASE WHEN call_maf > 0 THEN call_maf END) >= 2"


def snv_table(cells: DataFrame, call: str) -> DataFrame:
    """Positions with two alleles and how many samples call each."""
    counted = cells.groupBy("p").agg(*(F.count_if(F.col(call) == i).alias(f"n_{n}") for i, n in enumerate("atcg", 1)))
    return counted.where("int(n_a > 0) + int(n_t > 0) + int(n_c > 0) + int(n_g > 0) >= 2")


@query(SNV)
def snv_positions(x: Inputs) -> DataFrame:
    return snv_table(x.called, "call")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship at loose thresholds: cells there have a few reads."""
    x = Inputs(spark, sf_dir)
    loose = FilterParams(min_qual=30, min_strand_cov=1, min_major_freq=0.5)
    return snv_table(masks.element_masks(x.cells, loose), "call_maf").orderBy("p")
