"""Small fixtures with results worked out by hand, one for each trap."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basewise.functions import bases, stats
from basewise.functions.cells import attributes
from basewise.operators import annotate, candidates, dnds, masks, score, tree, variants
from basewise.operators import coverage as co

CELL = "group_id int, sample_id int, p long, in_outgroup boolean, c1 long, c2 long, c3 long, c4 long, c5 long, c6 long, c7 long, c8 long, qual long, ins long, del long"


def cells(spark, rows):
    """rows: (sample, p, outgroup, eight counts, qual)."""
    return spark.createDataFrame([(1, s, p, o, *c, q, 0, 0) for s, p, o, c, q in rows], CELL)


@pytest.fixture(scope="module")
def genome(spark):
    return spark.createDataFrame([(1, "a", 1, 12, "ATGAAATTTTAA"), (2, "b", 13, 8, "CCCCGGGG")], "contig_idx int, contig_name string, contig_start long, contig_len long, seq string")


def test_ties_go_to_the_greater_code(spark):
    got = attributes(cells(spark, [(0, 1, False, (3, 0, 3, 0, 0, 0, 0, 0), 40), (1, 1, False, (0,) * 8, 0)])).orderBy("sample_id").collect()
    assert (got[0].major_nt, got[0].minor_nt, got[0].major_freq) == (3, 1, 0.5)
    assert (got[1].major_nt, got[1].minor_nt, got[1].major_freq, got[1].minor_freq) == (0, 0, 0.0, None)


def test_minor_allele_without_reads_keeps_a_code(spark):
    got = attributes(cells(spark, [(0, 1, False, (5, 0, 0, 0, 0, 0, 0, 0), 40)])).first()
    assert (got.major_nt, got.minor_nt, got.counts_minor, got.minor_nt_fwd, got.major_nt_rev) == (1, 4, 0, 0, 0)


def test_masks_only_turn_calls_to_n(spark, genome):
    df = attributes(cells(spark, [(s, p, False, (9, s, 0, 0, 9, 0, p, 0), 10 * s + p) for s in range(4) for p in (1, 2, 13)]))
    cov = spark.createDataFrame([(1, s, p, 10) for s in range(4) for p in range(1, 21)], "group_id int, sample_id int, p long, cov long")
    got = masks.apply_masks(df, cov, genome, masks.FilterParams(min_qual=15, min_strand_cov=2)).collect()
    for row in got:
        last = row.call_start
        for stage in masks.STAGES:
            assert row[f"call_{stage}"] in (0, last)
            last = row[f"call_{stage}"]
    tokens = masks.filter_tokens(masks.apply_masks(df, cov, genome)).collect()
    assert {t[f"{s}_filter"] for t in tokens for s in masks.STAGES} <= {-1, 0, 1}


def test_zero_median_copy_numbers(spark, genome):
    df = attributes(cells(spark, [(0, 1, False, (5,) + (0,) * 7, 40), (1, 1, False, (5,) + (0,) * 7, 40), (0, 2, False, (0,) * 8, 40), (1, 2, False, (5,) + (0,) * 7, 40)]))
    cov = spark.createDataFrame([(1, s, p, 5 * s) for s in (0, 1) for p in range(1, 21)], "group_id int, sample_id int, p long, cov long")
    got = {r.p: r for r in masks.copy_numbers(df, cov, genome).groupBy("p").agg(*(v.alias(k) for k, v in masks.site_copy().items())).collect()}
    assert math.isinf(got[1].mean_copy) and got[2].mean_copy == 0


def test_mutation_quality_is_the_pairwise_one(spark):
    rng = np.random.default_rng(1)
    rows = [(s, p, False, tuple(int(9 * (i == rng.integers(0, 5))) for i in range(8)), int(rng.integers(0, 90))) for p in range(1, 60) for s in range(6)]
    df = attributes(cells(spark, rows)).withColumn("call", F.col("major_nt"))
    got = {r.p: r.mut_qual for r in variants.mutation_quality(df, "call").collect()}
    held = {}
    for r in df.collect():
        held.setdefault(r.p, []).append((r.sample_id, r.call, r.qual))
    first = {r.p: (r.sample_a, r.sample_b) for r in variants.quality_pair(df, "call").collect()}
    for p, told in held.items():
        told.sort()
        pairs = [(min(a[2], b[2]), a[0], b[0]) for a in told for b in told if a[1] and b[1] and a[1] != b[1]]
        assert got[p] == (max(x[0] for x in pairs) if pairs else None)
        if pairs:
            best = max(x[0] for x in pairs)
            assert first[p] == min((a, b) for q, a, b in pairs if q == best)


def test_recombination_needs_a_centre(spark, genome):
    rows, anc = [], []
    for p in (1, 900, 1800):
        for s in range(4):
            on = s < 2 if p != 900 else s % 2
            rows.append((s, p, False, ((0, 9) if on else (9, 0)) + (0,) * 6, 50))
        anc.append((1, p, 1))
    df, anc = attributes(cells(spark, rows)), spark.createDataFrame(anc, "group_id int, p long, anc int")
    pairs = variants.recombinant_pairs(df, anc, anc).collect()
    assert [(r.a, r.b) for r in pairs] == [(1, 1800)]
    assert not variants.recombinant_pairs(df, anc, anc.where("p <> 900")).collect()


def test_ancestor_is_the_lower_code_on_ties_and_the_reference_without_calls(spark, genome):
    df = attributes(cells(spark, [(0, 1, True, (9,) + (0,) * 7, 50), (1, 1, True, (0, 9) + (0,) * 6, 50), (0, 3, True, (0,) * 8, 0)]))
    got = {r.p: r.anc for r in variants.ancestral(df, "major_nt", genome).collect()}
    assert got == {1: 1, 3: 4}


def test_pileup_calls():
    assert candidates.parse_calls("^].,$+2AGT-12ACGTACGTACGTa*", "A") == ([1, 5, 2, 5, 0], [2], [12])
    assert candidates.parse_calls("^^..", "c")[0] == [3, 3]
    assert candidates.parse_calls("ACgt", "N")[0] == [1, 3, 8, 6]
    with pytest.raises(ValueError):
        candidates.parse_calls(".", "N")


def test_diversity_and_indels(spark, genome):
    lines = spark.createDataFrame([(0, "a\t3\tG\t3\t.,A+1T\tIIJ\tIII\t1,2,4"), (0, "a\t12\tA\t1\t.-2CC\tI\tI\t7")], "sample_id int, value string")
    got = {r.p: r for r in candidates.diversity(candidates.parse_pileup(lines), genome).collect()}
    assert (got[3].c4, got[3].c8, got[3].c1, got[3].bq4, got[3].bq1, got[3].dq1) == (1, 1, 1, 40, 41, 4)
    assert sorted(p for p, r in got.items() if r.ins) == [1, 2, 3, 4, 5] and sorted(p for p, r in got.items() if r["del"]) == [9, 10, 11, 12]


def test_vcf_rows(spark, genome):
    lines = spark.createDataFrame([(0, "#CHROM"), (0, "a\t2\t.\tT\tC\t9\t.\tDP=3;FQ=-30.5"), (0, "a\t2\t.\tT\tG\t9\t.\tFQ=4"), (0, "b\t1\t.\tC\tA,T\t9\t.\tFQ=-99"), (0, "b\t2\t.\tCC\tA\t9\t.\tFQ=-99")], "sample_id int, value string")
    parsed = candidates.parse_vcf(lines)
    assert [(r.p, r.fq) for r in candidates.quals(parsed, genome).collect()] == [(2, -30)]
    assert [r.p for r in candidates.variable_positions(parsed, genome).collect()] == [2]


def test_positions_round_trip(spark, genome):
    every = spark.range(1, 21).withColumnRenamed("id", "p")
    there = co.with_contig(every, genome)
    assert sorted(r.p for r in co.to_global(there.drop("p"), genome).collect()) == list(range(1, 21))
    assert [(r.contig_idx, r.contig_pos) for r in there.where("p in (12, 13)").orderBy("p").collect()] == [(1, 12), (2, 1)]


def test_overlapping_genes_and_places_before_the_first(spark, genome):
    features = spark.createDataFrame([(1, 1, "x", "g", 1, 1, 9, "ATGAAATTT", "MKF"), (1, 2, "y", "h", -1, 7, 12, "TTAAAA", "LK")], "contig_idx int, gene_idx int, locustag string, gene string, strand int, loc1 long, loc2 long, sequence string, translation string")
    every = spark.range(1, 21).withColumnRenamed("id", "p")
    hits = {r.p: r.locustag for r in annotate.gene_hits(every, genome, features, bucket=4).collect()}
    assert hits[6] == "x" and hits[7] == hits[9] == hits[12] == "y" and hits[13] is None
    effects = {r.p: (r.codon, r.aas, r.nt_pos) for r in annotate.codon_effects(annotate.gene_hits(every, genome, features)).collect()}
    assert effects[4] == ("AAA", "K*QE", 4) and effects[12] == ("TTA", "LIVL", 1)


def test_golden_codon_places(spark):
    rows = [(10866, 9514, 1, 1353, 451), (265874, 265307, 1, 568, 190), (311601, 311282, 1, 320, 107)]
    hits = spark.createDataFrame([(p, p, 1, lo, lo + 3000, "A" * 3000, "K" * 1000) for p, lo, *_ in rows], "p long, contig_pos long, strand int, loc1 long, loc2 long, sequence string, translation string")
    got = {r.p: (r.nt_pos, r.aa_pos) for r in annotate.codon_effects(hits).collect()}
    assert got == {p: (nt, aa) for p, _, _, nt, aa in rows}
    first = annotate.codon_effects(hits.where("p = 10866")).first()
    assert first.aas == "KNNK"


def test_sequences(spark):
    df = spark.createDataFrame([("ATGNaa",)], "s string")
    got = df.select(bases.reverse_complement(F.col("s")).alias("r"), bases.translate_cds(F.col("s")).alias("t"), bases.ordered_letters(F.lit("TTAGA")).alias("o")).first()
    assert (got.r, got.t, got.o) == ("TTNCAT", "MX", "TAG")


def test_statistics():
    assert abs(stats.normal_cdf(1.959963984540054) - 0.975) < 1e-12
    assert abs(stats.t_two_sided(2.2281388519649385, 10) - 0.05) < 1e-9
    assert abs(stats.beta_quantile(0.5, 2, 2) - 0.5) < 1e-12 and abs(stats.beta_cdf(0.3, 2, 5) - 0.579825) < 1e-6
    assert stats.welch(1, 0, 5, 1, 0, 5) is None and stats.one_sample(1, 0, 5, 2) is None


@pytest.mark.parametrize("x,n", [(0, 0), (0, 10), (10, 10), (3, 10)])
def test_binomial_bounds(x, n):
    low, high = dnds.binomial_interval(x, n)
    if n == 0:
        assert (low, high) == (0, 0)
    elif x in (0, n):
        assert abs((high if x == 0 else 1 - low) - (1 - 0.025 ** (1 / n))) < 1e-12
    else:
        tail = sum(math.comb(n, k) * low**k * (1 - low) ** (n - k) for k in range(x, n + 1))
        assert abs(tail - 0.025) < 1e-9


def test_spectrum_switch(spark):
    usage = spark.createDataFrame([("AAA", 5), ("GCT", 3)], "codon string, n long")
    even, skew = [(1, c, 1) for c in dnds.CLASSES], [(2, c, 100 if c == "AT/TA" else 0) for c in dnds.CLASSES]
    both = spark.createDataFrame(even + skew, "group_id int, class string, n long")
    got = {r.group_id: r.p_nonsyn for r in dnds.expected_nonsynonymous(usage, both).collect()}
    assert got[1] != got[2] and 0 <= got[1] <= 1


def test_labels(spark):
    rows = [(1, 1, 1, 0.9, 1, False, False, 0.0, False), (2, 1, 0, 0.2, 0, False, False, 0.0, False), (3, 1, None, None, 0, False, False, 0.0, False), (4, 1, 0, 0.2, 0, True, False, 0.0, False), (5, 0, 1, 0.8, 0, True, False, 0.9, True)]
    df = spark.createDataFrame([(1, *r) for r in rows], "group_id int, p long, rule int, cnn int, prob double, qual_filter int, recomb boolean, gap boolean, frac_ambiguous double, check boolean")
    got = {r.p: (r.label, r.cnn_out, r.prob_out, r.good, r.good_all) for r in variants.final_labels(df, 12).collect()}
    assert got == {1: (0, 0, 0.0, True, True), 2: (1, 1, 0.8, False, True), 3: (1, 1, 1.0, False, True), 4: (0, 0, 0.2, False, True), 5: (1, 1, 0.8, False, True)}


def test_neighbour_joining_and_fitch():
    d = np.array([[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]], float)
    edges = tree.neighbour_joining(list("abcde"), d)
    near = {c: x for _, c, x in edges}
    assert near["a"] == 2 and near["b"] == 3 and len(edges) == 7
    assert tree.newick(edges).endswith(";") and all(n in tree.newick(edges) for n in "abcde")
    assert tree.fitch(edges, dict(zip("abcde", "AATTT", strict=True))) == 1
    assert tree.fitch(edges, dict(zip("abcde", "AAAAN", strict=True))) == 0


def test_scorer_by_hand():
    w, x = score.random_weights(3), np.random.default_rng(2).random((4, 5, 8))
    y = np.pad(x, ((0, 0), (1, 1), (1, 1)))
    k, out = w["conv1.weight"], score.convolve(x, w["conv1.weight"], w["conv1.bias"], (1, 1))
    want = sum((k[2, i] * y[i, 1:4, 2:6]).sum() for i in range(4)) + w["conv1.bias"][2]
    assert out.shape == (32, 5, 7) and abs(out[2, 1, 2] - want) < 1e-9
    assert 0 < score.forward(x, w) < 1


def test_running_sums_over_buckets(spark):
    from basewise.functions.windows import running_sum

    rng = np.random.default_rng(2)
    held = [(int(i), int(rng.integers(0, 9))) for i in rng.permutation(300)]
    df = spark.createDataFrame(held, "line long, v long").repartition(4)
    got = {r.line: r.before for r in running_sum(df, F.col("v"), "line", F.floor(F.col("line") / 37), "before").collect()}
    assert got == {i: sum(v for j, v in held if j < i) for i, _ in held}


def test_scorer_gradients():
    w, x = score.random_weights(3), np.random.default_rng(2).random((4, 5, 8))
    for label in (0, 1):
        loss, got = score.gradients(x, label, w)
        p = score.forward(x, w)
        assert abs(loss + np.log(p if label else 1 - p)) < 1e-9
        for name, g in got.items():
            at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
            up, down = ({**w, name: w[name].copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (score.gradients(x, label, up)[0] - score.gradients(x, label, down)[0]) / 2e-5
            assert abs(slope - g[at]) < 1e-6 + 1e-4 * abs(g[at])


def test_scorer_learns():
    rng = np.random.default_rng(5)
    labels = [i % 2 for i in range(48)]
    sites = [rng.random((4, 5, 8)) + 2.0 * y * (np.arange(4) == 1)[:, None, None] for y in labels]
    w = score.train(sites[:32], labels[:32], (sites[32:], labels[32:]), epochs=25, patience=5)
    assert sum((score.forward(x, w) > 0.5) == y for x, y in zip(sites[32:], labels[32:], strict=True)) >= 14


def test_pairwise_distance_of_words(spark):
    """Packed words against positions one by one, over several words."""
    rng = np.random.default_rng(6)
    held = {(s, p): int(rng.integers(0, 5)) for s in range(5) for p in [*range(1, 200, 3), 64, 128, 5000]}
    df = spark.createDataFrame([(1, s, p, c) for (s, p), c in held.items()], "group_id int, sample_id int, p long, call int")
    got = {(r.sample_a, r.sample_b): (r.compared, r.different) for r in tree.pairwise_distance(df, "call").collect()}
    for a in range(5):
        for b in range(a + 1, 5):
            both = [(held[a, p], held[b, p]) for s, p in held if s == 0 and held[a, p] and held[b, p]]
            assert got[a, b] == (len(both), sum(x != y for x, y in both))


def test_genes_around_in_buckets(spark, genome):
    rows = [(1, 1, "x", "g", 1, 3, 4), (1, 2, "y", "h", -1, 6, 7), (1, 3, "long", "h", -1, 6, 9), (1, 4, "z", "k", 1, 11, 12)]
    features = spark.createDataFrame(rows, "contig_idx int, gene_idx int, locustag string, gene string, strand int, loc1 long, loc2 long")
    every = spark.range(1, 21).withColumnRenamed("id", "p")
    for bucket in (2, 100):
        got = {r.p: (r.locustag1, r.locustag2, r.distance1, r.distance2) for r in annotate.gene_neighbours(every, genome, features, bucket).collect()}
        assert got[1] == (None, "x", None, -2) and got[5] == ("x", "y", 1, 1)
        assert got[10] == ("long", "z", -1, -1) and got[12] == ("z", None, 0, None) and got[13] == (None,) * 4 and len(got) == 20


def test_single_position_trees(spark, genome):
    told = tree.nexus("((s1:1,s2:2)n1:1,s3:1);", {"s1": "A", "s2": "T"})
    assert "'s1--*A'[&!color=#-16776961]" in told and "'s3--*?'[&!color=#-16777216]" in told and "ntax=3" in told and "(('s1--*A':1,'s2--*T':2)" in told
    df = spark.createDataFrame([(1, 13, "s1", 2), (1, 13, "s2", 0)], "group_id int, p long, sample_name string, call int")
    assert [tuple(r) for r in tree.snp_chart(df, "call", genome, ["s1", "s2"]).collect()] == [(1, 2, 1, "T", "N")]


def test_frequent_calls(spark):
    from basewise.operators import tensor

    df = spark.createDataFrame([(1, p, c) for p, told in ((1, [1, 1, 2, 3, 0]), (2, [2, 1]), (3, [0])) for c in told], "group_id int, p long, call int")
    assert {r.p: (r.most, r.least) for r in tensor.frequent(df, "call").collect()} == {1: (1, 2), 2: (1, 1), 3: (None, None)}


def test_evaluation(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (1, 0.1)], "label int, prob double")
    got = score.evaluation(df).first()
    assert abs(got.auc - 3.5 / 6) < 1e-12 and got.precision == 2 / 3 and got.recall == 2 / 3


def test_the_scorer_is_given_filtered_positions(spark, genome):
    from basewise.plans.caller import Caller
    from basewise.sources import adapter

    a, t, none = (12, 0, 0, 0, 12, 0, 0, 0), (0, 12, 0, 0, 0, 12, 0, 0), (0,) * 8
    at = {  # p: the majority's counts, sample 0's, the minority's
        1: (a, a, t),
        2: (a, a, (0, 12, 0, 0, 12, 0, 0, 0)),  # the strands disagree
        3: (a, a, (4, 6, 0, 0, 4, 6, 0, 0)),  # frequency 0.6
        4: (a, a, (0, 2, 0, 0, 0, 1, 0, 0)),  # one read on a strand
        5: (a, a, (20, 150, 0, 0, 20, 150, 0, 0)),  # contaminated
        6: (a, (12, 1, 0, 0, 12, 1, 0, 0), (0, 2, 0, 0, 0, 2, 0, 0)),  # thin and ambiguous
        7: (a, a, (0, 2, 0, 0, 0, 2, 0, 0)),  # thin only
    }
    rows = [(s, p, False, (first if s == 0 else few if s in (2, 3) else none if s == 5 else most), 40) for p, (most, first, few) in at.items() for s in range(6)]
    coverage = spark.createDataFrame([(1, s, p, 24) for s in range(6) for p in range(1, 21)], "group_id int, sample_id int, p long, cov long")
    samples = spark.createDataFrame([(s, f"s{s}", False, 1, "PE") for s in range(6)], "sample_id int, sample_name string, in_outgroup boolean, group_id int, seq_type string")
    out = Caller(cells(spark, rows), coverage, samples, genome, adapter.features(spark), weights=score.random_weights())
    assert {r.p for r in out["scores"].collect()} == {1, 7}
    assert {r.p for r in out["gaps"].collect()} == {5}
    assert {r.sample_id for r in out["tensor"].select("sample_id").distinct().collect()} == {0, 1, 2, 3, 4}
    assert {r.genome_pos for r in out["filters"].where("cnn_prob <> 'skip'").collect()} <= {1, 7}


def two_groups(spark):
    """Two groups over the same positions: their calls, coverage and samples."""
    rng = np.random.default_rng(7)
    rows, coverage, samples = [], [], []
    for g in (1, 2):
        for s in range(6):
            samples.append((s + 10 * g, f"g{g}s{s}", s == 5, g, "PE"))
            for p in range(1, 21):
                coverage.append((g, s + 10 * g, p, int(rng.integers(18, 30))))
                if p % 3 == 0 and (p + g) % 2:
                    continue
                major = (p + (1 if s < 2 and rng.random() < 0.6 else 0) + (g == 2 and p % 5 == 0 and s < 3)) % 4
                counts = [0] * 8
                counts[major] = counts[major + 4] = int(rng.integers(8, 14))
                counts[(major + 1) % 4] = int(rng.integers(0, 2))
                rows.append((g, s + 10 * g, p, s == 5, *counts, int(rng.integers(35, 60)), 0, 0))
    return (
        spark.createDataFrame(rows, CELL),
        spark.createDataFrame(coverage, "group_id int, sample_id int, p long, cov long"),
        spark.createDataFrame(samples, "sample_id int, sample_name string, in_outgroup boolean, group_id int, seq_type string"),
    )


def test_groups_stay_apart(spark, genome):
    """Every table of two groups at once is that of each alone."""
    from basewise.plans.caller import Caller, Reanalysis
    from basewise.plans.queries import standin
    from basewise.sources import adapter

    tables, features = two_groups(spark), adapter.features(spark)
    names = [r.sample_name for r in tables[2].orderBy("sample_name").collect()]
    both = Caller(*tables, genome, features, scorer=standin)
    alone = [Caller(*(t.where(F.col("group_id") == g) for t in tables), genome, features, scorer=standin) for g in (1, 2)]
    told = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    for name in ("filters", "merged", "annotation", "dnds", "distances", "final", "pairwise", "alignment", "fixed", "gaps"):
        assert told(both[name]) == sorted(told(alone[0][name]) + told(alone[1][name])), name
    assert both["filters"].select("group_id").distinct().count() == 2
    assert told(both.mutation_table(names)) == sorted(told(alone[0].mutation_table(names)) + told(alone[1].mutation_table(names)))
    again = Reanalysis(both.final, tables[2], genome, features)
    parts = [Reanalysis(c.final, tables[2].where(F.col("group_id") == g), genome, features) for g, c in zip((1, 2), alone, strict=True)]
    for name in ("fixed", "annotation", "distances", "dnds", "alignment"):
        assert told(again[name]) == sorted(told(parts[0][name]) + told(parts[1][name])), name


def test_outputs_are_read_again(spark, genome, tmp_path):
    """What the caller writes, twice, is what it says."""
    from basewise.plans.caller import Caller
    from basewise.plans.outputs import write_call, write_coverage
    from basewise.plans.queries import standin
    from basewise.sources import adapter

    tables = two_groups(spark)
    names = sorted(r.sample_name for r in tables[2].collect())
    out = Caller(*tables, genome, adapter.features(spark), scorer=standin)
    for _ in range(2):
        write_call(out, str(tmp_path / "out"), names)
    read = lambda name, sep="\t": spark.read.csv(str(tmp_path / "out" / name), sep=sep, header=True)
    assert read("filters").count() == out.filters.count() == read("merged_draft").count() > 0
    rows = lambda name: read(name).count() if list((tmp_path / "out" / name).rglob("part-*")) else 0
    assert rows("merged_final") + rows("merged_label0") == rows("merged_draft")
    assert {r.group_id for r in read("mutations").collect()} == {r.group_id for r in out.annotation.collect()} and set(names) <= set(read("mutations").columns)
    assert read("distances", ",").count() == out.distances.count() == 10 and read("snvs_per_sample", ",").count() == 12
    assert spark.read.parquet(str(tmp_path / "out" / "final")).count() == out.final.count()
    text = [r.value for r in spark.read.text(str(tmp_path / "out" / "sequences")).collect()]
    assert sum(v.startswith(">") for v in text) == len(names) + 2
    write_coverage(tables[1], str(tmp_path / "cov"))
    assert spark.read.parquet(str(tmp_path / "cov" / "normalised")).count() == tables[1].count()


def test_call_parameters_are_live(spark, genome):
    """Each parameter that leaves samples or rules out does so."""
    from basewise.plans.caller import Caller, CallParams
    from basewise.plans.queries import standin
    from basewise.sources import adapter

    tables, features = two_groups(spark), adapter.features(spark)
    kept = lambda **held: {r.sample_id for r in Caller(*tables, genome, features, CallParams(**held), scorer=standin).kept[0].select("sample_id").distinct().collect()}
    every = kept()
    assert kept(exclude=(11,)) == every - {11}
    medians = {r.sample_id: r.median_cov for r in co.chromosome_median(tables[1], genome).collect()}
    least = sorted(medians.values())[4]
    assert kept(min_sample_cov=least) == {s for s in every if medians[s] >= least}
    counts = {r.sample_id: r.n_snvs for r in variants.snvs_per_sample(attributes(tables[0])).collect()}
    most = max(counts.values())
    assert kept(exclude_from_snvs=most) == {s for s in every if counts[s] < most}
    strict = masks.FilterParams(min_qual=45)
    assert kept(max_sample_n=0.3, filters=strict) < every and {15, 25} <= kept(max_sample_n=0.3, filters=strict)
    fast = Caller(*tables, genome, features, CallParams(fast_from=13), scorer=standin)
    sizes = {r.group_id: r.fast for r in fast.sizes.collect()}
    assert set(sizes.values()) == {True, False} or all(sizes.values())
    slow = {g for g, on in sizes.items() if not on}
    assert {r.group_id for r in fast.filters.collect()} <= slow
    names = [r.sample_name for r in tables[2].collect()]
    assert {r.group_id for r in fast.predictions(names).collect()} == set(sizes) - slow


def test_near_positions_need_no_whole_group(spark):
    from basewise.operators import tensor

    rng = np.random.default_rng(3)
    held = sorted({int(x) for x in rng.integers(1, 3000, 120)})
    df = spark.createDataFrame([(g, p) for g in (1, 2) for p in held[g:]], "group_id int, p long")
    got = {(r.group_id, r.p) for r in tensor.near_three(df, 50).collect()}
    assert got == {(g, p) for g in (1, 2) for p in held[g:] if sum(0 < abs(p - q) <= 50 for q in held[g:]) > 2}


def test_recombination_reaches_like_the_definition(spark, genome):
    """Pairs of positions that some good position has within its reach."""
    rng = np.random.default_rng(5)
    held = sorted({int(x) for x in rng.integers(1, 900, 40)})
    rows = [(s, p, False, ((0, 9) if s < 2 else (9, 0)) + (0,) * 6, 50) for p in held for s in range(4)]
    df, anc = attributes(cells(spark, rows)), spark.createDataFrame([(1, p, 1) for p in held], "group_id int, p long, anc int")
    got = {(r.a, r.b) for r in variants.recombinant_pairs(df, anc, anc, 30).collect()}
    assert got == {(a, b) for a in held for b in held if a < b and any(abs(a - c) < 30 and abs(b - c) < 30 for c in held)}


def test_histogram_edges(spark):
    from basewise.operators import report

    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 9, 10, 10)] + [(None,)], "v double")
    told = lambda **held: {r.bin: r.n for r in report.histogram(df, F.col("v"), **held).collect()}
    assert told(bins=5) == {0: 2, 1: 1, 4: 3}
    assert told(bins=2, low=0, high=2) == {0: 1, 1: 2} and told(width=4) == {0: 3, 2: 3}
    assert report.histogram(df.where("v = 1"), F.col("v"), 5).collect()[0].bin == 0
    assert report.histogram(df.where("false"), F.col("v"), 5).count() == 0


def test_gap_tests_are_those_of_the_definitions(spark):
    """Student's and Welch's p against sums over the samples themselves."""
    from basewise.operators import tensor

    rng = np.random.default_rng(8)
    rows, depths = [], {}
    for p in (1, 2, 3):
        few = {1: 1, 2: 3, 3: 0}[p]
        for s in range(12):
            n = int(rng.integers(1, 5)) if s < few else int(rng.integers(20, 40))
            depths[s, p] = n
            rows.append((s, p, False, ((0, n) if s < few else (n, 0)) + (0,) * 6, 50))
    medians = spark.createDataFrame([(1, s, 20.0 + s) for s in range(12)], "group_id int, sample_id int, median_cov double")
    got = {r.p: r for r in tensor.gap_statistics(attributes(cells(spark, rows)), medians, "major_nt").collect()}
    for p, few in ((1, 1), (2, 3)):
        low, high = ([depths[s, p] / (20 + s) for s in span] for span in (range(few), range(few, 12)))
        gap = 1 - stats.normal_cdf(abs(np.mean(high) - np.mean(low)) / np.std(high, ddof=1))
        t = (np.mean(high) - low[0]) / (np.std(high, ddof=1) / np.sqrt(len(high))) if few == 1 else (np.mean(high) - np.mean(low)) / np.sqrt(np.var(high, ddof=1) / len(high) + np.var(low, ddof=1) / len(low))
        a, b = (np.var(x, ddof=1) / len(x) if len(x) > 1 else 0 for x in (high, low))
        df = len(high) - 1 if few == 1 else (a + b) ** 2 / (a**2 / (len(high) - 1) + b**2 / (len(low) - 1))
        assert abs(got[p].p_gap - gap) < 1e-9 and abs(got[p].p_value - stats.t_two_sided(t, df)) < 1e-9
    assert got[3].p_value is None and got[3].p_gap is None
