"""The DuckDB twins' common part: reads, cells, attributes, masks."""

from __future__ import annotations

_COUNTS = ", ".join(f"count(*) FILTER (strand = {s} AND nt = {n}) AS c{4 * s + n}" for s in (0, 1) for n in (1, 2, 3, 4))
_ZEROED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in [*(f"c{i}" for i in range(1, 9)), "qual", "ins", "del"])


def _ranked(counts: list[str]) -> str:
    return "list_reverse_sort([" + ", ".join(f"({n}) * 8 + {i}" for i, n in enumerate(counts, 1)) + "])"


_BOTH = _ranked([f"c{i} + c{i + 4}" for i in (1, 2, 3, 4)])
_FWD, _REV = _ranked([f"c{i}" for i in (1, 2, 3, 4)]), _ranked([f"c{i}" for i in (5, 6, 7, 8)])

#: The masks' thresholds in the registered queries; see queries.PARAMS.
QUAL, STRAND, MAF, INDEL, FRAC, MEDIAN, MEAN_COPY, MAX_COPY = 50, 10, 0.9, 0.05, 0.7, 20, 1.05, 1.5

BASE = f"""
WITH RECURSIVE r0 AS (
  SELECT CAST(l_suppkey % 12 AS INTEGER) AS sample_id, l_partkey % 200 + 1 AS p, l_linenumber % 2 AS strand,
    CAST(round(l_discount * 100) AS INTEGER) AS d, CAST(round(l_tax * 100) AS INTEGER) AS t, CAST(round(l_quantity) AS BIGINT) AS bq,
    l_orderkey AS read_id, l_linenumber AS line, l_returnflag AS flag FROM lineitem),
reads AS (
  SELECT *, CASE WHEN d >= 10 THEN read_id % 4 + 1
    WHEN p % 3 <> 0 AND (sample_id * 7 + p * 3) % 11 = 0 THEN ((p * p + p // 5) + 1 + p % 2) % 4 + 1
    ELSE (p * p + p // 5) % 4 + 1 END AS nt FROM r0),
samples AS (SELECT CAST(range AS INTEGER) AS sample_id, range = 11 AS in_outgroup, printf('sample_%02d', range) AS sample_name FROM range(12)),
contigs AS (SELECT * FROM (VALUES (1, 'contig_1', 1, 120), (2, 'contig_2', 121, 80)) v(contig_idx, contig_name, contig_start, contig_len)),
genome AS (SELECT range AS p, (range * range + range // 5) % 4 + 1 AS ref_code, substr('ATCG', CAST((range * range + range // 5) % 4 + 1 AS INTEGER), 1) AS ref_nt,
  CASE WHEN range <= 120 THEN 1 ELSE 2 END AS contig_idx, CASE WHEN range <= 120 THEN range ELSE range - 120 END AS contig_pos FROM range(1, 201)),
held AS (SELECT sample_id, p, {_COUNTS}, (sum(bq) * 2) // count(*) AS qual, count(*) FILTER (flag = 'R' AND t = 8) AS ins, count(*) FILTER (flag = 'A' AND t = 8) AS del
  FROM reads GROUP BY sample_id, p),
cmt AS (
  SELECT 1 AS group_id, s.sample_id, q.p, s.in_outgroup, {_ZEROED}
  FROM (SELECT DISTINCT p FROM held) q CROSS JOIN samples s LEFT JOIN held ON held.p = q.p AND held.sample_id = s.sample_id),
c0 AS (SELECT *, c1 + c2 + c3 + c4 AS fwd_cov, c5 + c6 + c7 + c8 AS rev_cov, c1 + c2 + c3 + c4 + c5 + c6 + c7 + c8 AS cov, {_BOTH} AS kb, {_FWD} AS kf, {_REV} AS kr FROM cmt),
cells AS (
  SELECT *, kb[1] // 8 AS counts_major, kb[2] // 8 AS counts_minor,
    CAST(CASE WHEN cov > 0 THEN kb[1] % 8 ELSE 0 END AS INTEGER) AS major_nt, CAST(CASE WHEN cov > 0 THEN kb[2] % 8 ELSE 0 END AS INTEGER) AS minor_nt,
    CASE WHEN cov > 0 THEN (kb[1] // 8)::DOUBLE / cov ELSE 0 END AS major_freq, CASE WHEN cov > 0 THEN (kb[2] // 8)::DOUBLE / cov END AS minor_freq,
    CAST(CASE WHEN fwd_cov > 0 THEN kf[1] % 8 ELSE 0 END AS INTEGER) AS major_nt_fwd, CAST(CASE WHEN rev_cov > 0 THEN kr[1] % 8 ELSE 0 END AS INTEGER) AS major_nt_rev,
    CAST(CASE WHEN kf[2] >= 8 THEN kf[2] % 8 ELSE 0 END AS INTEGER) AS minor_nt_fwd, CAST(CASE WHEN kr[2] >= 8 THEN kr[2] % 8 ELSE 0 END AS INTEGER) AS minor_nt_rev,
    greatest(kf[1] // 8, kr[1] // 8) AS counts_major_max, greatest(kf[2] // 8, kr[2] // 8) AS counts_minor_max
  FROM c0),
coverage AS (SELECT s.sample_id, g.p, g.contig_idx, g.contig_pos, coalesce(h.cov, 0) AS cov FROM samples s CROSS JOIN genome g
  LEFT JOIN (SELECT sample_id, p, count(*) AS cov FROM reads GROUP BY sample_id, p) h ON h.sample_id = s.sample_id AND h.p = g.p),
medians AS (SELECT sample_id, contig_idx, median(cov) AS median_cov FROM coverage GROUP BY sample_id, contig_idx),
chrom AS (SELECT sample_id, median_cov AS chrom_median FROM medians WHERE contig_idx = 1),
m1 AS (SELECT *, major_nt AS call_start, CASE WHEN qual < {QUAL} THEN 0 ELSE major_nt END AS call_qual FROM cells),
m2 AS (SELECT *, CASE WHEN fwd_cov < {STRAND} OR rev_cov < {STRAND} THEN 0 ELSE call_qual END AS call_cov FROM m1),
m3 AS (SELECT *, CASE WHEN major_freq < {MAF} THEN 0 ELSE call_cov END AS call_maf FROM m2),
m4 AS (SELECT m3.*, CASE WHEN cov > 0 AND (ins + del)::DOUBLE / cov > {INDEL} THEN 0 ELSE call_maf END AS call_indel, chrom_median FROM m3 JOIN chrom USING (sample_id)),
site AS (SELECT p, avg(CASE WHEN call_indel = 0 THEN 1.0::DOUBLE ELSE 0 END) AS frac_n, median(cov) AS median_cov,
    CASE WHEN bool_or(chrom_median = 0 AND cov = 0) THEN 0 WHEN bool_or(chrom_median = 0 AND cov > 0) THEN 'inf'::DOUBLE ELSE avg(cov / nullif(chrom_median, 0)) END AS mean_copy,
    CASE WHEN bool_or(chrom_median = 0 AND cov = 0) THEN 0 WHEN bool_or(chrom_median = 0 AND cov > 0) THEN 'inf'::DOUBLE ELSE max(cov / nullif(chrom_median, 0)) END AS max_copy
  FROM m4 GROUP BY p),
m5 AS (SELECT m4.*, frac_n, median_cov, mean_copy, max_copy, CASE WHEN frac_n > {FRAC} THEN 0 ELSE call_indel END AS call_mfas FROM m4 JOIN site USING (p)),
m6 AS (SELECT *, CASE WHEN median_cov < {MEDIAN} THEN 0 ELSE call_mfas END AS call_mmcp FROM m5),
masked AS (SELECT *, CASE WHEN mean_copy > {MEAN_COPY} OR max_copy > {MAX_COPY} THEN 0 ELSE call_mmcp END AS call_cpn FROM m6),
votes AS (SELECT p, call_maf AS code, count(*) AS n FROM masked WHERE in_outgroup AND call_maf > 0 GROUP BY ALL),
anc AS (SELECT q.p, CAST(coalesce(v.code, g.ref_code) AS INTEGER) AS anc FROM (SELECT DISTINCT p FROM cmt) q JOIN genome g ON g.p = q.p
  LEFT JOIN (SELECT p, code FROM votes QUALIFY row_number() OVER (PARTITION BY p ORDER BY n DESC, code) = 1) v ON v.p = q.p),
quality AS (SELECT q.p, x.mut_qual FROM (SELECT DISTINCT p FROM cmt) q LEFT JOIN (
    SELECT a.p, max(least(a.qual, b.qual)) AS mut_qual FROM masked a JOIN masked b ON a.p = b.p AND a.call_maf > 0 AND b.call_maf > 0 AND a.call_maf <> b.call_maf AND NOT a.in_outgroup AND NOT b.in_outgroup GROUP BY a.p) x ON x.p = q.p),
prelim AS (SELECT m.*, anc.anc, quality.mut_qual FROM masked m JOIN anc USING (p) JOIN quality USING (p) WHERE NOT in_outgroup AND call_maf > 0 AND call_maf <> anc AND mut_qual >= 1),
good AS (SELECT DISTINCT p FROM prelim),
freq AS (SELECT m.p, m.sample_id, CASE WHEN major_nt <> anc THEN major_freq ELSE 0 END + CASE WHEN minor_nt <> anc THEN coalesce(minor_freq, 0) ELSE 0 END AS f
  FROM masked m JOIN anc USING (p) JOIN good USING (p) WHERE NOT in_outgroup),
near AS (SELECT DISTINCT a.p AS a, b.p AS b FROM good c JOIN good a ON abs(a.p - c.p) < 30 JOIN good b ON abs(b.p - c.p) < 30 WHERE a.p < b.p),
pairs AS (SELECT a, b, covar_pop(x.f, y.f) / nullif(stddev_pop(x.f) * stddev_pop(y.f), 0) AS r FROM near JOIN freq x ON x.p = a JOIN freq y ON y.p = b AND y.sample_id = x.sample_id GROUP BY a, b),
recomb AS (SELECT DISTINCT p FROM (SELECT unnest([a, b]) AS p FROM pairs WHERE r > 0.75)),
fixed AS (SELECT * FROM prelim WHERE p NOT IN (SELECT p FROM recomb)),
alleles AS (SELECT p, count(*) FILTER (major_nt = 1) AS n1, count(*) FILTER (major_nt = 2) AS n2, count(*) FILTER (major_nt = 3) AS n3, count(*) FILTER (major_nt = 4) AS n4 FROM cells GROUP BY p),
ranks AS (SELECT *, CASE greatest(n1, n2, n3, n4) WHEN n1 THEN 1 WHEN n2 THEN 2 WHEN n3 THEN 3 ELSE 4 END AS modal,
    list_reverse_sort([n1 * 8 + 1, n2 * 8 + 2, n3 * 8 + 3, n4 * 8 + 4])[2] AS k2 FROM alleles),
ambiguity AS (SELECT c.p,
    count(*) FILTER (major_nt = modal AND major_freq > 0 AND major_freq < 0.95)::DOUBLE / count(*) FILTER (major_nt = modal) AS frac_ambiguous,
    coalesce(max(counts_major_max) FILTER (major_nt <> modal), 0) AS off,
    coalesce(max(counts_minor_max) FILTER (major_nt = modal AND minor_nt = CASE WHEN k2 >= 8 THEN k2 % 8 ELSE 0 END), 0) AS seen
  FROM cells c JOIN ranks ON ranks.p = c.p GROUP BY c.p),
genes AS (SELECT contig_idx, k + 1 AS gene_idx, printf('LT%d_%03d', contig_idx, k) AS locustag, CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS strand, k * 30 + 4 AS loc1, k * 30 + 24 AS loc2
  FROM contigs, (SELECT range AS k FROM range(10)) WHERE k * 30 + 24 <= contig_len),
gseq AS (SELECT genes.contig_idx, gene_idx, string_agg(ref_nt, '' ORDER BY contig_pos) AS fwd FROM genes JOIN genome ON genome.contig_idx = genes.contig_idx AND contig_pos BETWEEN loc1 AND loc2 GROUP BY ALL),
features AS (SELECT genes.*, CASE WHEN strand = 1 THEN fwd ELSE translate(reverse(fwd), 'ATCG', 'TAGC') END AS sequence FROM genes JOIN gseq USING (contig_idx, gene_idx)),
b4 AS (SELECT unnest(['T', 'C', 'A', 'G']) AS b, unnest([0, 1, 2, 3]) AS i),
codons AS (SELECT x.b || y.b || z.b AS codon, substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(x.i * 16 + y.i * 4 + z.i + 1 AS INTEGER), 1) AS aa FROM b4 x, b4 y, b4 z),
hits AS (SELECT g.p, g.contig_idx, g.contig_pos, f.gene_idx, f.locustag, f.strand, f.sequence, CASE WHEN strand = 1 THEN contig_pos - loc1 + 1 ELSE loc2 - contig_pos + 1 END AS nt_pos
  FROM genome g LEFT JOIN features f ON f.contig_idx = g.contig_idx AND contig_pos BETWEEN loc1 AND loc2),
places AS (SELECT *, (nt_pos - 1) // 3 + 1 AS aa_pos, nt_pos - (nt_pos - 1) // 3 * 3 AS codon_place, substr(sequence, CAST((nt_pos - 1) // 3 * 3 + 1 AS INTEGER), 3) AS codon FROM hits),
effects AS (SELECT pl.p, string_agg(c.aa, '' ORDER BY b.o) AS aas
  FROM places pl, (SELECT unnest(['A', 'T', 'C', 'G']) AS nt, unnest([1, 2, 3, 4]) AS o) b JOIN codons c ON c.codon =
    substr(pl.codon, 1, CAST(codon_place AS INTEGER) - 1) || CASE WHEN pl.strand = 1 THEN b.nt ELSE translate(b.nt, 'ATCG', 'TAGC') END || substr(pl.codon, CAST(codon_place AS INTEGER) + 1)
  WHERE gene_idx IS NOT NULL GROUP BY pl.p),
around AS (SELECT g.p,
    (SELECT max_by(f, f.loc1) FROM features f WHERE f.contig_idx = g.contig_idx AND f.loc1 <= g.contig_pos) AS l,
    (SELECT min_by(f, f.loc1) FROM features f WHERE f.contig_idx = g.contig_idx AND f.loc1 > g.contig_pos) AS n, contig_pos FROM genome g),
between_genes AS (SELECT p, l.locustag AS locustag1, n.locustag AS locustag2, CASE WHEN l.strand = -1 THEN l.loc2 - contig_pos ELSE contig_pos - l.loc2 END AS distance1,
    CASE WHEN n.strand = 1 THEN contig_pos - n.loc1 ELSE n.loc1 - contig_pos END AS distance2 FROM around),
seen AS (SELECT p, anc, list(call_maf ORDER BY sample_id) AS calls, list(major_nt ORDER BY sample_id) AS majors FROM fixed GROUP BY p, anc),
letters AS (SELECT s.p, s.anc, e.aas, list_concat([s.anc], s.majors) AS codes, list_concat([s.anc], s.calls) AS called FROM seen s LEFT JOIN effects e USING (p)),
uniq AS (SELECT p, anc, aas,
    array_to_string(list_transform(list_sort(list_transform(list_distinct(list_transform(codes, lambda c: aas[c])), lambda a: [list_position(list_transform(codes, lambda c: aas[c]), a)::VARCHAR.lpad(4, '0'), a])), lambda x: x[2]), '') AS aa_gt,
    array_to_string(list_transform(list_sort(list_transform(list_distinct(called), lambda c: [list_position(called, c), c])), lambda x: 'ATCG'[x[2]]), '') AS nts FROM letters),
annotated AS (SELECT pl.p, pl.contig_idx, pl.contig_pos, pl.gene_idx, pl.locustag, pl.nt_pos, pl.aa_pos, u.aas, CASE WHEN u.aas IS NULL THEN '' ELSE u.aa_gt END AS aa_gt, 'ATCG'[u.anc] AS anc_nt, u.nts,
    CASE WHEN pl.gene_idx IS NOT NULL AND u.aas IS NULL THEN 'U' WHEN pl.gene_idx IS NOT NULL AND length(u.aa_gt) > 1 THEN 'N' WHEN pl.gene_idx IS NOT NULL THEN 'S'
      WHEN (distance1 > -5 AND distance1 < 0) OR (distance2 > -5 AND distance2 < 0) THEN 'P' ELSE 'I' END AS mutation_type
  FROM places pl JOIN uniq u USING (p) JOIN between_genes USING (p)),
muts AS (SELECT p, anc_nt, mutation_type, length(nts) - 1 AS n_new, unnest(string_split(substr(nts, 2), '')) AS new_nt FROM annotated WHERE length(nts) > 1)
"""

#: The six classes of substitutions, as SQL over anc_nt and new_nt.
CLASS = "CASE " + " ".join(f"WHEN anc_nt || new_nt IN ('{c[:2]}', '{c[3:]}') THEN '{c}'" for c in ("AT/TA", "AC/TG", "AG/TC", "GC/CG", "GT/CA", "GA/CT")) + " END"


#: The steps from the ancestor on again, over the calls after all masks.
_HEAD, _TAIL = BASE.split("votes AS", 1)
CALLED = _HEAD + "votes AS" + _TAIL.replace("call_maf", "call_cpn")

_N8 = ", ".join(f"sum(fwd) FILTER (slot = {i}) AS f{i}, sum(rev) FILTER (slot = {i}) AS r{i}" for i in (1, 2, 3, 4))


def _modal(call: str) -> str:
    return "greatest(" + ", ".join(f"count(*) FILTER ({call} = {i})" for i in (1, 2, 3, 4)) + ")"


def _second(call: str) -> str:
    ranked = "list_reverse_sort([" + ", ".join(f"count(*) FILTER ({call} = {i}) * 8 + {i}" for i in (1, 2, 3, 4)) + "])"
    return f"CASE WHEN ({ranked})[2] >= 8 THEN ({ranked})[2] % 8 END"


#: What the scorer is given, and the positions flagged as gaps.  The tests of the
#: gap filter are left out: where no position's depths are like a gap's, as in
#: these tables, they decide nothing.
SCORABLE = f"""
, ci AS (SELECT c.*, chrom_median FROM cells c JOIN chrom USING (sample_id) WHERE NOT in_outgroup),
poly AS (SELECT p FROM ci WHERE major_nt > 0 GROUP BY p HAVING count(DISTINCT major_nt) >= 2),
ce AS (SELECT ci.* FROM ci JOIN poly USING (p)),
slots AS (SELECT p, unnest([1, 2, 3, 4]) AS slot, unnest(list_transform(list_reverse_sort([n1 * 8 + 6, n2 * 8 + 5, n3 * 8 + 4, n4 * 8 + 3]), lambda k: 7 - k % 8)) AS base FROM (
  SELECT p, count(*) FILTER (major_nt = 1) AS n1, count(*) FILTER (major_nt = 2) AS n2, count(*) FILTER (major_nt = 3) AS n3, count(*) FILTER (major_nt = 4) AS n4 FROM ce GROUP BY p)),
cube AS (SELECT ce.p, sample_id, slot, CASE base WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 ELSE c4 END AS fwd, CASE base WHEN 1 THEN c5 WHEN 2 THEN c6 WHEN 3 THEN c7 ELSE c8 END AS rev FROM ce JOIN slots USING (p)),
lost AS (SELECT sample_id FROM (SELECT p, sample_id, sum(fwd + rev) AS n FROM cube GROUP BY ALL) GROUP BY sample_id HAVING avg(CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE 0 END) * 100 >= 45),
cell8 AS (SELECT p, sample_id, {_N8} FROM cube WHERE sample_id NOT IN (SELECT sample_id FROM lost) GROUP BY p, sample_id),
told AS (SELECT *, f1 + f2 + f3 + f4 > 0 AS fc, r1 + r2 + r3 + r4 > 0 AS rc,
  (f1 > 0)::INT + (f2 > 0)::INT + (f3 > 0)::INT + (f4 > 0)::INT = 1 AND (r1 > 0)::INT + (r2 > 0)::INT + (r3 > 0)::INT + (r4 > 0)::INT = 1 AS clean,
  list_position([f1, f2, f3, f4], greatest(f1, f2, f3, f4)) <> list_position([r1, r2, r3, r4], greatest(r1, r2, r3, r4)) AS differ FROM cell8),
scored AS (SELECT p FROM told GROUP BY p HAVING NOT (
  ((SELECT count(*) FROM lost) > 0 AND (sum(f2 + r2) = 0 OR bool_and((f1 <> 0 OR NOT fc) AND f2 <= f1 AND (r1 <> 0 OR NOT rc) AND r2 <= r1)))
  OR (count(*) FILTER (clean AND (f2 > 0 OR r2 > 0) AND differ) > 0 AND count(*) FILTER (clean AND f2 > 0 AND r2 > 0) < 2))),
h1 AS (SELECT *, CASE WHEN fwd_cov < 1 OR rev_cov < 1 THEN 0 ELSE major_nt END AS two FROM ce WHERE p IN (SELECT p FROM scored)),
h2 AS (SELECT *, CASE WHEN fwd_cov < 11 AND rev_cov < 11 THEN 0 ELSE two END AS deep FROM h1),
adapt AS (SELECT count(*) FILTER (d::DOUBLE / nullif(b, 0) > 0.5) > 10 OR count(*) FILTER (d::DOUBLE / nullif(b, 0) > 0.5) >= 0.1 * count(*) AS is_on FROM (SELECT p, {_modal("two")} AS b, {_modal("deep")} AS d FROM h2 GROUP BY p)),
heldmode AS (SELECT p, CASE {_modal("major_nt")} WHEN count(*) FILTER (major_nt = 1) THEN 1 WHEN count(*) FILTER (major_nt = 2) THEN 2 WHEN count(*) FILTER (major_nt = 3) THEN 3 ELSE 4 END AS modal FROM h2 GROUP BY p),
vague AS (SELECT p FROM h2 JOIN heldmode USING (p) WHERE major_nt = modal AND major_freq > 0 AND major_freq < 0.95 GROUP BY p),
h3 AS (SELECT h2.*, CASE WHEN is_on AND p IN (SELECT p FROM vague) AND fwd_cov < 3 AND rev_cov < 3 THEN 0 ELSE two END AS adaptive FROM h2, adapt),
middle AS (SELECT median(chrom_median) AS depth, (SELECT count(DISTINCT sample_id) FROM cell8 WHERE p IN (SELECT p FROM scored)) AS n FROM (SELECT DISTINCT sample_id, chrom_median FROM ce)),
h4 AS (SELECT h3.*, CASE WHEN fwd_cov < 1 OR rev_cov < 1 OR (major_nt_fwd <> major_nt_rev AND major_nt_fwd > 0 AND major_nt_rev > 0) OR major_freq < 0.7
    OR (depth > 9 AND ((fwd_cov = 1 AND rev_cov < 4) OR (fwd_cov < 4 AND rev_cov = 1))) OR (depth > 20 AND n > 50 AND (fwd_cov < 4 OR rev_cov < 4)) THEN 0 ELSE adaptive END AS deep_call FROM h3, middle),
before AS (SELECT p FROM h4 WHERE deep_call > 0 GROUP BY p HAVING count(DISTINCT deep_call) >= 2),
h5 AS (SELECT h4.*, minor FROM h4 JOIN (SELECT p, {_second("deep_call")} AS minor FROM h4 GROUP BY p) USING (p) WHERE p IN (SELECT p FROM before)),
h6 AS (SELECT h5.*, n_minor > 1 AND (coalesce(deep_call = minor, false) OR counts_major < coalesce(least_, 0)) AS minor_max FROM h5 JOIN (
    SELECT p, count(*) FILTER (deep_call = minor) AS n_minor, min(counts_major) FILTER (deep_call = minor AND counts_major > 0) AS least_ FROM h5 GROUP BY p) USING (p)),
h7 AS (SELECT *, CASE WHEN minor_max AND counts_minor > 30 AND counts_major > 3 * counts_minor AND counts_major > 250 THEN 0 ELSE deep_call END AS clean_call FROM h6),
thin AS (SELECT p FROM h7 JOIN (SELECT p, {_modal("clean_call")} AS top, {_second("clean_call")} AS other FROM h7 GROUP BY p) USING (p) WHERE clean_call = other GROUP BY p HAVING max(counts_major / chrom_median) < 0.1),
after AS (SELECT p FROM h7 WHERE clean_call > 0 GROUP BY p HAVING count(DISTINCT clean_call) >= 2 AND p NOT IN (SELECT p FROM thin))
"""


def sql_called(select: str) -> str:
    return CALLED + SCORABLE + select


def sql(select: str) -> str:
    return BASE + select
