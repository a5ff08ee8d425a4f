"""Annotation of positions: genes, codons, distances, mutation types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.functions.bases import complement, int_to_nt, ordered_letters, translate_codon
from basewise.operators.coverage import with_contig
from basewise.operators.masks import SITE

BUCKET = 1000
GENE = ["gene_idx", "locustag", "gene", "strand", "loc1", "loc2", "sequence", "translation"]


def gene_hits(positions: DataFrame, contigs: DataFrame, features: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """positions with the gene that covers them, null between genes.

    A range join by buckets of the contig; of overlapping genes the one that
    starts last wins.
    """
    at = with_contig(positions, contigs).withColumn("__b", F.floor(F.col("contig_pos") / bucket))
    covered = F.explode(F.sequence(F.floor(F.col("loc1") / bucket), F.floor(F.col("loc2") / bucket)))
    genes = features.select("contig_idx", covered.alias("__b"), *GENE)
    hit = at.select("p", "contig_idx", "contig_pos", "__b").distinct().join(genes, ["contig_idx", "__b"])
    hit = hit.where((F.col("contig_pos") >= F.col("loc1")) & (F.col("contig_pos") <= F.col("loc2")))
    w = Window.partitionBy("p").orderBy(F.desc("loc1"), F.desc("gene_idx"))
    best = hit.withColumn("__n", F.row_number().over(w)).where("__n = 1").select("p", *GENE)
    return at.drop("__b").join(best, "p", "left")


def gene_neighbours(positions: DataFrame, contigs: DataFrame, features: DataFrame, bucket: int = 10_000) -> DataFrame:
    """positions with the genes before and after: an as-of join.

    distance1 is the way from the end of the gene before, negative if that gene
    is on the reverse strand; distance2 the way to the start of the gene after,
    negative if that is on the forward strand.  Genes, one genome's, are put in
    order once; each span between two starts is dealt to the buckets it meets,
    and positions find theirs by an equi-join.  Of genes that start together the
    longest is the one before, the shortest the one after.
    """
    gene, order = F.struct("locustag", "gene", "strand", "loc1", "loc2"), F.struct("loc2", "locustag")
    starts = features.groupBy("contig_idx", "loc1").agg(F.max_by(gene, order).alias("last"), F.min_by(gene, order).alias("first"))
    w = Window.partitionBy("contig_idx").orderBy("loc1")
    spans = starts.select("contig_idx", F.col("loc1").alias("from"), F.lead("loc1").over(w).alias("to"), F.col("last").alias("before"), F.lead("first").over(w).alias("after"))
    ahead = starts.groupBy("contig_idx").agg(F.min("loc1").alias("to"), F.min_by("first", "loc1").alias("after"))
    none = F.lit(None).cast("struct<locustag:string,gene:string,strand:int,loc1:bigint,loc2:bigint>")
    spans = spans.unionByName(ahead.select("contig_idx", F.lit(0).cast("long").alias("from"), "to", none.alias("before"), "after"))
    spans = spans.join(F.broadcast(contigs.select("contig_idx", "contig_len")), "contig_idx").withColumn("to", F.coalesce("to", F.greatest(F.col("contig_len"), F.col("from")) + 1))
    spans = spans.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("from") / bucket), F.floor((F.col("to") - 1) / bucket)))).withColumnRenamed("contig_idx", "on")
    at = with_contig(positions, contigs).select("p", "contig_idx", F.col("contig_pos").alias("x"), F.floor(F.col("contig_pos") / bucket).alias("at")).distinct()
    met = (F.col("contig_idx") == F.col("on")) & (F.col("at") == F.col("bucket")) & (F.col("x") >= F.col("from")) & (F.col("x") < F.col("to"))
    found = at.join(spans, met, "left")
    d1, d2 = F.col("x") - F.col("before.loc2"), F.col("after.loc1") - F.col("x")
    return found.select(
        "p",
        F.col("before.locustag").alias("locustag1"),
        F.col("after.locustag").alias("locustag2"),
        F.when(F.col("before.strand") == -1, -d1).otherwise(d1).alias("distance1"),
        F.when(F.col("after.strand") == 1, -d2).otherwise(d2).alias("distance2"),
    )


def codon_effects(hits: DataFrame) -> DataFrame:
    """hits with nt_pos, aa_pos, codon place and the amino acids of A, T, C, G."""
    nt_pos = F.when(F.col("strand") == 1, F.col("contig_pos") - F.col("loc1") + 1).when(F.col("strand") == -1, F.col("loc2") - F.col("contig_pos") + 1)
    df = hits.withColumn("nt_pos", nt_pos).withColumn("aa_pos", F.floor((F.col("nt_pos") - 1) / 3) + 1)
    df = df.withColumn("codon_place", F.col("nt_pos") - (F.col("aa_pos") - 1) * 3)
    codon = F.when(F.length("sequence") >= F.col("aa_pos") * 3, F.substring("sequence", (F.col("aa_pos") * 3 - 2).cast("int"), F.lit(3)))
    df = df.withColumn("codon", codon)

    def changed(nt: str) -> Column:
        new = F.when(F.col("strand") == 1, F.lit(nt)).otherwise(complement(F.lit(nt)))
        return translate_codon(F.overlay("codon", new, F.col("codon_place").cast("int"), F.lit(1)))

    told = F.concat(*(changed(nt) for nt in "ATCG"))
    return df.withColumn("aas", F.when(F.col("codon").isNotNull() & (F.coalesce("translation", F.lit(".")) != "."), told))


def annotate(positions: DataFrame, contigs: DataFrame, features: DataFrame, anc: DataFrame, fixed: DataFrame, promoter: int = 250, call: str = "call") -> DataFrame:
    """One row a position: gene, codon effect, distances, mutation type.

    fixed has the fixed-mutation cells with their call and major_nt.  type: U
    without a codon, N if the ancestor's amino acid and those of the fixed
    mutations differ, else S; between genes P within promoter bases upstream of
    a gene, else I.
    """
    hits = codon_effects(gene_hits(positions.select(*SITE).distinct(), contigs, features)).join(anc, SITE, "left")
    told = fixed.groupBy(*SITE).agg(F.array_sort(F.collect_list(F.struct("sample_id", F.col(call).alias("call"), F.col("major_nt").alias("nt")))).alias("f"))
    df = hits.join(told, SITE, "left")
    of = lambda code: F.substring("aas", code.cast("int"), F.lit(1))
    empty = F.array().cast("array<struct<sample_id:int,call:int,nt:int>>")
    seen = F.transform(F.coalesce("f", empty), lambda x: of(x["nt"]))
    letters = F.array_join(F.concat(F.when(F.col("anc") > 0, F.array(of(F.col("anc")))).otherwise(F.array().cast("array<string>")), seen), "")
    df = df.withColumn("aa_gt", F.when(F.col("aas").isNotNull(), ordered_letters(letters)).otherwise(F.lit("")))
    nts = F.array_join(F.concat(F.array(int_to_nt(F.col("anc"))), F.transform(F.coalesce("f", empty), lambda x: int_to_nt(x["call"]))), "")
    df = df.withColumns({"anc_nt": F.when(F.col("anc") > 0, int_to_nt(F.col("anc"))).otherwise("."), "nts": F.when(F.col("anc") > 0, ordered_letters(nts)).otherwise(".")})
    muts = F.transform(F.sequence(F.lit(2), F.length("aa_gt")), lambda i: F.concat(F.substring("aa_gt", 1, 1), F.col("aa_pos").cast("string"), F.substring(F.col("aa_gt"), i, F.lit(1))))
    df = df.withColumn("muts", F.when(F.length("aa_gt") > 1, F.array_join(muts, ",")).otherwise("."))
    between = gene_neighbours(positions.select(*SITE).distinct(), contigs, features)
    df = df.join(between, "p", "left")
    near = lambda d: (F.col(d) > -promoter) & (F.col(d) < 0)
    inside = F.col("gene_idx").isNotNull()
    kind = (
        F.when(inside & F.col("aas").isNull(), "U")
        .when(inside & (F.length("aa_gt") > 1), "N")
        .when(inside, "S")
        .when(F.coalesce(near("distance1"), F.lit(False)) | F.coalesce(near("distance2"), F.lit(False)), "P")
        .otherwise("I")
    )
    tag = F.regexp_replace("locustag", "gene", "pseudogene")
    out = {"mutation_type": kind, "locustag": tag}
    out |= {c: F.when(~inside, F.col(c)) for c in ("locustag1", "locustag2", "distance1", "distance2")}
    return df.withColumns(out).drop("f")

