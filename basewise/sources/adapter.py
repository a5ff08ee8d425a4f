"""The driver's lineitem table read as sequencing reads.

Each row is one sequenced base; integer arithmetic only, so that any engine
agrees.  FIXTURES.md has the definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GENOME, FIRST_CONTIG, SAMPLES, OUTGROUP = 200, 120, 12, 11


def ref_code(p: Column) -> Column:
    return ((p * p + F.floor(p / 5)) % 4 + 1).cast("int")


def alt_code(p: Column) -> Column:
    return (((p * p + F.floor(p / 5)) + 1 + p % 2) % 4 + 1).cast("int")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, p, strand, nt, bq, is_ins, is_del: a row a read."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    p = F.col("l_partkey") % GENOME + 1
    df = line.select(
        F.lit(1).alias("group_id"),
        (F.col("l_suppkey") % SAMPLES).cast("int").alias("sample_id"),
        p.alias("p"),
        (F.col("l_linenumber") % 2).cast("int").alias("strand"),
        F.round(F.col("l_discount") * 100).cast("int").alias("d"),
        F.round(F.col("l_tax") * 100).cast("int").alias("t"),
        F.round("l_quantity").cast("long").alias("bq"),
        (F.col("l_orderkey") % 4 + 1).cast("int").alias("err"),
        "l_returnflag",
        F.col("l_orderkey").alias("read_id"),
        F.col("l_linenumber").alias("line"),
    )
    changed = (F.col("p") % 3 != 0) & ((F.col("sample_id") * 7 + F.col("p") * 3) % 11 == 0)
    nt = F.when(F.col("d") >= 10, F.col("err")).when(changed, alt_code(F.col("p"))).otherwise(ref_code(F.col("p")))
    ins, dele = (((F.col("l_returnflag") == flag) & (F.col("t") == 8)) for flag in "RA")
    return df.select("group_id", "sample_id", "p", "strand", nt.alias("nt"), "bq", ins.alias("is_ins"), dele.alias("is_del"), "read_id", "line")


def cells(reads_: DataFrame) -> DataFrame:
    """Reads counted: c1..c8, qual, ins and del by sample and position."""
    counts = [F.count_if((F.col("strand") == s) & (F.col("nt") == n)).alias(f"c{4 * s + n}") for s in (0, 1) for n in (1, 2, 3, 4)]
    qual = F.expr("(sum(bq) * 2) div count(1)").alias("qual")
    return reads_.groupBy("group_id", "sample_id", "p").agg(*counts, qual, F.count_if("is_ins").alias("ins"), F.count_if("is_del").alias("del"))


def samples(spark: SparkSession) -> DataFrame:
    rows = [(1, i, f"sample_{i:02d}", i == OUTGROUP, "PE" if i % 2 else "SE") for i in range(SAMPLES)]
    return spark.createDataFrame(rows, "group_id int, sample_id int, sample_name string, in_outgroup boolean, seq_type string")


def contigs(spark: SparkSession) -> DataFrame:
    """Two contigs with their sequences."""
    seq = F.expr(f"transform(sequence(1, {GENOME}), p -> substring('ATCG', (p * p + p div 5) % 4 + 1, 1))")
    rows = spark.createDataFrame([(1, "contig_1", 1, FIRST_CONTIG), (2, "contig_2", FIRST_CONTIG + 1, GENOME - FIRST_CONTIG)], "contig_idx int, contig_name string, contig_start long, contig_len long")
    return rows.withColumn("seq", F.array_join(F.slice(seq, F.col("contig_start").cast("int"), F.col("contig_len").cast("int")), ""))


def features(spark: SparkSession) -> DataFrame:
    """Genes of 21 bases every 30, on alternating strands."""
    from basewise.functions.bases import reverse_complement, translate_cds

    df = contigs(spark).select("contig_idx", "contig_len", "seq", F.explode(F.sequence(F.lit(0), F.floor((F.col("contig_len") - 24) / 30).cast("int"))).alias("k"))
    cut = F.substring("seq", F.col("k") * 30 + 4, F.lit(21))
    df = df.select(
        "contig_idx",
        (F.col("k") + 1).alias("gene_idx"),
        F.lit("CDS").alias("type"),
        F.format_string("LT%d_%03d", "contig_idx", "k").alias("locustag"),
        F.concat(F.lit("gen"), F.col("k").cast("string")).alias("gene"),
        F.when(F.col("k") % 2 == 0, 1).otherwise(-1).alias("strand"),
        (F.col("k") * 30 + 4).cast("long").alias("loc1"),
        (F.col("k") * 30 + 24).cast("long").alias("loc2"),
        F.when(F.col("k") % 2 == 0, cut).otherwise(reverse_complement(cut)).alias("sequence"),
    )
    return df.withColumn("translation", translate_cds(F.col("sequence")))


def cmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate mutation table: dense over positions and samples."""
    from basewise.operators.candidates import dense

    held = cells(reads(spark, sf_dir))
    return dense(held, held.select("group_id", "p").distinct(), samples(spark))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense over the whole genome."""
    grid = samples(spark).select("group_id", "sample_id", F.explode(F.sequence(F.lit(1), F.lit(GENOME)).cast("array<bigint>")).alias("p"))
    held = reads(spark, sf_dir).groupBy("group_id", "sample_id", "p").agg(F.count(F.lit(1)).alias("cov"))
    return grid.join(held, ["group_id", "sample_id", "p"], "left").withColumn("cov", F.coalesce("cov", F.lit(0).cast("long")))
