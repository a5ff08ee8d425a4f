"""Text sources: sample sheets, FASTA, GFF3, VCF, pileups, aligner logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basewise.functions.windows import running_sum

SHEET = "Path string, Sample string, FileName string, Reference string, Group string, Outgroup string, Type string"
LEGACY_SHEET = "Batch string, Sample string, Alignments string, ProviderName string, Patient string"
#: The file-name endings of paired and single reads.
PAIRED = ((r"_1\.fastq\.gz$", r"_2\.fastq\.gz$"), (r"_R1_001\.fastq\.gz$", r"_R2_001\.fastq\.gz$"), (r"_1\.fastq$", r"_2\.fastq$"), (r"_1\.fq\.gz$", r"_2\.fq\.gz$"))


def read_samples(spark: SparkSession, path: str, schema: str = SHEET) -> DataFrame:
    """The sheet, fields trimmed; the first line is a header whatever it says."""
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=True)
    df = df.select(*(F.trim(c).alias(c) for c in df.columns))
    return df.withColumn("Outgroup", F.col("Outgroup") == "1") if "Outgroup" in df.columns else df


def write_by_sample(sheet: DataFrame, path: str) -> None:
    """One folder a sample, rewritten as a whole."""
    sheet.write.mode("overwrite").partitionBy("Sample").csv(path, header=True)


def mixed_types(sheet: DataFrame) -> DataFrame:
    """Groups with both paired and single reads."""
    return sheet.groupBy("Group").agg(F.countDistinct("Type").alias("n_types")).where("n_types > 1")


def find_reads(names: list[str], sample: str) -> list[str]:
    """The file or pair of files of a sample among names.

    A pair is looked for first, then a single file; none or several is an error.
    """
    own = [n for n in names if re.match(rf"(?:.*/)?{re.escape(sample)}(?![A-Za-z0-9])", n)]
    for first, second in PAIRED:
        a, b = ([n for n in own if re.search(p, n)] for p in (first, second))
        if len(a) == len(b) == 1:
            return [a[0], b[0]]
        if len(a) > 1 or len(b) > 1:
            raise ValueError(f"several pairs of files for {sample}")
    single = [n for n in own if re.search(r"\.(fastq|fq)(\.gz)?$", n)]
    if len(single) != 1:
        raise ValueError(f"{len(single)} files for {sample}")
    return single


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """contig_idx, contig_name, contig_start, contig_len, seq: in file order.

    A record is split on its header mark; gz is read as such.  One genome's
    contigs are a few thousand rows.
    """
    df = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"(?:^|\n)>")).alias("contig_idx", "record")).where("record <> ''")
    head = F.substring_index("record", "\n", 1)
    body = F.expr("substring(record, length(substring_index(record, '\\n', 1)) + 1)")
    df = df.select("contig_idx", F.regexp_extract(head, r"^(\S+)", 1).alias("contig_name"), F.upper(F.regexp_replace(body, r"\s", "")).alias("seq"))
    df = df.withColumn("contig_len", F.length("seq").cast("long"))
    w = Window.orderBy("contig_idx").rowsBetween(Window.unboundedPreceding, -1)
    return df.select(F.row_number().over(Window.orderBy("contig_idx")).alias("contig_idx"), "contig_name", (F.coalesce(F.sum("contig_len").over(w), F.lit(0)) + 1).alias("contig_start"), "contig_len", "seq")


def parse_gff(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    """(value) of GFF3 text -> features in order of loc1 within a contig.

    gene and region rows go; missing attributes are "."; coding sequences are
    cut from the contig, on the reverse strand complemented, and translated;
    tagnumber counts them, 0 for others.
    """
    from basewise.functions.bases import reverse_complement, translate_cds

    parts = F.split("value", "\t")
    df = lines.where(~F.col("value").startswith("#") & (F.size(parts) >= 9)).select(
        F.get(parts, F.lit(0)).alias("contig_name"),
        F.get(parts, F.lit(2)).alias("type"),
        F.get(parts, F.lit(3)).cast("long").alias("loc1"),
        F.get(parts, F.lit(4)).cast("long").alias("loc2"),
        F.when(F.get(parts, F.lit(6)) == "+", 1).when(F.get(parts, F.lit(6)) == "-", -1).alias("strand"),
        F.str_to_map(F.get(parts, F.lit(8)), F.lit(";"), F.lit("=")).alias("a"),
    )
    df = df.where(~F.col("type").isin("gene", "region"))
    of = lambda name: F.coalesce(F.try_element_at("a", F.lit(name)), F.lit("."))
    df = df.join(F.broadcast(contigs.select("contig_idx", "contig_name", "contig_start", "seq")), "contig_name")
    cut = F.expr("substring(seq, cast(loc1 as int), cast(loc2 - loc1 + 1 as int))")
    coding = F.col("type") == "CDS"
    df = df.select(
        "contig_idx", "contig_start", "type", F.coalesce(F.try_element_at("a", F.lit("locus_tag")), of("ID")).alias("locustag"), of("gene").alias("gene"), of("product").alias("product"),
        F.split(of("protein_id"), ",").alias("protein_id"), F.split(of("Ontology_term"), ",").alias("ontology"), of("Note").alias("note"), "strand", "loc1", "loc2",
        F.when(F.col("strand") == -1, reverse_complement(cut)).otherwise(cut).alias("sequence"),
    )
    df = df.withColumn("translation", F.when(coding, translate_cds(F.col("sequence"))).otherwise("."))
    order = Window.partitionBy("contig_idx").orderBy("loc1", "loc2")
    df = df.withColumn("gene_idx", F.row_number().over(order))
    whole = Window.orderBy("contig_idx", "loc1", "loc2").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("tagnumber", F.when(coding, F.sum(coding.cast("int")).over(whole)).otherwise(0)).drop("contig_start")


def read_gff(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    return parse_gff(spark.read.text(path), contigs)


def read_by_sample(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """(sample_id, value): the lines of one text file a sample, gz or plain."""
    df = None
    for sample, path in sorted(paths.items()):
        one = spark.read.text(path).select(F.lit(sample).alias("sample_id"), "value")
        df = one if df is None else df.unionByName(one)
    return df


def parse_aligner_log(lines: DataFrame) -> DataFrame:
    """(sample_id, value) -> reads aligned once and overall, "-1" where absent."""
    once = F.max(F.when(F.col("value").contains("exactly 1 time"), F.regexp_extract("value", r"\(([\d.]+)%\)", 1)))
    overall = F.max(F.when(F.col("value").contains("overall"), F.regexp_extract("value", r"([\d.]+)%", 1)))
    return lines.groupBy("sample_id").agg(F.coalesce(once, F.lit("-1")).alias("aligned_once"), F.coalesce(overall, F.lit("-1")).alias("aligned_overall"))


def alignment_quality(sheet: DataFrame, log: DataFrame, reference: str) -> DataFrame:
    """The sheet's rows of a reference with their aligner statistics."""
    used = sheet.where(F.col("Reference").contains(reference))
    got = log.withColumnRenamed("sample_id", "Sample")
    return used.join(got, "Sample", "left").fillna("-1", subset=["aligned_once", "aligned_overall"])


def parse_clusters(lines: DataFrame) -> DataFrame:
    """(line, value) of a cluster file -> cluster, gene, subject tag.

    Rows that begin with > head a cluster; members carry their id after >.
    """
    # A member's cluster is how many heads stand before it, less one.
    heads = F.col("value").startswith(">").cast("int")
    df = running_sum(lines, heads, "line", F.floor(F.col("line") / 100_000), "heads").where(~F.col("value").startswith(">"))
    df = df.withColumn("cluster", F.col("heads") - 1)
    gene = F.regexp_extract("value", r">(.+?)\.\.\.", 1)
    return df.select("cluster", gene.alias("gene"), F.regexp_extract(gene, r"^([^_]+)", 1).alias("tag"))


def ortholog_table(clusters: DataFrame, tags: list[str]) -> DataFrame:
    """cluster x tag: the genes joined by commas, NA where there is none."""
    joined = F.array_join(F.sort_array(F.collect_list("gene")), ",")
    return clusters.groupBy("cluster").pivot("tag", tags).agg(joined).replace("", "NA", subset=tags).fillna("NA")


def positions(spark: SparkSession, path: str) -> DataFrame:
    """A position a line."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.trim("value").cast("long").alias("p"))


def only_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def names(spark: SparkSession, path: str) -> DataFrame:
    """A name a line, trimmed; blank lines are skipped."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.trim("value").alias("name"))


def subject_tags(lines: DataFrame) -> DataFrame:
    """(subject, line, value) of annotation FASTAs -> subject, tag: the part of
    the first record's name before an underscore.  A file that doesn't begin
    with a record is an error."""
    first = lines.groupBy("subject").agg(F.min_by("value", "line").alias("value"))
    tag = F.regexp_extract("value", r"^>([^\s_]+)", 1)
    wrong = F.raise_error(F.concat(F.lit("not a FASTA record: "), F.col("value")))
    return first.select("subject", F.when(F.col("value").startswith(">"), tag).otherwise(wrong).alias("tag"))


def extended_name(subject: Column, visit: Column, location: Column, name: Column) -> Column:
    """A sample's name led by its subject, visit and location."""
    return F.concat(F.lit("S"), subject, F.lit("_V"), visit.cast("string"), F.lit("_"), location, F.lit("_"), name)
