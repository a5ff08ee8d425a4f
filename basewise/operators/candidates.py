"""From reads to the candidate mutation table: pileups, VCF rows, positions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.functions.bases import nt_to_int
from basewise.functions.cells import COUNTS
from basewise.operators.coverage import to_global

#: Bases to each side of an indel that it is counted for.
INDEL_REGION = 3
#: The ASCII offsets of base and mapping quality.
BASE_OFFSET, MAP_OFFSET = 33, 33
SYMBOLS = {c: i for i, c in enumerate("ATCGatcg", 1)}
CALL = re.compile(r"\^(.)|\$|([+-])(\d+)|(.)", re.S)

READ_SCHEMA = "sample_id int, chrom string, pos long, symbols array<int>, bq array<int>, mq array<int>, td array<int>, ins array<int>, dels array<int>"


def parse_calls(calls: str, ref: str) -> tuple[list[int], list[int], list[int]]:
    """A pileup's call string, read in order: the symbol (1..8, else 0) of each
    read, the lengths of the insertions and those of the deletions.

    A read's start mark takes the next character with it, whatever that is; an
    indel's bases are passed over.  Calls of "the reference" where that isn't
    A, T, C or G are an error.
    """
    code = SYMBOLS.get(ref.upper(), 0)
    symbols, ins, dels, at = [], [], [], 0
    while (m := CALL.match(calls, at)) is not None:
        at = m.end()
        if m[2]:
            (ins if m[2] == "+" else dels).append(int(m[3]))
            at += int(m[3])
        elif m[4]:
            if m[4] in ".,":
                if not code:
                    raise ValueError(f"calls match an ambiguous reference {ref!r}")
                symbols.append(code + 4 * (m[4] == ","))
            else:
                symbols.append(SYMBOLS.get(m[4], 0))
    return symbols, ins, dels


def parse_pileup(lines: DataFrame) -> DataFrame:
    """(sample_id, value) of eight tab-separated fields -> a row a line."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        kinds = [pa.int32(), pa.string(), pa.int64(), *[pa.list_(pa.int32())] * 6]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for sample, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                chrom, pos, ref, _, calls, bq, mq, td = (line or "").rstrip("\n").split("\t")[:8]
                symbols, ins, dels = parse_calls(calls, ref)
                row = (sample, chrom, int(pos), symbols, [ord(c) - BASE_OFFSET for c in bq], [ord(c) - MAP_OFFSET for c in mq], [int(x) for x in td.split(",") if x], ins, dels)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return lines.where("value is not null and value <> ''").select(F.col("sample_id").cast("int").alias("sample_id"), "value").mapInArrow(make, READ_SCHEMA)


def diversity(parsed: DataFrame, contigs: DataFrame, clamp: bool = True) -> DataFrame:
    """Counts and rounded mean qualities of each symbol, and indel counts.

    Means are rounded half to even.  An indel counts for the bases around it
    (a deletion for its length more), within its contig if clamp.
    """
    c = F.broadcast(contigs.select("contig_idx", "contig_name", "contig_start", "contig_len"))
    df = parsed.join(c, parsed.chrom == F.col("contig_name")).withColumn("p", F.col("contig_start") + F.col("pos") - 1)
    read = F.explode(F.arrays_zip("symbols", "bq", "mq", "td"))
    rows = df.select("sample_id", "p", read.alias("r")).select("sample_id", "p", F.col("r.symbols").alias("s"), F.col("r.bq").alias("b"), F.col("r.mq").alias("m"), F.col("r.td").alias("d"))
    stats = []
    for i in range(1, 9):
        this = F.col("s") == i
        stats.append(F.count_if(this).alias(f"c{i}"))
        stats += [F.coalesce(F.bround(F.avg(F.when(this, F.col(x)))), F.lit(0)).cast("long").alias(f"{x}q{i}") for x in "bmd"]
    # The mean is of base quality, mapping quality and distance from the tail.
    counted = rows.groupBy("sample_id", "p").agg(*stats)
    low, high = (F.col("contig_start"), F.col("contig_start") + F.col("contig_len") - 1) if clamp else (F.lit(1), F.lit(1 << 62))
    region = []
    for column, extra in (("ins", 0), ("dels", 1)):
        one = df.select("sample_id", "p", "contig_start", "contig_len", F.explode(column).alias("size"))
        end = F.col("p") + INDEL_REGION - 1 + (F.col("size") if extra else F.lit(0))
        span = F.sequence(F.greatest(F.col("p") - INDEL_REGION, low), F.least(end, high))
        region.append(one.select("sample_id", F.explode(span).alias("p"), F.lit(extra).alias("del")))
    indels = region[0].unionByName(region[1]).groupBy("sample_id", "p").agg(F.count_if(F.col("del") == 0).alias("ins"), F.count_if(F.col("del") == 1).alias("del"))
    zero = [c for c in counted.columns if c not in ("sample_id", "p")] + ["ins", "del"]
    return counted.join(indels, ["sample_id", "p"], "full").fillna(0, subset=zero)


def parse_vcf(lines: DataFrame) -> DataFrame:
    """(sample_id, value) of VCF text -> chrom, pos, ref, alt, fq of plain rows.

    Rows are plain where one reference base faces one alternative; fq is the
    value of the first INFO item that begins with FQ.
    """
    parts = F.split("value", "\t")
    df = lines.where(~F.col("value").startswith("#")).select("sample_id", *(F.get(parts, F.lit(i)).alias(n) for i, n in ((0, "chrom"), (1, "pos"), (3, "ref"), (4, "alt"), (7, "info"))))
    item = F.get(F.filter(F.split("info", ";"), lambda x: x.startswith("FQ")), F.lit(0))
    plain = (F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("alt") != ",") & (F.col("alt") != ".")
    return df.withColumn("fq", F.get(F.split(item, "="), F.lit(1)).try_cast("double")).where(plain).select("sample_id", "chrom", F.col("pos").cast("long").alias("pos"), "ref", "alt", "fq")


def _placed(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    named = F.broadcast(contigs.select("contig_idx", F.col("contig_name").alias("chrom")))
    return to_global(rows.join(named, "chrom").withColumnRenamed("pos", "contig_pos"), contigs)


def quals(variants: DataFrame, contigs: DataFrame) -> DataFrame:
    """The least FQ of each position, rounded half to even, at most 0."""
    return _placed(variants, contigs).groupBy("sample_id", "p").agg(F.least(F.bround(F.min("fq")), F.lit(0.0)).cast("long").alias("fq"))


def variable_positions(variants: DataFrame, contigs: DataFrame, max_fq: float = -30) -> DataFrame:
    """Positions of each sample with a sure variant: FQ under max_fq."""
    return _placed(variants.where(F.col("fq") < max_fq), contigs).select("sample_id", "p").distinct()


def variant_counts(positions: DataFrame) -> DataFrame:
    return positions.groupBy("group_id", "p").agg(F.countDistinct("sample_id").alias("n_samples"))


def candidate_positions(positions: DataFrame, samples: DataFrame, legacy_outgroup: bool = False) -> DataFrame:
    """Positions that vary in a sample of the ingroup.

    legacy_outgroup lets outgroup samples count too.
    """
    used = samples if legacy_outgroup else samples.where(~F.col("in_outgroup"))
    return positions.join(F.broadcast(used.select("group_id", "sample_id")), ["group_id", "sample_id"], "left_semi").select("group_id", "p").distinct()


def dense(cells: DataFrame, positions: DataFrame, samples: DataFrame) -> DataFrame:
    """A row for every sample at every position; absent cells hold zeros.

    Samples are those of the position's group.
    """
    grid = positions.join(F.broadcast(samples.select("group_id", "sample_id", "in_outgroup")), "group_id")
    held = [*COUNTS, "qual", "ins", "del"]
    df = grid.join(cells.select("group_id", "sample_id", "p", *held), ["group_id", "sample_id", "p"], "left")
    return df.select("group_id", "sample_id", "p", "in_outgroup", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in held))


def build_cmt(diversity_: DataFrame, quals_: DataFrame, positions: DataFrame, samples: DataFrame) -> DataFrame:
    """Diversity and quality of all samples at the candidate positions.

    Quality is the negated FQ, so that more is better.
    """
    group = F.broadcast(samples.select("group_id", "sample_id"))
    held = diversity_.join(quals_, ["sample_id", "p"], "left").withColumn("qual", F.coalesce(-F.col("fq"), F.lit(0)))
    return dense(held.join(group, "sample_id"), positions, samples)


def raw_coverage(diversity_: DataFrame, samples: DataFrame, contigs: DataFrame, all_statistics: bool = False) -> DataFrame:
    """Dense coverage over the genome: the reads, or all statistics summed."""
    names = [c for c in diversity_.columns if c not in ("sample_id", "p")] if all_statistics else COUNTS
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    whole = contigs.select(F.explode(F.sequence("contig_start", F.col("contig_start") + F.col("contig_len") - 1)).alias("p"))
    grid = whole.join(F.broadcast(samples.select("group_id", "sample_id")))
    held = diversity_.select("sample_id", "p", total.cast("long").alias("cov"))
    return grid.join(held, ["sample_id", "p"], "left").select("group_id", "sample_id", "p", F.coalesce("cov", F.lit(0)).cast("long").alias("cov"))


def ref_base(positions: DataFrame, contigs: DataFrame) -> DataFrame:
    """positions with ref_nt and its code."""
    from basewise.operators.coverage import with_contig

    df = with_contig(positions, contigs).join(F.broadcast(contigs.select("contig_idx", "seq")), "contig_idx")
    nt: Column = F.substring("seq", F.col("contig_pos").cast("int"), F.lit(1))
    return df.withColumns({"ref_nt": nt, "ref_code": nt_to_int(nt)}).drop("seq")
