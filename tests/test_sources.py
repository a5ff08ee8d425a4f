"""Text and array sources, sinks, the stream."""

import gzip
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from basewise.sources import arrays, sinks, text
from basewise.streaming import ingest


def test_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("x,Sample,FileName,Reference,Group,Outgroup,Type\n /a , s1,f1,r,1,1,PE\n/a,s2,f2,r,1,0 ,SE\n")
    got = text.read_samples(spark, str(tmp_path / "s.csv"))
    assert [(r.Path, r.Sample, r.Outgroup) for r in got.collect()] == [("/a", "s1", True), ("/a", "s2", False)]
    assert text.mixed_types(got).count() == 1


def test_reads_of_a_sample():
    names = ["s1_1.fastq.gz", "s1_2.fastq.gz", "s10_1.fastq.gz", "s2.fastq"]
    assert text.find_reads(names, "s1") == names[:2] and text.find_reads(names, "s2") == ["s2.fastq"]
    with pytest.raises(ValueError):
        text.find_reads(names, "s3")


@pytest.mark.parametrize("zipped", [False, True])
def test_genome(spark, tmp_path, zipped):
    fasta = ">c1 first\nATGaaa\nTTT\n>c2\nCCCCCCTTACAT\n"
    gff = "##gff-version 3\nc1\tx\tgene\t1\t9\t.\t+\t0\tID=g1\nc1\tx\tCDS\t1\t9\t.\t+\t0\tID=a;gene=abc;protein_id=P1,P2\nc2\tx\tCDS\t7\t12\t.\t-\t0\tlocus_tag=L2\nc2\tx\ttRNA\t1\t3\t.\t+\t0\tID=t\n"
    for name, told in (("g.fasta", fasta), ("g.gff", gff)):
        path = tmp_path / (name + ".gz" * zipped)
        path.write_bytes(gzip.compress(told.encode()) if zipped else told.encode())
    contigs = text.read_fasta(spark, str(tmp_path / ("g.fasta" + ".gz" * zipped)))
    assert [(r.contig_name, r.contig_start, r.contig_len, r.seq) for r in contigs.orderBy("contig_idx").collect()] == [("c1", 1, 9, "ATGAAATTT"), ("c2", 10, 12, "CCCCCCTTACAT")]
    got = text.read_gff(spark, str(tmp_path / ("g.gff" + ".gz" * zipped)), contigs).orderBy("contig_idx", "loc1").collect()
    assert [(r.type, r.locustag, r.gene, r.sequence, r.translation, r.tagnumber) for r in got] == [("CDS", "a", "abc", "ATGAAATTT", "MKF", 1), ("tRNA", "t", ".", "CCC", ".", 0), ("CDS", "L2", ".", "ATGTAA", "M*", 2)]
    assert got[0].protein_id == ["P1", "P2"]


def test_logs_and_clusters(spark):
    log = spark.createDataFrame([("s", "  10 (12.50%) aligned exactly 1 time"), ("s", "90.00% overall alignment rate"), ("t", "nothing")], "sample_id string, value string")
    assert {tuple(r) for r in text.parse_aligner_log(log).collect()} == {("s", "12.50", "90.00"), ("t", "-1", "-1")}
    lines = spark.createDataFrame(list(enumerate([">Cluster 0", "0\t1aa, >A_1... *", "1\t1aa, >B_7... at 99%", ">Cluster 1", "0\t1aa, >A_2... *"])), "line long, value string")
    got = text.ortholog_table(text.parse_clusters(lines), ["A", "B"]).orderBy("cluster").collect()
    assert [tuple(r) for r in got] == [(0, "A_1", "B_7"), (1, "A_2", "NA")]


def test_table_round_trip(spark, tmp_path):
    out = io.BytesIO()
    counts = np.arange(2 * 3 * 40).reshape(2, 3, 40)
    np.savez_compressed(out, sample_names=np.array(["x", "y"]), p=np.array([1, 5, 9]), counts=counts, quals=-np.ones((2, 3), int), in_outgroup=np.array([False, True]))
    (tmp_path / "c.npz").write_bytes(out.getvalue())
    got = arrays.read_cmt(spark, str(tmp_path / "c.npz"))
    row = got.where("sample_id = 1 and p = 5").first()
    assert row.c1 == counts[1, 1, 0] and row.c8 == counts[1, 1, 7] and row.qual == 1 and row["del"] == 0 and row.in_outgroup
    samples = got.select("group_id", "sample_id", "sample_name", "in_outgroup").distinct()
    back = np.load(io.BytesIO(arrays.to_cmt(got, samples)))
    assert (back["counts"] == counts[:, :, :8]).all() and (back["quals"] == -1).all()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "A")], "group_id int, p long, nt string")
    sinks.write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where(F.col("group_id") == 1).first().nt == "A"
    sinks.write_report(df, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), sep="\t", header=True).first().p == "2"


def test_stream_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0.pileup").write_text("a\t1\tA\t2\t.,\tII\tII\t1,2\n")
    for extra in (None, "1.pileup"):
        if extra:
            (folder / extra).write_text("a\t2\tC\t1\tT\tI\tI\t1\n")
        ingest.ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.sample_id, r.pos, tuple(r.symbols)) for r in got.collect()) == [(0, 1, (1, 5)), (1, 2, (2,))]


def test_names_and_tags(spark, tmp_path):
    (tmp_path / "n.txt").write_text(" a \n\nb\n")
    assert [r.name for r in text.names(spark, str(tmp_path / "n.txt")).collect()] == ["a", "b"]
    lines = spark.createDataFrame([("s1", 0, ">ABC_0001 x"), ("s1", 1, "MK"), ("s2", 0, ">XY_7"), ("s2", 1, ">XZ_8")], "subject string, line long, value string")
    assert {r.subject: r.tag for r in text.subject_tags(lines).collect()} == {"s1": "ABC", "s2": "XY"}
    with pytest.raises(Exception, match="not a FASTA record"):
        text.subject_tags(lines.where("subject = 's1' and line = 1")).collect()
    got = spark.range(1).select(text.extended_name(F.lit("3"), F.lit(2), F.lit("nose"), F.lit("x")).alias("n")).first()
    assert got.n == "S3_V2_nose_x"
    (tmp_path / "l.csv").write_text("Batch,Sample,Alignments,ProviderName,Patient\nb1, s1 ,a;b,p,7\n")
    assert [(r.Sample, r.Patient) for r in text.read_samples(spark, str(tmp_path / "l.csv"), text.LEGACY_SHEET).collect()] == [("s1", "7")]


def test_written_by_sample(spark, tmp_path):
    sheet = spark.createDataFrame([("s1", "f1"), ("s2", "f2")], "Sample string, FileName string")
    for _ in range(2):
        text.write_by_sample(sheet, str(tmp_path / "out"))
    got = spark.read.csv(str(tmp_path / "out"), header=True)
    assert sorted((r.Sample, r.FileName) for r in got.collect()) == [("s1", "f1"), ("s2", "f2")]


def test_final_table_is_read_again(spark, tmp_path):
    from basewise.operators import report

    cmt = spark.createDataFrame([(1, s, p, 5) for s in (0, 1) for p in (1, 2, 3)], "group_id int, sample_id int, p long, c1 long")
    labels = spark.createDataFrame([(1, 1, 1, 0.9, False, True), (1, 2, 0, 0.2, True, True), (1, 3, 0, 0.1, False, False)], "group_id int, p long, label int, prob_out double, recomb boolean, good_all boolean")
    sinks.write_table(report.final_table(cmt, labels), str(tmp_path / "final"))
    held = spark.read.parquet(str(tmp_path / "final"))
    assert held.count() == 4
    assert {r.p: (r.prob, r.label, r.recomb) for r in report.table_labels(held).collect()} == {1: (0.9, 1, False), 2: (0.2, 0, True)}
