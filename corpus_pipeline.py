"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage works on all that its predecessor kept and is written as Parquet, in
the cluster's shared folder, before the next one reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.llm.common import removed, scratch, shared_dir
from basewise.llm.decontamination import without_benchmark
from basewise.llm.line_dedup import dedup_lines
from basewise.llm.packing import op5_pack
from basewise.llm.simhash_similar import one_of_each_group
from basewise.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones, or nearly so, go; n_chars follows."""
    return dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word similarity of 0.8 or more."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left, in sequences."""
    return op5_pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Packing's tokens are beyond SQL; the tests hold each stage to its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again.

    What a stage wrote for itself, and its input, go once its result is written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (name, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path := f"{base}/{n}-{name}")
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
