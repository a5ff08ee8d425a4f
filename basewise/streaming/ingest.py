"""Pileup text as a stream: new files are counted into cells as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basewise.operators.candidates import parse_pileup


def pileup_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of parse_pileup for files named <sample_id>.<anything>."""
    lines = spark.readStream.text(folder)
    sample = F.regexp_extract(F.input_file_name(), r"/(\d+)\.[^/]*$", 1).cast("int")
    return parse_pileup(lines.select(sample.alias("sample_id"), "value"))


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """All files that are there, once, into Parquet; a rerun takes new ones only."""
    query = pileup_stream(spark, folder).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()
