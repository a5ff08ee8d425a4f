"""Tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a new folder only where it names none
    (tests, one machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="basewise-"))
    return context.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back.

    Steps that join their input to itself would multiply the plan; behind a
    written table the lineage is one scan, and outlives any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
