"""Array files: candidate mutation tables and coverage in npz, both ways."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions.cells import COUNTS

CELL = "group_id int, sample_id int, sample_name string, in_outgroup boolean, p long, " + ", ".join(f"{c} long" for c in COUNTS) + ", qual long, ins long, del long"


def read_cmt(spark: SparkSession, path: str, group_id: int = 1) -> DataFrame:
    """Cells of npz files: the first eight statistics, quality negated.

    Indel counters that are absent are 0.  A file is one group's cube; pickled
    content is never read.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                z = np.load(io.BytesIO(content.as_py()), allow_pickle=False)
                names, p, counts = z["sample_names"], z["p"], z["counts"][:, :, :8].astype(np.int64)
                indel = z["indel_counter"].astype(np.int64) if "indel_counter" in z else np.zeros((*counts.shape[:2], 2), np.int64)
                for s, name in enumerate(names):
                    n = len(p)
                    columns = [pa.array(np.full(n, group_id, np.int32)), pa.array(np.full(n, s, np.int32)), pa.array([str(name)] * n), pa.array(np.full(n, bool(z["in_outgroup"][s]))), pa.array(p.astype(np.int64))]
                    columns += [pa.array(counts[s, :, i]) for i in range(8)]
                    columns += [pa.array(-z["quals"][s].astype(np.int64)), pa.array(indel[s, :, 0]), pa.array(indel[s, :, 1])]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CELL.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(make, CELL)


def read_coverage(spark: SparkSession, path: str, key: str, group_id: int = 1) -> DataFrame:
    """group_id, sample_id, p, cov of an npz file's matrix."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for s, row in enumerate(np.load(io.BytesIO(content.as_py()), allow_pickle=False)[key]):
                    n = len(row)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, group_id, np.int32)), pa.array(np.full(n, s, np.int32)), pa.array(np.arange(1, n + 1)), pa.array(row.astype(np.int64))], ["group_id", "sample_id", "p", "cov"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(make, "group_id int, sample_id int, p long, cov long")


def to_cmt(cells: DataFrame, samples: DataFrame, group_id: int = 1) -> bytes:
    """One group's cells as an npz file's bytes, quality negated back.

    The cube of one group is what the file format holds; beyond that size,
    Parquet is the sink.
    """
    held = cells.where(F.col("group_id") == group_id).select("sample_id", "p", *COUNTS, "qual", "ins", "del").toPandas().sort_values(["sample_id", "p"])
    ids, p = np.unique(held.sample_id), np.unique(held.p)
    names = {r.sample_id: r for r in samples.where(F.col("group_id") == group_id).collect()}
    cube = held[[*COUNTS, "qual", "ins", "del"]].to_numpy(np.int64).reshape(len(ids), len(p), 11)
    out = io.BytesIO()
    np.savez_compressed(out, sample_names=np.array([names[i].sample_name for i in ids]), p=p, counts=cube[:, :, :8], quals=-cube[:, :, 8], in_outgroup=np.array([names[i].in_outgroup for i in ids]), indel_counter=cube[:, :, 9:])
    return out.getvalue()
