"""Shared pieces: the cluster's shared folder, written tables, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir.

    Only where the session names none (tests, one machine) is a new folder
    made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="basewise-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Paths written in the scratch scope that is open, if one is.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written within goes at the end: results must be written by then."""
    token = _SCRATCH.set(held := [])
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in held:
            removed(spark, path)


#: Rows a file of a table whose size is known holds, at least.
FILE_ROWS = 500_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor; it stays until
    the caller clears the folder, or its scratch scope ends.  If a bound of
    its rows is known, it is written in so many files as they ask for.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(2, -(-rows // FILE_ROWS)))
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (held := _SCRATCH.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, name: str, rows: int, chars: int = 1 << 24, width: str = "0L") -> DataFrame:
    """df, written, to be broadcast if it has been counted as small enough: at
    most so many rows, and so much in all of width, an expression of a row."""
    df = written(df, name)
    n, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.expr(width)), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= chars else df


#: Keys that hold more than this part of all rows are hot: so many at most.
HOT = 10_000


def attached(rows: DataFrame, named: DataFrame, key: str, total: int) -> DataFrame:
    """rows with named's columns by key, which is unique in named.

    named has n, how many of the total rows have the key.  A key of over a HOT-th
    of them, of which there can't be more than HOT, is joined by broadcast, so
    that no task gets all its rows; the others are joined by a shuffle.
    """
    told = named.withColumnRenamed(key, "of")
    hot = F.col("n") * HOT > total
    few = F.broadcast(told.where(hot).drop("n"))
    first = rows.join(few, F.col(key) == F.col("of"))
    rest = rows.join(F.broadcast(told.where(hot).select("of")), F.col(key) == F.col("of"), "left_anti")
    return first.unionByName(rest.join(told.where(~hot).drop("n"), F.col(key) == F.col("of"))).drop("of")


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), value worked out once however often of names it.

    Within a lambda an expression would be worked out for every element.
    """
    return F.get(F.transform(F.array(value), of), F.lit(0))


def running(values: Column, of: Callable[[Column, Column], Column]) -> Column:
    """of, taken over all values up to each, by doubling the reach: an array of n
    costs n times the logarithm of n."""
    steps = F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))

    def wider(a: Column, step: Column) -> Column:
        return F.transform(a, lambda x, i: F.when(i >= step, of(x, F.get(a, i - step))).otherwise(x))

    return F.aggregate(steps, values, wider)


#: Rows of a side of known bound that is broadcast, at most.
BROADCAST_ROWS = 200_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b) -> (node, root).

    Alternating large-star and small-star contraction: every round joins each
    node's edges to its smallest neighbour, so the number of rounds grows with
    the logarithm of the longest chain.  root is the smallest node of the
    component.  Each round is written to the shared folder.  A node's smallest
    neighbour is broadcast while so few edges are left as BROADCAST_ROWS bounds;
    beyond, a node with very many edges is a skewed join that Spark splits.
    Empty input gives an empty result; null ends and loops are ignored.
    """
    now = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark, rows = None, now.count()
    for _ in range(max_rounds):
        side = F.broadcast if 2 * rows <= BROADCAST_ROWS else (lambda df: df)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(side(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(side(down), "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        # A round gives each edge's ends at most one edge each.
        now = written(small, "edges", 2 * rows)
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark, rows = seen, seen[0]
    raise RuntimeError("components did not settle")
