"""Running sums over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, value: Column, order: str, bucket: Column, name: str) -> DataFrame:
    """df with the sum of value over all rows before each, by order.

    bucket ascends with order.  Rows are summed within their bucket, and only
    the buckets' totals, one row each, meet in a single task.
    """
    held = df.withColumns({"__bucket": bucket, "__value": value})
    inside = Window.partitionBy("__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy("__bucket").agg(F.sum("__value").alias("__total"))
    before = totals.select("__bucket", F.coalesce(F.sum("__total").over(over), F.lit(0)).alias("__before"))
    told = held.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0))).join(before, "__bucket")
    return told.withColumn(name, F.col("__before") + F.col("__inside")).drop("__bucket", "__value", "__inside", "__before")
