"""Places in a global order, without one task that sees all rows.

Rows are range-partitioned and sorted, every row takes its place inside its
partition, and a table with one row per (partition, group) turns these into
places in the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, stage

ROWS = 50_000           # rows of a range


def indexed(df: DataFrame, group: str, order: list[Column], place: str = "__i", size: str = "__n") -> DataFrame:
    """``df`` (narrow rows) with the row's 0-based place in its group's order and the group's number of rows.

    ``group`` must not be null. Rows equal in group and order are placed as they stand in ``df``. A group, or rows
    equal in everything, may hold any share of the rows: the ranges cut through them.
    """
    spark = df.sparkSession
    df = stage(spark, df, "places-in").withColumn("__u", F.monotonically_increasing_id())
    parts = parts_for(df.count(), ROWS)
    keys = [F.col(group), *order, F.col("__u")]
    df = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    df = df.withColumns({"__p": F.spark_partition_id(), "__k": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    df = stage(spark, df, "places")
    every, before = Window.partitionBy(group), Window.partitionBy(group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(group, "__p").agg(F.count(F.lit(1)).alias("__c"), F.min("__k").alias("__k0"))
    sizes = sizes.select(group, "__p", F.sum("__c").over(every).alias(size),
                         (F.coalesce(F.sum("__c").over(before), F.lit(0)) - F.col("__k0")).alias("__off"))
    sizes = stage(spark, sizes, "places-sizes")         # one row per range and group, so Spark knows its size before it joins
    return df.join(sizes, [group, "__p"]).withColumn(place, F.col("__k") + F.col("__off")).drop("__p", "__k", "__off", "__u")
