"""Silver reads (A11, A12): day partitions selected by a predicate on ``date``.

The filter on the partition column prunes folders at planning time, so a
one-day run lists one folder per feed however large the lake is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..sinks.writers import path_exists
from .adapters import Feeds

FEED_SCHEMAS = {
    "production": schemas.PRODUCTION,
    "consumption": schemas.SENSOR,
    "humidity": schemas.SENSOR,
    "temperature": schemas.SENSOR,
    "weather": schemas.WEATHER,
    "booking": schemas.BOOKING,
}


def empty(spark: SparkSession, feed: str) -> DataFrame:
    """A missing feed is an empty typed table; downstream plans return 0 rows."""
    return spark.createDataFrame([], FEED_SCHEMAS[feed])


def read_feed(spark: SparkSession, root: str, feed: str, start=None, end=None, kind: str | None = None) -> DataFrame:
    """Silver feed under its declared schema, optionally limited to [start, end] (partition pruning on ``date``).

    ``feed`` names the folder below ``root``; ``kind`` the schema, where it is not the folder's name.

    No file's footer decides: a column that some days lack is NULL on those days and stays on the others, columns that are not
    declared are not read. Rows without a time have no slot and are left out (a feed without the column gives none).
    """
    path, declared = f"{root}/{feed}", FEED_SCHEMAS[kind or feed]
    if not path_exists(spark, path):        # a corrupt or unreadable folder is an error, not an empty feed
        return spark.createDataFrame([], declared)
    by_month = (kind or feed) == "booking"         # its folders are months (yyyy-MM), all others' are days
    folders = T.StructType([T.StructField("month", T.StringType())] if by_month else [])
    df = spark.read.schema(T.StructType([*declared.fields, *folders.fields])).option("basePath", path).parquet(path)
    if by_month:                            # the month folders of the range, pruned as text
        for bound, keep in ((start, lambda x: F.col("month") >= x), (end, lambda x: F.col("month") <= x)):
            if bound is not None:
                df = df.where(keep(F.date_format(F.lit(bound).cast("date"), "yyyy-MM")))
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    if "time" in declared.fieldNames():
        df = df.where(F.col("time").isNotNull())
    return df.to(declared)


def read_feeds(spark: SparkSession, root: str, start=None, end=None) -> Feeds:
    return Feeds(*[read_feed(spark, root, f, start, end) for f in
                   ["production", "consumption", "humidity", "temperature", "weather", "booking"]])
