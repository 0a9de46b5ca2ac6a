"""Incremental bronze -> silver ingest (A10) with the Structured Streaming file source.

The file source's checkpoint remembers which files were processed;
``trigger(availableNow=True)`` processes what is new and stops, so a daily run is a
bounded job that survives restarts (the checkpoint lives in the shared folder).

Each micro-batch rewrites the days it touches: their stored rows and the new ones
are brought together and the day's latest delivery stays, so a day that arrives again
replaces the old one, a late file of the same delivery adds to it, and a
batch that runs twice after a failure changes nothing. Only the touched day folders are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import silver as SL
from ..schemas import SENSOR
from ..sinks import writers as W
from ..sources import raw

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
DELIVERY, FILE = "_delivery", "_file"
FIRST_DAY = "0000-01-01"       # no day is older
FILES_PER_BATCH = 1000          # a backlog is many batches, not one
SENSOR_SILVER = SENSOR


@dataclass
class SensorStream:
    """Names of the files as they arrive, and how to read them."""

    files: DataFrame
    sep: str | None
    encoding: str
    delivery: Column


def sensor_stream(spark: SparkSession, source_dir: str, sep: str | None = None, encoding: str = "UTF-8",
                  delivery: Column | None = None, max_files_per_trigger: int = FILES_PER_BATCH) -> SensorStream:
    """Stream of the drops' names (their contents are not read here: each batch plans its own splittable scans).

    ``delivery`` orders deliveries of a day (a text from ``file_path``); by default the file's folder does.
    """
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.csv*")
             .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))
    return SensorStream(files.select("path"), sep, encoding, delivery if delivery is not None else F.regexp_replace("file_path", "/[^/]*$", ""))


def read_batch(spark: SparkSession, paths: list[str], stream: SensorStream) -> DataFrame:
    """Cleaned rows of the files of one batch, with the delivery and file of each row."""
    rows = raw.sensor_rows(spark, paths, stream.sep, stream.encoding)
    return SL.clean_sensor(rows.withColumns({DELIVERY: stream.delivery, FILE: F.col("file_path")}), keep=(DELIVERY, FILE))


def rewrite_days(spark: SparkSession, batch: DataFrame, sink_dir: str) -> int:
    """Bring a micro-batch into its days; returns the rows of these days afterwards."""
    new = W.stage(spark, batch, "ingest-batch")
    rows = new
    if W.path_exists(spark, sink_dir):
        # the join prunes the day folders when it runs; the bound makes the days a selective side
        days = new.where(F.col("date") >= F.lit(FIRST_DAY).cast("date")).select("date").distinct()
        old = spark.read.schema(batch.schema).parquet(sink_dir).join(F.broadcast(days), "date", "left_semi")     # at most the days of one batch
        rows = new.unionByName(old.join(new.select(FILE).distinct(), FILE, "left_anti"))
    last = rows.groupBy("date").agg(F.max(DELIVERY).alias(DELIVERY))
    kept = W.stage(spark, rows.join(last, ["date", DELIVERY], "left_semi"), "ingest-days")
    W.replace_days(kept.select(*batch.columns), sink_dir)
    return kept.count()


def run_available_now(stream: SensorStream, sink_dir: str, checkpoint_dir: str) -> int:
    """Process every file not seen yet, then stop. Returns the rows in the days this run rewrote."""
    spark, written = stream.files.sparkSession, []

    def load(batch, _):
        paths = [r[0] for r in batch.collect()]                     # at most the files of one batch
        if paths:
            written.append(rewrite_days(spark, read_batch(spark, paths, stream), sink_dir))
    q = (stream.files.writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(written)


def read_silver(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.schema(SENSOR_SILVER).parquet(sink_dir).select(*SENSOR_SILVER.fieldNames())
