"""Session settings and small Spark helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_runtime_conf
from ..sinks.writers import stage  # noqa: F401  (written table in the shared folder)

ARROW_ROWS = 2000   # rows per Arrow batch: bounds a Python worker's memory for long texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Library settings plus smaller Arrow batches."""
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def parts_for(rows: int, rows_per_part: int, least: int = 1) -> int:
    """Number of hash parts so that each holds about ``rows_per_part`` rows, at any size of input."""
    return max(least, math.ceil(rows / rows_per_part))


def crc_mod(col: str, m: int):
    """crc32(col as text) mod m, the fold rule of the contracts (a null id has the text '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(m))
