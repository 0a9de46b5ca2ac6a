"""Bronze -> silver loads (L1-L4): one parse that gives each line its outcome, then a day-partitioned write of the rows that
stay and a quarantine of the lines that do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import text as tx
from ..operators import filters as FL
from ..operators import reshape as R
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import raw


REASON = "_reason"


def _month_reason(date) -> Column:
    """D2 as a reason: the row's month folder."""
    month = F.col("folder_month").try_cast("int")
    return F.when(month.isNull(), "no month folder").when(F.month(date) != month, "wrong month folder")


def _too_long(lines: DataFrame) -> Column:
    return F.when(F.col(raw.BAD), "too many cells") if raw.BAD in lines.columns else F.lit(None).cast("string")


def _kept(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON, *[c for c in rows.columns if c in ("file_path", "file_name", raw.LINE)])


def _trace(lines: DataFrame) -> list[Column]:
    """Where a line came from, on rejected lines alone (a kept row carries nulls)."""
    return [F.when(F.col(REASON).isNotNull(), F.col(c)).alias(c) for c in ("file_path", "file_name", raw.LINE) if c in lines.columns]


def sensor_outcomes(lines: DataFrame, keep: tuple = ()) -> DataFrame:
    """L1 transform with the first reason to reject: C1, C6, C8, D1, D2 over positional sensor columns."""
    date, value = tx.parse_eu_date("raw_date"), tx.eu_decimal("val_raw")
    reason = F.coalesce(_too_long(lines), F.when(date.isNull(), "bad date").when(value.isNull(), "bad value"), _month_reason(date))
    return lines.withColumn(REASON, reason).select(
        date.alias("date"), F.trim("time_str").alias("time"), "unit", value.alias("value_acquired"), tx.eu_decimal("var_raw").alias("variation"),
        *keep, *_trace(lines), REASON)


def clean_sensor(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """L1: the rows that stay."""
    return _kept(sensor_outcomes(df, keep))


def production_outcomes(wide: DataFrame) -> DataFrame:
    """L2 transform up to the unpivot: C2 date and D2 month guard on the wide line, with the first reason to reject it."""
    date = tx.parse_short_date("raw_date")
    reason = F.coalesce(_too_long(wide), F.when(date.isNull(), "bad date"), _month_reason(date))
    blocks = [c for c in raw.inverter_columns() if c not in ("raw_date", "time_str")]
    return wide.withColumn(REASON, reason).select(date.alias("date"), F.trim("time_str").alias("time"), *blocks, *_trace(wide), REASON)


def unpivot_production(wide: DataFrame) -> DataFrame:
    """E1 unpivot and C7 numbers of the lines that stay."""
    long = R.unpivot_inverters(wide, keep=["date", "time"])
    return long.select("date", "time", tx.to_double("inv_id").cast("int").alias("inv_id"),
                       *[(F.trim(c) if c == "status" else tx.to_double(c)).alias(c) for c in
                         ("pac", "daysum", "status", "error", "pdc1", "pdc2", "udc1", "udc2", "temp", "uac")])


def clean_production(wide: DataFrame) -> DataFrame:
    """L2: the readings that stay."""
    return unpivot_production(_kept(production_outcomes(wide)))


def weather_outcomes(lines: DataFrame) -> DataFrame:
    """L3 transform with the first reason to reject: C3 UTC parse, C7 numbers, D2 month guard, D3 sentinel (NULL kept)."""
    ts, value = tx.parse_iso_utc("time_raw"), tx.to_double("value")
    reason = F.coalesce(_too_long(lines), F.when(ts.isNull(), "bad time"), _month_reason(F.to_date(ts)),
                        F.when(value.eqNullSafe(F.lit(FL.SENTINEL_VALUE)), "sentinel"))
    return lines.withColumn(REASON, reason).select(
        F.to_date(ts).alias("date"), tx.ts_time(ts).alias("time"), value.alias("value"), tx.to_double("prediction").alias("prediction"),
        "site", "measurement", "unit", "issued", *_trace(lines), REASON)


def clean_weather(df: DataFrame) -> DataFrame:
    """L3: the rows that stay."""
    return _kept(weather_outcomes(df))


def clean_booking(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """L4 transform of the latest export: C9 strip, C11 placeholders, C4/C5 dates, C12 projection; columns ``keep`` stay as they are."""
    strings = [c for c, t in df.dtypes if t == "string" and c not in ("file_path", "file_name", "feed", "month", *keep)]
    df = df.withColumns({c: tx.strip_quotes(c) for c in strings})
    df = df.withColumns({c: tx.fill_placeholder(c) for c in tx.PLACEHOLDER_COLUMNS if c in df.columns})
    # Q20: start/end are not placeholder-filled; their missing tokens become NULL
    df = df.withColumns({c: F.when(~F.col(c).isin(*tx.MISSING_TOKENS), F.col(c))
                         for c in ("start_time", "end_time") if c in df.columns})
    if "raw_date" in df.columns:
        df = df.withColumn("date", tx.french_date("raw_date"))
    return tx.select_existing(df, [*tx.BOOKING_COLUMNS, *keep])


def sensor_rejects(lines: DataFrame) -> DataFrame:
    """Lines that L1 leaves out, with the first reason that holds (``lines``: a scan with ``keep_bad``)."""
    return rejects(sensor_outcomes(lines))


def rejects(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col(REASON).isNotNull()).select("file_path", "file_name", F.col(raw.LINE).alias("line"), F.col(REASON).alias("reason"))


def split(outcomes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rejected lines) of one parse: both are written in one pass, each into a folder of its own."""
    spark = outcomes.sparkSession
    path = scratch_path(spark, f"outcome-{name}")
    outcomes.withColumn("_ok", F.col(REASON).isNull()).write.mode("overwrite").partitionBy("_ok").parquet(path)
    both = spark.read.schema(T.StructType([*outcomes.schema.fields, T.StructField("_ok", T.BooleanType())])).parquet(path)
    return _kept(both.where("_ok").drop("_ok")), rejects(both.where("not _ok").drop("_ok"))


def _quarantine(rejected: DataFrame, path: str | None) -> None:
    if path:
        rejected.write.mode("overwrite").parquet(path)


def load_sensor(spark: SparkSession, bronze_path, silver_path: str, sep: str | None = None, full: bool = False,
                encoding: str = "UTF-16", quarantine_path: str | None = None) -> None:
    """L1: one scan over all month folders, replace the months read (B1); rejected lines go to ``quarantine_path``."""
    rows, bad = split(sensor_outcomes(raw.read_sensor(spark, bronze_path, sep, encoding, keep_bad=True)), "sensor")
    W.replace_months(W.conform(rows, schemas.SENSOR), silver_path, full=full, staged=True)
    _quarantine(bad, quarantine_path)


def load_production(spark: SparkSession, bronze_path, silver_path: str, sep: str | None = None, quarantine_path: str | None = None) -> None:
    """L2 (+S1: rows sorted by time and inverter inside each day's files); a rejected line stands once in the quarantine."""
    lines, bad = split(production_outcomes(raw.read_inverters(spark, bronze_path, sep, keep_bad=True)), "production")
    W.replace_months(W.conform(unpivot_production(lines), schemas.PRODUCTION), silver_path, order=("time", "inv_id"), staged=True)
    _quarantine(bad, quarantine_path)


def load_weather(spark: SparkSession, bronze_path, silver_path: str, sep: str | None = ",", quarantine_path: str | None = None) -> None:
    """L3."""
    rows, bad = split(weather_outcomes(raw.read_weather(spark, bronze_path, sep, keep_bad=True)), "weather")
    W.replace_months(W.conform(rows, schemas.WEATHER), silver_path, staged=True)
    _quarantine(bad, quarantine_path)


def load_booking(spark: SparkSession, bronze_path, silver_path: str, latest: str = "file", quarantine_path: str | None = None) -> None:
    """L4: snapshot of the latest export, rewritten whole, one folder per year and month (B2).

    ``latest="dir"`` treats a folder of part files as one export. An unreadable date is the placeholder of C5, so
    only over-long lines are rejected.
    """
    lines = raw.read_booking(spark, bronze_path, latest=latest, keep_bad=True)
    trace = ["file_path", "file_name", raw.LINE]
    lines = lines.withColumn(REASON, _too_long(lines))
    rows, bad = split(clean_booking(lines, (*trace, REASON)), "booking")
    W.rewrite_layer(W.conform(rows, schemas.BOOKING).withColumn("month", F.date_format("date", "yyyy-MM")), silver_path, "month")
    _quarantine(bad, quarantine_path)
