"""Bronze scans.

Daily drops (sensors, inverter export, forecasts) vary in separator and width: ``scan.plan`` reads their headers
alone and gives each (encoding, separator, width) one splittable scan. Cells are bound by position (headers are
unreliable). A line with more cells than its own file's header is flagged, a short one is null-padded, and
cells beyond the wanted ones are ignored. Malformed text and unreadable files
fail the scan; nothing is skipped silently. Of the booking exports the latest alone is read, under its own header.
Routing (feed, month, issue time) comes from the file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators.reshape import INVERTER_BLOCK, N_INVERTERS, wide_name
from . import scan

LINE = "_line"
BAD = "_bad"

# --- fixed values -----------------------------------------------------------
# File-name patterns of the bronze drops (group 2 is the month in each).
SENSOR_FILE = r"^(\d{2})\.(\d{2})\.(\d{4})-([A-Za-z]+)\.csv"         # dd.MM.yyyy-<Feed>.csv
PRODUCTION_FILE = r"^min(\d{2})(\d{2})(\d{2})\.csv"                    # minyyMMdd.csv
BOOKING_FILE = r"^RoomAllocations_(\d{4})(\d{2})"                      # RoomAllocations_yyyyMM*.csv
WEATHER_FILE = r"^Pred_(\d{4})-(\d{2})-(\d{2})_(\d{2})(\d{2})"        # Pred_yyyy-MM-dd_HHMM*.csv
UNKNOWN = "unknown"
SENSOR_COLUMNS = ["raw_date", "time_str", "unit", "val_raw", "var_raw"]
WEATHER_COLUMNS = ["time_raw", "value", "prediction", "site", "measurement", "unit"]
# ---------------------------------------------------------------------------


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def parse_files(spark: SparkSession, paths: list[str], names: list[str], encoding: str, sep: str | None = None, keep_bad: bool = False) -> DataFrame:
    """Lines of the files as columns ``names`` by position.

    Without ``sep`` each file's separator is the candidate its header holds most
    often. ``keep_bad`` returns over-long lines too, flagged ``_bad``, with the line text.
    """
    cell = lambda i: F.get("_cells", F.lit(i))
    out = None
    for group in scan.plan(spark, paths, encoding, sep):
        df = scan.lines(spark, group).withColumn(BAD, F.size("_cells") > group.width)
        if not keep_bad:
            df = df.where(~F.col(BAD))
        df = df.select(*[F.when(cell(i) != "", cell(i)).alias(n) for i, n in enumerate(names)], "file_path",
                       F.element_at(F.split("file_path", "/"), -1).alias("file_name"), *([LINE, BAD] if keep_bad else []))
        out = df if out is None else out.unionByName(df)
    if out is None:
        out = spark.createDataFrame([], T.StructType([*string_schema([*names, "file_path", "file_name"]).fields,
                                                      *([T.StructField(LINE, T.StringType()), T.StructField(BAD, T.BooleanType())] if keep_bad else [])]))
    return out


def folder_month(path: Column | str = "file_path") -> Column:
    """``MM`` (or Hive-style ``month=MM``) folder right above the file, NULL if none."""
    p = F.col(path) if isinstance(path, str) else path
    m = F.regexp_extract(p, r"/(?:month=)?(\d{2})/[^/]+$", 1)
    return F.when(m != "", m)


def route(file_name: Column | str, pattern: str, feed_group: int | None = None,
          month_group: int = 2, feed_name: str | None = None) -> dict[str, Column]:
    """(feed, month) from the file name; no match -> ``unknown``."""
    fn = F.col(file_name) if isinstance(file_name, str) else file_name
    hit = fn.rlike(pattern)
    feed = F.regexp_extract(fn, pattern, feed_group) if feed_group else F.lit(feed_name)
    return {"feed": F.when(hit, feed).otherwise(F.lit(UNKNOWN)),
            "month": F.when(hit, F.regexp_extract(fn, pattern, month_group)).otherwise(F.lit(UNKNOWN))}


def read_sensor(spark: SparkSession, path, sep: str | None = None, encoding: str = "UTF-16", keep_bad: bool = False) -> DataFrame:
    """A1 + A5-A7 + A9: UTF-16 sensor drops (humidity, temperature, consumption, PV)."""
    return sensor_rows(spark, scan.list_files(spark, path), sep, encoding, keep_bad)


def sensor_rows(spark: SparkSession, paths: list[str], sep: str | None = None, encoding: str = "UTF-16", keep_bad: bool = False) -> DataFrame:
    df = parse_files(spark, paths, SENSOR_COLUMNS, encoding, sep, keep_bad)
    named = F.regexp_extract("file_name", SENSOR_FILE, 2)
    return df.withColumns({**route("file_name", SENSOR_FILE, feed_group=4),
                           "folder_month": F.coalesce(folder_month(), F.when(named != "", named))})


def inverter_columns(n_blocks: int = N_INVERTERS) -> list[str]:
    return ["raw_date", "time_str"] + [wide_name(b, f) for b in range(1, n_blocks + 1) for f in INVERTER_BLOCK]


def read_inverters(spark: SparkSession, path, sep: str | None = None, encoding: str = "UTF-8", keep_bad: bool = False) -> DataFrame:
    """A2: wide inverter export, 2 + 5 x 11 columns; further blocks of a wider file are ignored."""
    df = parse_files(spark, scan.list_files(spark, path), inverter_columns(), encoding, sep, keep_bad)
    return df.withColumns({**route("file_name", PRODUCTION_FILE, feed_name="production"),
                           "folder_month": F.coalesce(folder_month(), F.regexp_extract("file_name", PRODUCTION_FILE, 2))})


def read_weather(spark: SparkSession, path, sep: str | None = ",", encoding: str = "UTF-8", keep_bad: bool = False) -> DataFrame:
    """A3: forecast drops; ``issued`` from ``Pred_yyyy-MM-dd_HHMM``."""
    df = parse_files(spark, scan.list_files(spark, path), WEATHER_COLUMNS, encoding, sep, keep_bad)
    g = lambda i: F.regexp_extract("file_name", WEATHER_FILE, i)
    issued = F.try_to_timestamp(F.concat(g(1), F.lit("-"), g(2), F.lit("-"), g(3), F.lit(" "), g(4), F.lit(":"), g(5)),
                                F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")
    return df.withColumns({**route("file_name", WEATHER_FILE, feed_name="weather"),
                           "folder_month": F.coalesce(folder_month(), g(2)), "issued": issued})


def latest_export(spark: SparkSession, path, level: str = "file") -> str | None:
    """Path of the lexicographically last export, chosen from the listing alone.

    ``level="dir"`` takes the parent folder of the last file, for exports
    written as a folder of part files. The listing is all that comes to the driver.
    """
    paths = scan.list_files(spark, path)
    return max((p if level == "file" else p.rsplit("/", 1)[0] for p in paths), default=None)


def read_booking(spark: SparkSession, path, sep: str = "\t", encoding: str = "UTF-8", latest: str = "file", keep_bad: bool = False) -> DataFrame:
    """A4-A6 + A8: the latest export only, tab separated, quoting disabled, under its own French header (C9/C10 applied).

    A line with more cells than the header is dropped (A5); ``keep_bad`` keeps it, flagged ``_bad``, with the line text.
    """
    export = latest_export(spark, path, latest)
    if export is None:
        raise FileNotFoundError(f"no booking export under {path}")
    out = None
    for group in scan.plan(spark, scan.list_files(spark, export), encoding, sep, by_header=True):
        df = scan.lines(spark, group, quotes=False).withColumn(BAD, F.size("_cells") > group.width)
        cell = lambda i: F.get("_cells", F.lit(i))
        header = _unique(next(iter(group.headers)).split(sep))
        df = df.select(*[F.when(cell(i) != "", cell(i)).alias(n) for i, n in enumerate(header)], "file_path",
                       F.element_at(F.split("file_path", "/"), -1).alias("file_name"), LINE, BAD)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"the booking export {export} is empty")
    out = tx.rename_headers(out if keep_bad else out.where(~F.col(BAD)).drop(LINE, BAD))
    return out.withColumns(route("file_name", BOOKING_FILE, feed_name="booking"))


def _unique(header: list[str]) -> list[str]:
    """Column names of a header: an empty one or one that came before gets its place."""
    return [f"_c{i}" if not h.strip() else f"{h}{i}" if h in header[:i] else h for i, h in enumerate(header)]
