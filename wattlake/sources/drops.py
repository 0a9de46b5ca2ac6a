"""Bronze-style text drops derived from table rows (for end-to-end loads and tests).

Each raw line is built with DataFrame expressions and written as one text
column through the CSV writer (quoting off, a separator that never occurs),
so a line keeps exactly the fields it was built with: short and long lines
survive as they are, and the file encoding (UTF-16 for the sensor feeds) is
a writer option. Folders are ``month=MM``, which the scans read as the
month folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sinks import writers as W
from . import raw

UNUSED_SEP = "\u0001"
SENSOR_HEADER = ["Date", "Time", "Unit", "Value", "Variation"]


def write_lines(lines: DataFrame, path: str, header: list[str], sep: str = "\t", encoding: str = "UTF-8",
                partition_col: str | None = "month") -> str:
    """Write column ``line`` (plus ``partition_col``) as delimited text with a header line."""
    head = sep.join(header)
    df = lines.withColumnRenamed("line", head)
    w = (df.write.mode("overwrite").option("header", True).option("sep", UNUSED_SEP).option("quote", "")
         .option("escape", "").option("encoding", encoding))
    if partition_col:
        w = w.partitionBy(partition_col)
    w.csv(path)
    return path


def sensor_lines(readings: DataFrame, row_id: Column, sep: str = "\t", n_cells: int = 5) -> DataFrame:
    """Sensor-file lines from (date, time, unit, value_acquired, variation) rows.

    Dates alternate ``dd.MM.yyyy`` / ``d.M.yyyy``, decimals use commas, and a
    few lines chosen from ``row_id`` carry what real drops carry: an invalid
    date, an invalid number, a cell more than the header, or the wrong month folder. Every seventh line of
    a wider header (``n_cells``) has all its cells, the others are short.
    """
    m = F.month("date")
    raw_date = (F.when(row_id % 23 == 0, F.lit("n/a")).when(row_id % 2 == 0, F.date_format("date", "dd.MM.yyyy"))
                .otherwise(F.date_format("date", "d.M.yyyy")))
    val = F.when(row_id % 19 == 0, F.lit("x,y")).otherwise(
        F.replace(F.col("value_acquired").cast("string"), F.lit("."), F.lit(",")))
    var = F.replace(F.col("variation").cast("string"), F.lit("."), F.lit(","))
    fields = [raw_date, F.concat(F.lit(" "), F.col("time")), F.col("unit"), val, var]
    line = F.concat_ws(sep, *fields)
    more = F.lit((sep + "extra") * (n_cells - 4))
    line = F.when(row_id % 13 == 0, F.concat(line, more))
    line = line.when(row_id % 7 == 0, F.concat(F.concat_ws(sep, *fields), F.lit((sep + "note") * (n_cells - 5)))).otherwise(F.concat_ws(sep, *fields))
    folder = F.lpad(F.when(row_id % 10 == 0, m % 12 + 1).otherwise(m).cast("string"), 2, "0")
    return readings.select(line.alias("line"), folder.alias("month"))


# the scan binds by position, so the header repeats its own column names
INVERTER_HEADER = ["#Date", "Time"] + raw.inverter_columns()[2:]


def inverter_lines(production: DataFrame, sep: str = ";", too_long: Column | None = None) -> DataFrame:
    """Wide inverter-export lines (``dd.MM.yy``, time, 5 x 11 cells) from long readings.

    A missing inverter leaves its 11 cells empty. Lines of day 7 before 06:00
    get an invalid date; lines of day 15 from 12:00 go to the next month's folder. Lines that are ``too_long`` (of date and time) have two cells too many.
    """
    cells = []
    for b in range(1, 6):
        on = F.col("inv_id") == b
        for f in ["inv_id", "pac", "daysum", "status", "error"]:
            cells.append(F.coalesce(F.max(F.when(on, F.col(f).cast("string"))), F.lit("")))
        cells += [F.lit("")] * 6
    wide = production.groupBy("date", "time").agg(F.concat_ws(sep, *cells).alias("blocks"))
    bad = (F.dayofmonth("date") == 7) & (F.col("time") < "06:00:00")
    moved = (F.dayofmonth("date") == 15) & (F.col("time") >= "12:00:00")
    raw_date = F.when(bad, F.lit("xx.xx.xx")).otherwise(F.date_format("date", "dd.MM.yy"))
    m = F.month("date")
    folder = F.lpad(F.when(moved, m % 12 + 1).otherwise(m).cast("string"), 2, "0")
    line = F.concat_ws(sep, raw_date, F.col("time"), F.col("blocks"))
    if too_long is not None:
        line = F.when(too_long, F.concat(line, F.lit(sep + "x" + sep + "y"))).otherwise(line)
    return wide.select(line.alias("line"), folder.alias("month"))


WEATHER_HEADER = ["time", *raw.WEATHER_COLUMNS[1:]]
OFFSETS = [("Z", 0), ("+01:00", 60), ("-02:30", -150)]


def weather_lines(weather_rows: DataFrame, row_id: Column, ts: Column, too_long: Column | None = None) -> DataFrame:
    """Forecast-file lines: ISO time with Z / +01:00 / -02:30 for the same instant, the
    -99999.0 sentinel, a missing value, an unparsable time and a wrong month folder. ``too_long`` lines have a cell too many."""
    k = row_id % 3
    utc = F.date_trunc("second", ts)
    iso = None
    for i, (suffix, minutes) in enumerate(OFFSETS):
        wall = F.date_format(utc + F.expr(f"INTERVAL {minutes} MINUTES"), "yyyy-MM-dd'T'HH:mm:ss")
        text = F.concat(wall, F.lit(suffix))
        iso = F.when(k == i, text) if iso is None else iso.when(k == i, text)
    iso = F.when(row_id % 29 == 0, F.lit("garbage")).otherwise(iso)
    value = (F.when(row_id % 9 == 0, F.lit("-99999.0")).when(row_id % 11 == 0, F.lit(""))
             .otherwise(F.col("value").cast("string")))
    line = F.concat_ws(",", iso, value, F.col("prediction").cast("string"), "site", "measurement", "unit")
    if too_long is not None:
        line = F.when(too_long, F.concat(line, F.lit(",x"))).otherwise(line)
    m = F.month(utc)
    folder = F.lpad(F.when(row_id % 10 == 0, m % 12 + 1).otherwise(m).cast("string"), 2, "0")
    # issued on the day before, in the morning or at noon
    issue = F.concat(F.date_format(F.date_sub(utc, 1), "yyyy-MM-dd"), F.when(row_id % 2 == 0, F.lit("_0600")).otherwise(F.lit("_1200")))
    return weather_rows.select(line.alias("line"), folder.alias("month"), issue.alias("issue"))


def write_issues(lines: DataFrame, path: str, header: list[str], sep: str = ",") -> str:
    """Forecast drops: one ``Pred_<issue>_<n>.csv`` per issue and file, in month folders."""
    spark = lines.sparkSession
    head = sep.join(header)
    df = lines.withColumnRenamed("line", head)
    (df.repartition("month", "issue").write.mode("overwrite").option("header", True).option("sep", UNUSED_SEP).option("quote", "")
     .option("escape", "").partitionBy("month", "issue").csv(f"{path}-parts"))
    _, fs = W.hadoop_path(spark, path)
    found = fs.listFiles(W.hadoop_path(spark, f"{path}-parts")[0], True)
    n = 0
    while found.hasNext():                      # a few files per issue: names are given on the driver, rows stay where they are
        p = found.next().getPath()
        if p.getName().endswith(".csv"):
            issue, month = p.getParent().getName().split("=")[1], p.getParent().getParent().getName()
            folder, n = W.hadoop_path(spark, f"{path}/{month}")[0], n + 1
            fs.mkdirs(folder)
            fs.rename(p, W.hadoop_path(spark, f"{path}/{month}/Pred_{issue}_{n}.csv")[0])
    return path


_FRENCH = {v: k for k, v in tx.BOOKING_HEADERS.items()}


def french(column: str) -> str:
    """Header name of a booking column."""
    return _FRENCH[column]


BOOKING_HEADER = [_FRENCH[c] for c in ("room_id", "room_name", "raw_date", "start_time", "end_time", "reservation_id", "activity_type",
                                        "instructor", "department", "reserved_by", "class")]


def booking_lines(booking: DataFrame, sep: str = "\t", order: list[str] | None = None, long_every: int | None = None) -> DataFrame:
    """French booking-export lines: quoted room ids, French dates, empty and 'nan' cells.

    ``order`` gives another column order; every ``long_every``-th line has two cells too many.
    """
    k = F.col("reservation_id")
    tok = F.element_at(F.array(*[F.lit(fr) for fr, _ in tx.FRENCH_MONTHS]), F.month("date"))
    fr_date = F.when(k % 31 == 0, F.lit("?? ??? ????")).otherwise(
        F.concat_ws(" ", F.lpad(F.dayofmonth("date").cast("string"), 2, "0"), tok, F.year("date").cast("string")))
    room = F.when(k % 5 == 0, F.concat(F.lit('"'), F.col("room_id"), F.lit('"'))).otherwise(F.col("room_id"))
    activity = F.when(k % 7 == 0, F.lit("")).otherwise(F.col("activity_type"))
    prof = (F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("nan"))
            .otherwise(F.concat(F.lit("Prof "), F.col("department"))))
    cells = [room, F.concat(F.lit("Room "), F.col("room_id")), fr_date, F.col("start_time"), F.col("end_time"),
             k.cast("string"), activity, prof, F.col("department"), F.col("reserved_by"), F.col("class")]
    if order:
        cells = [cells[BOOKING_HEADER.index(h)] for h in order]
    line = F.concat_ws(sep, *cells)
    if long_every:
        line = F.when(k % long_every == 0, F.concat(line, F.lit(sep + "x" + sep + "y"))).otherwise(line)
    return booking.select(line.alias("line"))
