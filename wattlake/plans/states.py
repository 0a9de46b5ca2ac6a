"""Incremental marts (G13-G16, B5) and mergeable distinct rooms.

A day's contribution to every mart is kept as additive state: sums, counts and maxima in one row per day, and the rooms booked
on it as bitmaps. A refresh recomputes the states of the touched days from those days' rows alone and replaces them;
months and the overall figures are rolled up from the states, so a late delivery never reads the rest of the lake.

Distinct rooms of a month are not a sum of days, but the OR of their bitmaps: rooms are numbered once (a stored
dimension that only grows) and a bitmap holds 32,768 of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import aggregates as G
from ..sinks import writers as W
from ..sources.adapters import Feeds

MONEY, DIGITS = G.MONEY, 6


def month_of(date: str = "date") -> Column:
    return F.date_trunc("month", F.col(date)).cast("date")


# --- rooms ----------------------------------------------------------------------------------------
def number_rooms(spark: SparkSession, root: str, booking: DataFrame) -> DataFrame:
    """(room_id, number) of every room ever seen under ``root``; rooms that are new get the next numbers."""
    path = f"{root}/room_numbers"
    new = booking.select("room_id").where(F.col("room_id").isNotNull()).distinct()
    known = spark.read.parquet(path) if W.path_exists(spark, path) else None
    last = 0
    if known is not None:
        new = new.join(known, "room_id", "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    # the rooms of a campus, and only those never seen before
    new = new.withColumn("number", (F.row_number().over(Window.orderBy("room_id")) + last).cast("long"))
    W.stage(spark, new, "rooms").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def room_bits(booking: DataFrame, numbers: DataFrame) -> DataFrame:
    """(date, bucket, bits): rooms booked on a day, as bitmaps."""
    b = booking.select("date", "room_id").distinct().join(numbers, "room_id")
    return b.groupBy("date", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def rooms_of_month(bits: DataFrame) -> DataFrame:
    """(ym, rooms_total): distinct rooms of each month from its days' bitmaps."""
    return (bits.groupBy(month_of().alias("ym"), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            .groupBy("ym").agg(F.sum(F.bitmap_count("bits")).alias("rooms_total")))


# --- states ---------------------------------------------------------------------------------------
def day_states(feeds: Feeds) -> DataFrame:
    """One row per day of any feed: what the marts need of it."""
    prod = feeds.production.groupBy("date", "inv_id").agg(F.max("daysum").alias("m")).groupBy("date").agg(
        F.max("m").alias("production_max"), F.sum(F.col("m").cast(MONEY)).alias("production_sum"))
    cons = G.daily_consumption_total(feeds.consumption).select("date", F.col("sum_variation_w").alias("consumption"))
    mean = lambda df, n: df.groupBy("date").agg(F.sum("value_acquired").alias(f"{n}_sum"), F.count("value_acquired").alias(f"{n}_n"))
    slots = feeds.booking.groupBy("date", "start_time").agg(F.count_distinct("room_id").alias("b")).groupBy("date").agg(
        F.sum("b").alias("booked_sum"), F.count(F.lit(1)).alias("slots"))
    err = feeds.weather.groupBy("date").agg(F.count(F.lit(1)).alias("forecasts"), F.sum(F.abs(F.col("value") - F.col("prediction")).cast(MONEY)).alias("forecast_error"),
                                            F.sum(F.abs("value").cast(MONEY)).alias("forecast_size"))
    out = prod
    for part in (cons, mean(feeds.humidity, "humidity"), mean(feeds.temperature, "temperature"), slots, err):
        out = out.join(part, "date", "full")
    return out.where(F.col("date").isNotNull())


def refresh(spark: SparkSession, root: str, feeds: Feeds, days: DataFrame | None = None) -> None:
    """Bring the states under ``root`` up to date: all days of the feeds, or the days in ``days`` (column ``date``) alone.

    A day in ``days`` that has lost all its rows loses its state. ``days`` are calendar days and are broadcast.
    """
    if days is not None:
        days = W.stage(spark, days.select("date").distinct(), "touched")
        feeds = Feeds(*[getattr(feeds, n).join(F.broadcast(days), "date", "left_semi") for n in Feeds.__dataclass_fields__])
    numbers = number_rooms(spark, root, feeds.booking)
    store(spark, day_states(feeds), f"{root}/day_states", days)
    store(spark, room_bits(feeds.booking, numbers), f"{root}/room_bits", days)


def store(spark: SparkSession, rows: DataFrame, path: str, days: DataFrame | None = None) -> None:
    """Write a few rows per day in month folders; with ``days`` these days' rows are replaced and the others of their months kept."""
    rows = rows.withColumn("month", F.date_format("date", "yyyy-MM"))
    if days is not None and W.path_exists(spark, path):
        months = days.select(F.date_format("date", "yyyy-MM").alias("month")).distinct()
        old = spark.read.schema(rows.schema).parquet(path).join(F.broadcast(months), "month", "left_semi")
        rows = W.stage(spark, rows.unionByName(old.join(F.broadcast(days), "date", "left_anti")), "state")
        for r in months.join(rows, "month", "left_anti").collect():             # touched months without rows
            W.delete_path(spark, f"{path}/month={r.month}")
    W.replace_days(rows, path, "month", full=days is None)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("month")


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """The stored days with the rooms of their month."""
    rooms = rooms_of_month(read_state(spark, f"{root}/room_bits"))
    return read_state(spark, f"{root}/day_states").withColumn("ym", month_of()).join(rooms, "ym", "left").drop("ym")


# --- marts from states ----------------------------------------------------------------------------
def campus_kpis(states: DataFrame) -> DataFrame:
    """G13 from the states of days; the same rows as ``marts.campus_kpis``."""
    d = states.select("date", F.date_format("date", "yyyy-MM").alias("month"), F.col("production_max").cast(MONEY).alias("p"), "production_sum", F.col("consumption").cast(MONEY).alias("c"),
                      F.try_divide("humidity_sum", "humidity_n").alias("h"), F.try_divide("temperature_sum", "temperature_n").alias("t"),
                      F.try_divide(F.try_divide(F.col("booked_sum").cast("double"), "slots"), "rooms_total").alias("r"))
    r = d.rollup("month", "date").agg(F.sum("p").alias("p"), F.sum("production_sum").alias("pi"), F.sum("c").alias("c"), F.avg("h").alias("h"), F.avg("t").alias("t"),
                                      F.avg("r").alias("r"), F.grouping_id().alias("gid"))
    kwh = lambda c: F.round(F.col(c).cast("double") / 1000.0, DIGITS)
    level = F.when(F.col("gid") == 0, "day").when(F.col("gid") == 1, "month").otherwise("all")
    return r.select(level.alias("level"), "month", "date", kwh("p").alias("production_kwh"), kwh("pi").alias("production_sum_inverters_kwh"), kwh("c").alias("consumption_kwh"),
                    F.round("h", DIGITS).alias("humidity_mean"), F.round("t", DIGITS).alias("temperature_mean"), F.round("r", DIGITS).alias("rooms_booked_pct_mean"))


def forecast_accuracy(states: DataFrame) -> DataFrame:
    """G16 from the states of days that have forecasts."""
    x = states.where(F.col("forecasts") > 0).withColumn("month", F.date_format("date", "yyyy-MM"))
    r = x.rollup("month", "date").agg(F.sum("forecasts").alias("n"), F.sum("forecast_error").cast("double").alias("se"), F.sum("forecast_size").cast("double").alias("sm"),
                                      F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "day").when(F.col("gid") == 1, "month").otherwise("all")
    return r.select(level.alias("level"), "month", "date", "n", F.round(F.col("se") / F.col("n"), DIGITS).alias("mae"),
                    F.round((1.0 - F.try_divide("se", "sm")) * 100.0, DIGITS).alias("accuracy_pct"))
