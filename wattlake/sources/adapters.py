"""Silver-shaped feeds derived from the driver's test tables.

The campus files are not available to tests, so the six silver feeds are
derived from ``events`` / ``orders`` / ``customer`` with plain DataFrame
plans (the same definitions the DuckDB oracle uses as CTEs). Sums go through
``decimal(18,2)`` so they are exact and order independent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slot_time(ts: Column) -> Column:
    """``HH:MM:00`` of the 15-minute slot that contains ``ts``."""
    return F.concat(F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((F.minute(ts) - F.minute(ts) % 15).cast("string"), 2, "0"), F.lit(":00"))


def _slotted(events: DataFrame) -> DataFrame:
    return events.withColumns({"date": F.to_date("ts"), "time": slot_time(F.col("ts"))})


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverter readings per (date, 15-min slot, inverter); ``daysum`` = running W of the day."""
    ev = _slotted(table(spark, sf_dir, "events"))
    is_err = F.col("event_type") == "error"
    g = (ev.withColumn("inv_id", (F.col("user_id") % 5 + 1).cast("int"))
         .groupBy("date", "time", "inv_id")
         .agg(F.sum(F.when(is_err, F.lit(0).cast(MONEY)).otherwise(F.col("value").cast(MONEY))).alias("pac"),
              F.max("event_type").alias("status"),
              F.max(F.when(is_err, (F.col("user_id") % 3).cast("int") + 1).otherwise(F.lit(0))).alias("error")))
    # the running sum is per (date, inverter): at most 96 slots per group
    w = Window.partitionBy("date", "inv_id").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("date", "time", "inv_id", F.col("pac").cast("double").alias("pac"),
                    F.sum("pac").over(w).cast("double").alias("daysum"), "status", "error")


def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter per slot: ``variation`` = slot energy, ``value_acquired`` = meter reading.

    The meter reading is a running sum over all time. It is computed as a
    two-level prefix sum so no single task sees every row: a running sum
    inside each day (partitioned by date) plus the total of all earlier days
    (a window over one row per day).
    """
    ev = _slotted(table(spark, sf_dir, "events"))
    g = ev.groupBy("date", "time").agg(F.sum(F.col("value").cast(MONEY)).alias("v"))
    days = g.groupBy("date").agg(F.sum("v").alias("day_v"))
    before = days.select("date", (F.sum("day_v").over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
                                  - F.col("day_v")).alias("offset"))
    w = Window.partitionBy("date").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    return (g.join(before, "date")
            .select("date", "time", F.lit("kWh").alias("unit"),
                    (F.sum("v").over(w) + F.col("offset")).cast("double").alias("value_acquired"),
                    F.col("v").cast("double").alias("variation")))


def _sensor(spark, sf_dir, event_type: str, unit: str) -> DataFrame:
    ev = _slotted(table(spark, sf_dir, "events")).where(F.col("event_type") == event_type)
    return ev.select("date", "time", F.lit(unit).alias("unit"), F.col("value").alias("value_acquired"),
                     (F.col("user_id") % 7).cast("double").alias("variation"))


def humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, "view", "%")


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, "click", "C")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast rows; ``issued`` orders the issues of one slot (unique)."""
    ev = _slotted(table(spark, sf_dir, "events")).where(F.col("event_type").isin("signup", "purchase"))
    return ev.select("date", "time", "value",
                     (F.col("value") + (F.col("user_id") % 4).cast("double")).alias("prediction"),
                     F.concat(F.lit("site"), (F.col("user_id") % 3).cast("string")).alias("site"),
                     F.col("event_type").alias("measurement"),
                     F.when(F.col("event_type") == "signup", F.lit("W/m2")).otherwise(F.lit("C")).alias("unit"),
                     F.col("event_id").alias("issued"))


def booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.to_date("o_orderdate").alias("date"),
                    F.concat(F.lit("R"), F.lpad((F.col("o_custkey") % 60).cast("string"), 3, "0")).alias("room_id"),
                    F.concat(F.lpad((7 + k % 11).cast("string"), 2, "0"), F.lit(":00")).alias("start_time"),
                    F.concat(F.lpad((8 + k % 11 + k % 3).cast("string"), 2, "0"), F.lit(":00")).alias("end_time"),
                    k.alias("reservation_id"), F.col("o_orderpriority").alias("activity_type"),
                    F.col("o_orderstatus").alias("department"), F.col("c_name").alias("reserved_by"),
                    F.col("c_mktsegment").alias("class")))


@dataclass
class Feeds:
    """The six silver feeds a gold run reads."""

    production: DataFrame
    consumption: DataFrame
    humidity: DataFrame
    temperature: DataFrame
    weather: DataFrame
    booking: DataFrame


def booking_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bookings moved into the days of the energy feeds (2024-01-01 on, 45 days), for plans that join both."""
    return booking(spark, sf_dir).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("reservation_id") % 45).cast("int")))


def feeds(spark: SparkSession, sf_dir: str, materialize: bool = False, energy_bookings: bool = False) -> Feeds:
    """The six feeds; ``materialize`` writes each once as a table in the shared folder.

    Materialising stands in for reading a silver lake: plans that use every
    feed several times (the whole gold build) then read the columns they need instead of
    re-deriving them from ``events``. The six writes are independent jobs, submitted together from
    driver threads so the scheduler runs their stages side by side.
    """
    fs = [production(spark, sf_dir), consumption(spark, sf_dir), humidity(spark, sf_dir),
          temperature(spark, sf_dir), weather(spark, sf_dir),
          booking_energy(spark, sf_dir) if energy_bookings else booking(spark, sf_dir)]
    if materialize:
        from concurrent.futures import ThreadPoolExecutor

        from ..session import shared_dir
        from ..sinks.writers import stage
        shared_dir(spark)
        with ThreadPoolExecutor(max_workers=len(fs)) as pool:
            fs = list(pool.map(lambda f: stage(spark, f, "feed"), fs))
    return Feeds(*fs)
