"""Aggregations and distincts.

All of them are ``groupBy`` aggregates, so Spark combines map-side before the
shuffle: a hot key (one day holding a third of the rows) costs one partial
row per map task, never a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

MONEY = "decimal(18,2)"


def exact_sum(c) -> Column:
    """Order-independent sum of 2-decimal values, returned as double."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(MONEY)).cast("double")


def daily_production_total(production: DataFrame, by=("date",)) -> DataFrame:
    """G1: day total = largest ``daysum`` of any inverter (reference keeps max, Q3)."""
    return production.groupBy(*by).agg(F.max("daysum").alias("max_daysum_w"))


def daily_consumption_total(consumption: DataFrame, by=("date",)) -> DataFrame:
    """Day total = sum of ``variation``; of ``value_acquired`` on a day that has no variation at all (Q2).

    ``has_variation`` tells which one a day took, so that its slots can take the same.
    """
    if "variation" not in consumption.columns:
        consumption = consumption.withColumn("variation", F.lit(None).cast("double"))
    day = consumption.groupBy(*by).agg(exact_sum("variation").alias("_v"), exact_sum("value_acquired").alias("_a"), F.count("variation").alias("_n"))
    return day.select(*by, F.when(F.col("_n") > 0, F.col("_v")).otherwise(F.col("_a")).alias("sum_variation_w"), (F.col("_n") > 0).alias("has_variation"))


def running_pct(production: DataFrame, by=("date", "time")) -> DataFrame:
    """Share of inverters with ``pac > 0`` per slot, 0-100; missing pac = stopped."""
    if "pac" not in production.columns:
        return production.select(*by).distinct().withColumn("pct_running", F.lit(0.0))
    return (production.groupBy(*by)
            .agg(F.count_if(F.col("pac") > 0).alias("n_running"), F.count(F.lit(1)).alias("n_readings"))
            .withColumn("pct_running", F.col("n_running").cast("double") / F.col("n_readings") * 100.0))


def hourly_mean(sensor: DataFrame, value: str = "value_acquired", by=("date",)) -> DataFrame:
    """Mean reading per (date, hour of the time text)."""
    return (sensor.withColumn("hour", tx.hour_key("time"))
            .groupBy(*by, "hour").agg(F.avg(value).alias("mean_value")))


def mean_prediction_per_time(weather: DataFrame) -> DataFrame:
    """Mean forecast value per (date, time)."""
    return weather.groupBy("date", "time").agg(F.avg("prediction").alias("mean_prediction"))


def rooms_booked_by_slot(booking: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """G6 + G7: distinct rooms per (date, start) against the rooms of the month (Q5).

    The month total is one row per year-month, joined on the month key: ``totals`` (ym, rooms_total), or counted
    from the bookings, which then must hold whole months. Ratio is 0-1 (Q4) and guarded against an empty catalogue.
    """
    b = booking.withColumn("ym", F.date_trunc("month", F.col("date")).cast("date"))
    booked = b.groupBy("date", "ym", "start_time").agg(F.count_distinct("room_id").alias("rooms_booked"))
    total = totals if totals is not None else b.groupBy("ym").agg(F.count_distinct("room_id").alias("rooms_total"))
    return (booked.join(total, "ym")
            .select("date", "start_time", "rooms_booked", "rooms_total",
                    F.coalesce(F.try_divide(F.col("rooms_booked").cast("double"), F.col("rooms_total").cast("double")),
                               F.lit(0.0)).alias("pct_rooms_booked"),
                    (F.col("rooms_total") - F.col("rooms_booked")).alias("rooms_free")))


def distinct_profiles(sensor: DataFrame) -> DataFrame:
    """Distinct (value, variation) pairs."""
    return sensor.select("value_acquired", "variation").distinct()


def keep_first(df: DataFrame, keys: list[str], order: list[str], cols: list[str] | None = None) -> DataFrame:
    """One row per key, the smallest by ``order`` (then by the other columns).

    Written as ``min(struct(order..., rest...))`` so it is a combinable
    aggregate: a hot key is reduced map-side instead of being sorted whole in
    one task as ``row_number`` would. Ties on ``order`` break on the remaining
    columns, so the pick is deterministic.
    """
    cols = cols or [c for c in df.columns if c not in keys]
    rest = [c for c in cols if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first._o{i}").alias(c) for i, c in enumerate(order) if c in cols],
                         *[F.col(f"_first.{c}") for c in rest])
