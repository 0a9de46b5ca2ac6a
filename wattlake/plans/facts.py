"""Gold facts.

Every fact is keyed by ``date`` for all dates at once. Per-slot and per-day
statistics are ``groupBy`` aggregates (one row per slot / day) joined back on
their key (day statistics are first attached to the per-slot table, so fact
rows go through one join): the aggregates combine map-side, and AQE broadcasts them at run
time while they stay under the broadcast threshold, falling back to a
sort-merge join when they do not. Booking slots can hold any number of rows, so the rooms
fact joins its per-slot table with a deterministic salt. Dimension ids are recomputed from natural keys, never
looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as tx
from ..operators import aggregates as G
from ..operators.joins import salted_join
from ..operators.windows import most_recent
from ..sinks.writers import store_bucketed
from . import dims as D

MEAN_DIGITS = 6


def store_slots(production: DataFrame, consumption: DataFrame, root: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """J1-J5 layout: both feeds in the same buckets of (date, ``t``), ``t`` being the normalised time of the slot."""
    stored = [store_bucketed(df.withColumn("t", tx.normalize_time("time")), ["date", "t"], f"{root}/{n}", buckets=buckets)
              for n, df in (("production_slots", production), ("consumption_slots", consumption))]
    return stored[0], stored[1]


def power_fact(production: DataFrame, consumption: DataFrame) -> DataFrame:
    """One row per inverter reading, with the slot's consumption and day totals.

    * consumption of the slot = first consumption row of (date, time) by
      (value_acquired, variation) (J4, Q8); ConsumptionID is that row's
      profile id (Q1 fix), '' when the slot has no consumption;
    * day totals: max ``daysum`` (G1) and sum of ``variation`` (G2), in kW;
    * share of inverters running in the slot (G3).

    Feeds from ``store_slots`` bring their slot ``t`` and lie in buckets of (date, t): the slot statistics and both joins
    then need no exchange. The day totals, one row per calendar day, are broadcast.
    """
    p = D.with_defaults(production, {"status": None, "daysum": 0.0, "pdc1": 0.0, "pdc2": 0.0,
                                     "udc1": 0.0, "udc2": 0.0})
    slotted = lambda df: df if "t" in df.columns else df.withColumn("t", tx.normalize_time("time"))
    p, c = slotted(p), slotted(consumption)

    slot_cons = G.keep_first(c, ["date", "t"], ["value_acquired", "variation"], ["value_acquired", "variation"])
    slot_cons = slot_cons.select("date", "t", "value_acquired", "variation",
                                 D.profile_id(slot_cons, "cons_profile").alias("cons_id"))
    slot_run = G.running_pct(p, by=("date", "t")).select("date", "t", "pct_running")
    day = (G.daily_production_total(p).join(G.daily_consumption_total(c), "date", "left"))
    # day totals ride on the per-slot table (small joins small), so the fact rows meet one table:
    # every reading's slot is in ``slot_run``, hence every reading gets its day's totals
    slot = slot_run.join(slot_cons, ["date", "t"], "left").join(F.broadcast(day), "date", "left")

    # a slot holds one row per inverter: no hot key, and the rows share the slot aggregate's partitioning
    f = p.join(slot, ["date", "t"], "left")
    cons_w = F.coalesce(F.when(F.col("has_variation"), F.col("variation")).otherwise(F.col("value_acquired")), F.lit(0.0))
    return f.select(
        K.surrogate_key("pf", tx.date_iso("date"), F.col("t"), D.ktext(f, "inv_id")).alias("FactID"),
        D.time_id_or_empty("date", F.col("t")).alias("TimeID"),
        F.coalesce(F.col("cons_id"), F.lit("")).alias("ConsumptionID"),
        F.when(F.col("inv_id").isNotNull(), D.inverter_key(f)).otherwise(F.lit("")).alias("InverterKey"),
        D.error_id(f).alias("ErrorID"),
        F.coalesce(F.col("status").cast("string"), F.lit("Unknown")).alias("Status"),
        F.col("pac").cast("double").alias("PAC"),
        F.col("daysum").cast("double").alias("Daysum"),
        F.col("pdc1").cast("double").alias("PDC1"), F.col("pdc2").cast("double").alias("PDC2"),
        F.col("udc1").cast("double").alias("UDC1"), F.col("udc2").cast("double").alias("UDC2"),
        tx.balance_kw(F.col("pac"), cons_w).alias("Prod_vs_Consumption_Diff"),
        tx.kw("max_daysum_w").alias("Total_Production_End_of_Day"),
        tx.kw(F.coalesce(F.col("sum_variation_w"), F.lit(0.0))).alias("Total_Consumption_End_of_day"),
        F.coalesce(F.col("pct_running"), F.lit(0.0)).alias("Pct_Inverters_Running"),
        F.col("date").alias("partition_date"))


def hourly_means(sensor: DataFrame, name: str) -> DataFrame:
    """G4 per (date, hour), rounded; feeds without a time column give no rows."""
    if sensor is None or "time" not in sensor.columns:
        return None
    return (G.hourly_mean(sensor).select("date", "hour", F.round("mean_value", MEAN_DIGITS).alias(name)))


def weather_fact(weather: DataFrame, humidity: DataFrame | None, temperature: DataFrame | None) -> DataFrame:
    """One row per (date, slot): the row of the slot's latest issue (W3; ties: the largest site and measurement).

    So ``Most_Recent_Forecast`` is true on every row, as in the reference: superseded issues are not in the fact.
    Humidity/Temp_Today are the hourly means of the slot's hour (J6).
    """
    w = weather.withColumn("t", tx.normalize_time("time"))
    if "issued" not in w.columns:
        w = w.withColumn("issued", F.lit(None).cast("timestamp_ntz"))
    first = most_recent(w.select("date", "t", "issued", "site", "measurement"), ["date", "t"]).withColumn("mr", F.lit(True))
    first = first.withColumn("hour", tx.hour_key("t"))
    for sensor, name in [(humidity, "Humidity_Today"), (temperature, "Temp_Today")]:
        means = hourly_means(sensor, name)
        first = first.join(means, ["date", "hour"], "left") if means is not None else first.withColumn(
            name, F.lit(None).cast("double"))
    return first.select(
        K.surrogate_key("wf", tx.date_iso("date"), F.col("t"), K.key_text("site")).alias("FactID"),
        D.time_id_or_empty("date", F.col("t")).alias("TimeID"),
        D.forecast_id(first).alias("ForecastID"),
        F.col("mr").alias("Most_Recent_Forecast"),
        F.col("Humidity_Today"), F.col("Temp_Today"),
        F.col("date").alias("partition_date"))


def rooms_fact_flagged(booking: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """L16 + D6 in one pass: every booking row with ``_ok`` (has TimeID and RoomID).

    A job that keeps both the fact and the quarantine reads this once (e.g.
    one write, or a projection of the flag) instead of computing the fact
    twice for two filtered halves. With ``totals`` (``states.rooms_of_month``) the bookings may be of single days.
    """
    b = booking.withColumn("t", tx.normalize_time("start_time", bare_hour=True))
    slot = G.rooms_booked_by_slot(booking, totals)
    f = salted_join(b, slot, ["date", "start_time"], "left")
    time_ok = F.col("date").isNotNull() & D.valid_time(F.col("t"))
    room_ok = F.col("room_id").isNotNull() & (F.col("room_id") != "")
    rows = f.select(
        K.surrogate_key("rf", tx.date_iso("date"), F.col("t"), K.key_text("room_id"),
                        D.ktext(f, "reservation_id")).alias("FactID"),
        F.when(time_ok, K.time_id("date", F.col("t"))).alias("TimeID"),
        F.when(room_ok, F.md5(F.col("room_id").cast("string"))).alias("RoomID"),
        F.when(F.col("reservation_id").isNotNull(), D.reservation_id(f)).otherwise(F.lit("")).alias("ReservationID"),
        F.col("pct_rooms_booked").cast("double").alias("Pct_Rooms_Booked"),
        F.col("rooms_free").cast("long").alias("Rooms_Free_Count"),
        F.col("date").alias("partition_date"),
        F.coalesce(time_ok & room_ok, F.lit(False)).alias("_ok"))
    return rows


def rooms_fact_split(booking: DataFrame, totals: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(fact rows, quarantined rows without TimeID or RoomID).

    The split tests cheap validity flags, not the md5 ids: Catalyst pushes
    the predicate down to the scan, and the ids would be recomputed there.
    """
    rows = rooms_fact_flagged(booking, totals)
    return rows.where("_ok").drop("_ok"), rows.where(~F.col("_ok")).drop("_ok")


def rooms_fact(booking: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """One row per booking with the slot's booked share and free rooms."""
    return rooms_fact_split(booking, totals)[0]


def prediction_fact(consumption: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per consumption slot (first row of the slot).

    The day's first production-forecast row (smallest slot) is attached to
    every slot (J10) -- a one-row-per-day aggregate joined on date, not a
    driver scalar. ``Predicted_Consumption`` is the slot's own reading: the
    persistence baseline of the reference (Q23).
    """
    c = consumption.withColumn("t", tx.normalize_time("time"))
    first = G.keep_first(c, ["date", "t"], ["value_acquired", "variation"], ["value_acquired"])
    # both forecast dimensions share the (date, slot) mean; take the day's first slot once
    slot_mean = (weather.withColumn("t", tx.normalize_time("time"))
                 .groupBy("date", "t").agg(F.round(F.avg("prediction"), MEAN_DIGITS).alias("m")))
    day_first = slot_mean.groupBy("date").agg(F.min(F.struct("t", "m")).alias("f"))
    cols = [F.col("date")]
    for kind in ("pac", "daysum"):
        prefix = D.PREDICTION_KINDS[kind][0]
        cols += [K.surrogate_key(prefix, tx.date_iso("date"), F.col("f.t")).alias(f"id_{kind}"),
                 F.col("f.m").alias(f"val_{kind}")]
    f = first.join(day_first.select(*cols), "date", "left")
    return f.select(
        K.surrogate_key("predf", tx.date_iso("date"), F.col("t")).alias("FactID"),
        D.time_id_or_empty("date", F.col("t")).alias("TimeID"),
        D.cons_prediction_id("date", F.col("t")).alias("Cons_PredictionID"),
        F.coalesce(F.col("id_pac"), F.lit("")).alias("Prod_PredictionIDPac"),
        F.coalesce(F.col("id_daysum"), F.lit("")).alias("Prod_PredictionIDDaysum"),
        F.col("val_pac").alias("Predicted_ProductionPac"),
        F.col("val_daysum").alias("Predicted_ProductionDaysum"),
        F.col("value_acquired").alias("Predicted_Consumption"),
        F.col("date").alias("partition_date"))
