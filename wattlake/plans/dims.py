"""Gold dimensions.

Each dimension is ``distinct`` (or keep-first) over a silver feed followed by
the surrogate key. Ids depend only on natural keys, so facts recompute them
with the same helper instead of joining the dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as tx
from ..operators import aggregates as G
from ..operators import reshape as R

TIME_PATTERN = r"^[0-9]{2}:[0-9]{2}:[0-9]{2}$"


def ktext(df: DataFrame, col: str):
    """Key text of a column, using its type (doubles print like Python)."""
    return K.key_text(col, df.schema[col].dataType)


def valid_time(t) -> F.Column:
    return t.rlike(TIME_PATTERN)


def time_id_or_empty(date_col, t) -> F.Column:
    """TimeID when the time text is a valid ``HH:MM:SS``, else '' (unmatched lookup)."""
    return F.when(F.col(date_col).isNotNull() & valid_time(t), K.time_id(date_col, t)).otherwise(F.lit(""))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add absent columns as typed literals."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def collect_times(production=None, consumption=None, humidity=None, temperature=None,
                  weather=None, booking=None) -> DataFrame:
    """E3 over the six feeds: every (date, time) any feed mentions."""
    frames = [(df, col) for df, col in [(booking, "start_time"), (consumption, "time"), (humidity, "time"),
                                        (temperature, "time"), (production, "time"), (weather, "time")]
              if df is not None]
    return R.distinct_timestamps(frames)


def dim_time(times: DataFrame) -> DataFrame:
    """DimTime(TimeID, Year, Month, Day, Hour, Minute, Second) from (date, HH:MM:SS)."""
    t = times.where(valid_time(F.col("time"))).select("date", "time").distinct()
    part = lambda i: F.split_part(F.col("time"), F.lit(":"), F.lit(i)).try_cast("int")
    return t.select(K.time_id("date", "time").alias("TimeID"),
                    F.year("date").alias("Year"), F.month("date").alias("Month"), F.dayofmonth("date").alias("Day"),
                    part(1).alias("Hour"), part(2).alias("Minute"), part(3).alias("Second"))


def dim_room(booking: DataFrame) -> DataFrame:
    """One row per room id; the id is md5 of the raw room text."""
    r = booking.where(F.col("room_id").isNotNull()).select(F.col("room_id").cast("string").alias("room_id")).distinct()
    return r.select(F.md5("room_id").alias("RoomID"), F.col("room_id").alias("Alt_RoomID"),
                    F.col("room_id").alias("FullName"), F.col("room_id").alias("Alt_FullName"))


def reservation_id(df: DataFrame):
    return K.surrogate_key("res", ktext(df, "reservation_id"), F.coalesce(F.col("start_time").cast("string"), F.lit("")))


def dim_reservation(booking: DataFrame) -> DataFrame:
    """First booking per (reservation_id, start_time); earliest date wins (Q7).

    Timestamps use each row's own date (Q7/Q9 fix).
    """
    b = with_defaults(booking, {c: "" for c in ["reservation_code", "activity_type", "class", "department",
                                                "instructor", "reserved_by", "end_time"]})
    cols = ["date", "end_time", "reservation_code", "activity_type", "class", "department", "instructor", "reserved_by"]
    first = G.keep_first(b.where(F.col("reservation_id").isNotNull()), ["reservation_id", "start_time"],
                         ["date"], cols)
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return first.select(reservation_id(first).alias("ReservationID"),
                        tx.date_time_ts("date", "start_time").alias("Start_time"),
                        tx.date_time_ts("date", "end_time").alias("End_time"),
                        s("reservation_code").alias("List_Item"), s("activity_type").alias("Activity"),
                        s("class").alias("Class"), s("department").alias("Department"),
                        s("instructor").alias("Professor"), s("reserved_by").alias("ReservedBy"))


PROFILE_PREFIX = {"consumption": ("cons_profile", "ConsumptionID"),
                  "humidity": ("hum_lvl", "HumidityID"),
                  "temperature": ("temp_lvl", "TempID")}


def profile_id(df: DataFrame, prefix: str):
    return K.surrogate_key(prefix, ktext(df, "value_acquired"), ktext(df, "variation"))


def dim_profile(sensor: DataFrame, kind: str) -> DataFrame:
    """DimConsumption / DimHumidity / DimTemp from distinct (value, variation)."""
    prefix, id_col = PROFILE_PREFIX[kind]
    d = G.distinct_profiles(sensor)
    return d.select(profile_id(d, prefix).alias(id_col), F.col("value_acquired").alias("Value"),
                    F.col("variation").alias("Variation"))


def inverter_key(df: DataFrame):
    return K.surrogate_key("inv", ktext(df, "inv_id"))


def dim_inverter(production: DataFrame) -> DataFrame:
    """One row per inverter; NULL ids are left out (Q22)."""
    d = production.where(F.col("inv_id").isNotNull()).select("inv_id").distinct()
    return d.select(inverter_key(d).alias("InverterKey"), F.col("inv_id").cast("int").alias("InverterID"))


def error_text(df: DataFrame):
    if "error" not in df.columns:
        return F.lit("0")
    return ktext(df, "error")


def error_id(df: DataFrame):
    return K.surrogate_key("err", error_text(df))


def dim_errors(production: DataFrame) -> DataFrame:
    """One row per error code; code 0 / missing reads 'No Error' (Q6: numeric test)."""
    p = with_defaults(production, {"error": "0"})
    d = p.select("error").distinct()
    return d.select(error_id(d).alias("ErrorID"), tx.error_label("error").alias("Error_info")).distinct()


def forecast_id(df: DataFrame):
    return K.surrogate_key("fc_def", K.key_text("site"), K.key_text("measurement"))


def dim_forecast(weather: DataFrame) -> DataFrame:
    """One row per (site, measurement); several units -> smallest unit text (Q11)."""
    d = G.keep_first(weather.select("site", "measurement", "unit"), ["site", "measurement"], ["unit"])
    return d.select(forecast_id(d).alias("ForecastID"), F.col("site").cast("string").alias("Site"),
                    F.col("measurement").cast("string").alias("Measurement"), F.col("unit").cast("string").alias("Unit"))


def cons_prediction_id(date_col, t):
    return K.surrogate_key("cpred", tx.date_iso(date_col), t)


def dim_consumption_prediction(consumption: DataFrame) -> DataFrame:
    """One id per consumption (date, slot)."""
    t = tx.normalize_time("time")
    return consumption.select(cons_prediction_id("date", t).alias("Cons_PredictionID")).distinct()


PREDICTION_KINDS = {"pac": ("ppred_pac", "pred_sum_pac", "sum_pac"),
                    "daysum": ("ppred_daysum", "pred_daysum", "daysum")}


def dim_production_prediction(weather: DataFrame, kind: str) -> DataFrame:
    """Mean forecast per (date, slot) with the hour; actuals are 0 placeholders (Q24)."""
    prefix, pred_col, actual_col = PREDICTION_KINDS[kind]
    g = (weather.withColumn("time", tx.normalize_time("time"))
         .groupBy("date", "time").agg(F.round(F.avg("prediction"), 6).alias("mean_prediction")))
    return g.select(K.surrogate_key(prefix, tx.date_iso("date"), F.col("time")).alias("Prod_PredictionID"),
                    F.col("date").alias("pred_date"), tx.hour_num("time").alias("pred_hour"),
                    F.col("mean_prediction").alias(pred_col), F.lit(0.0).alias(actual_col))
