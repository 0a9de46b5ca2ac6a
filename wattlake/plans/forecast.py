"""Forecast of production and consumption (L20) with MLlib random forests.

The reference's feature list is not in its tree; ours: hour of day, day of
week, the hour's mean humidity and temperature, the day's mean share of rooms booked, and the hour's mean
weather forecast (latest issues). Training rows are hourly aggregates (24 per day), so the model
input grows with the number of days, not with the raw rows. Production is
trained on the last ``prod_days`` days, consumption on all days, and both
score every hour of the day after the last observed day. The weather forecast of that day is its own;
its humidity, temperature and rooms are the last day's hourly values (persistence), as they are not known yet.
Predictions go into the prediction fact by day replace; their accuracy is measured against the
hours that were observed later.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as tx
from ..operators import aggregates as G
from ..operators.windows import most_recent
from . import dims as D

FEATURES = ["hour", "weekday", "humidity", "temperature", "rooms_booked", "forecast"]
DIGITS = 6


def hourly_frame(production: DataFrame, consumption: DataFrame, humidity: DataFrame, temperature: DataFrame,
                 booking: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """(date, hour) rows with the two targets (kWh) and the features."""
    hour = tx.hour_num("time")
    prod = (production.withColumn("hour", hour).groupBy("date", "hour")
            .agg((G.exact_sum("pac") / 1000.0).alias("production_kwh")))
    cons = (consumption.withColumn("hour", hour).groupBy("date", "hour")
            .agg((G.exact_sum("variation") / 1000.0).alias("consumption_kwh")))
    hum = humidity.withColumn("hour", hour).groupBy("date", "hour").agg(F.round(F.avg("value_acquired"), DIGITS).alias("humidity"))
    tmp = temperature.withColumn("hour", hour).groupBy("date", "hour").agg(F.round(F.avg("value_acquired"), DIGITS).alias("temperature"))
    rooms = G.rooms_booked_by_slot(booking).groupBy("date").agg(F.round(F.avg("pct_rooms_booked"), DIGITS).alias("rooms_booked"))
    f = (cons.join(prod, ["date", "hour"], "full").join(hum, ["date", "hour"], "left")
         .join(tmp, ["date", "hour"], "left").join(rooms, "date", "left"))
    f = (f.join(hourly_forecast(weather), ["date", "hour"], "left") if weather is not None
         else f.withColumn("forecast", F.lit(0.0)))
    return f.withColumn("weekday", F.dayofweek("date")).fillna(0.0, subset=["humidity", "temperature", "rooms_booked", "forecast",
                                                                           "production_kwh", "consumption_kwh"])


def hourly_forecast(weather: DataFrame) -> DataFrame:
    """Mean prediction of the latest issues of each hour."""
    last = most_recent(weather.select("date", "time", "site", "measurement", "issued", "prediction"), ["date", "time", "site", "measurement"])
    return (last.withColumn("hour", tx.hour_num("time")).groupBy("date", "hour")
            .agg(F.round(F.avg("prediction"), DIGITS).alias("forecast")))


def next_day_features(frame: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """Rows to score: every hour of the day after the last day, with that day's weather forecast and the hour's last-day features."""
    last = frame.agg(F.max("date").alias("last"))
    grid = last.select(F.date_add("last", 1).alias("date"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"),
                       "last")
    feats = frame.select(F.col("date").alias("last"), "hour", "humidity", "temperature", "rooms_booked")
    out = grid.join(feats, ["last", "hour"], "left").drop("last")
    out = (out.join(hourly_forecast(weather), ["date", "hour"], "left") if weather is not None
           else out.withColumn("forecast", F.lit(0.0)))
    return out.withColumn("weekday", F.dayofweek("date")).fillna(0.0, subset=["humidity", "temperature", "rooms_booked", "forecast"])


def persistence(frame: DataFrame) -> DataFrame:
    """Baseline: each hour predicted as the same hour of the day before (days without one are left out)."""
    before = frame.select(F.date_add("date", 1).alias("date"), "hour", F.col("production_kwh").alias("predicted_production_kwh"),
                          F.col("consumption_kwh").alias("predicted_consumption_kwh"))
    return frame.select("date", "hour", "production_kwh", "consumption_kwh").join(before, ["date", "hour"])


def accuracy(compared: DataFrame) -> DataFrame:
    """J14/G16 on energy: MAE and accuracy % of production and consumption by day, month and overall."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.round(F.col(f"{k}_kwh"), 2).alias("actual"),
                               F.round(F.col(f"predicted_{k}_kwh"), 2).alias("predicted")) for k in ("production", "consumption")])
    x = compared.select("date", F.inline(kinds)).withColumns({
        "month": F.date_format("date", "yyyy-MM"), "err": F.abs(F.col("actual") - F.col("predicted")).cast("decimal(18,2)"),
        "mag": F.abs("actual").cast("decimal(18,2)")})
    r = x.groupingSets([["kind", "month", "date"], ["kind", "month"], ["kind"]], "kind", "month", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("err").alias("se"), F.sum("mag").alias("sm"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "day").when(F.col("gid") == 1, "month").otherwise("all")
    se, sm = F.col("se").cast("double"), F.col("sm").cast("double")
    return r.select("kind", level.alias("level"), "month", "date", "n", F.round(se / F.col("n"), DIGITS).alias("mae"),
                    F.round((1.0 - F.try_divide(se, sm)) * 100.0, DIGITS).alias("accuracy_pct"))


def prediction_rows(pred: DataFrame) -> DataFrame:
    """Forecast rows of the prediction fact: one per hour, ids from the slot as in L12, L13 and L17."""
    slot = F.concat(F.lpad(F.col("pred_hour").cast("string"), 2, "0"), F.lit(":00:00"))
    p = pred.withColumn("t", slot)
    key = lambda prefix: K.surrogate_key(prefix, tx.date_iso("pred_date"), F.col("t"))
    return p.select(
        key("predf").alias("FactID"), K.time_id("pred_date", F.col("t")).alias("TimeID"),
        D.cons_prediction_id("pred_date", F.col("t")).alias("Cons_PredictionID"),
        key(D.PREDICTION_KINDS["pac"][0]).alias("Prod_PredictionIDPac"), key(D.PREDICTION_KINDS["daysum"][0]).alias("Prod_PredictionIDDaysum"),
        (F.col("predicted_production_kwh") * 1000.0).alias("Predicted_ProductionPac"),
        (F.sum("predicted_production_kwh").over(Window.partitionBy("pred_date").orderBy("pred_hour")) * 1000.0).alias("Predicted_ProductionDaysum"),
        (F.col("predicted_consumption_kwh") * 1000.0).alias("Predicted_Consumption"), F.col("pred_date").alias("partition_date"))


def _fit_predict(train: DataFrame, score: DataFrame, label: str, seed: int, trees: int, depth: int) -> DataFrame:
    va = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol=f"pred_{label}",
                               numTrees=trees, maxDepth=depth, seed=seed)
    model = rf.fit(va.transform(train))
    return model.transform(va.transform(score)).select("date", "hour", f"pred_{label}")


def forecast_next_day(production, consumption, humidity, temperature, booking, weather=None, prod_days: int = 7,
                      trees: int = 20, depth: int = 6, seed: int = 42, stage: bool = True) -> DataFrame:
    """Predicted production and consumption (kWh) per hour of the next day."""
    frame = hourly_frame(production, consumption, humidity, temperature, booking, weather)
    if stage:
        # the forest scans its input once per tree level: cut the lineage with a table in the shared folder
        from ..sinks.writers import stage as write_stage
        frame = write_stage(frame.sparkSession, frame, "forecast-hourly")
    last = frame.agg(F.max("date")).scalar()  # scalar subquery, evaluated once
    recent = frame.where(F.col("date") > F.date_sub(last, prod_days))
    score = next_day_features(frame, weather)
    p = _fit_predict(recent, score, "production_kwh", seed, trees, depth)
    c = _fit_predict(frame, score, "consumption_kwh", seed, trees, depth)
    return p.join(c, ["date", "hour"]).select(
        F.col("date").alias("pred_date"), F.col("hour").alias("pred_hour"),
        F.round("pred_production_kwh", 6).alias("predicted_production_kwh"),
        F.round("pred_consumption_kwh", 6).alias("predicted_consumption_kwh"))
