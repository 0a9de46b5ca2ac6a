"""Marts over the gold model.

Dashboard measures whose formulas live only in prose are our definitions;
their parameters (tariffs, ratios, class maps) are explicit arguments.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import aggregates as G

DIGITS = 6
# Our own tariff defaults (CHF per kWh); the reference's tariff is not in its tree.
SELL_CHF_PER_KWH = 0.12
BUY_CHF_PER_KWH = 0.25
# Status classes of the inverter dashboard: (class, SQL condition), the first that holds counts.
STATUS_CLASSES = [("Error", "coalesce(error, 0) > 0"), ("Running", "pac > 0"), ("OK-Standby", "true")]


def power_export(power_fact: DataFrame, dim_time: DataFrame, dim_inverter: DataFrame,
                 dim_consumption: DataFrame, dim_errors: DataFrame) -> DataFrame:
    """J11 + B7: flat star export of the power fact (Q14: status and measures from the fact)."""
    f = power_fact.alias("f")
    return (f.join(dim_time.alias("t"), F.col("f.TimeID") == F.col("t.TimeID"), "left")
            .join(dim_inverter.alias("i"), F.col("f.InverterKey") == F.col("i.InverterKey"), "left")
            .join(dim_consumption.alias("c"), F.col("f.ConsumptionID") == F.col("c.ConsumptionID"), "left")
            .join(dim_errors.alias("e"), F.col("f.ErrorID") == F.col("e.ErrorID"), "left")
            .select("f.FactID", "f.partition_date", "f.Prod_vs_Consumption_Diff", "f.Total_Production_End_of_Day",
                    "f.Total_Consumption_End_of_day", "f.Pct_Inverters_Running",
                    "t.Year", "t.Month", "t.Day", "t.Hour",
                    F.col("i.InverterID").alias("Inverter_Business_Key"), F.col("f.Status").alias("Inverter_Status"),
                    "f.PAC", "f.Daysum",
                    F.col("c.Value").alias("Consumption_Value"), F.col("c.Variation").alias("Consumption_Variation"),
                    "e.Error_info"))


def _full(frames: list[DataFrame], key: str = "date") -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full")
    return out


def daily_kpis(production: DataFrame, consumption: DataFrame, humidity: DataFrame,
               temperature: DataFrame, booking: DataFrame) -> DataFrame:
    """G13 per day (W kept exact in decimal until the final kWh)."""
    prod = G.daily_production_total(production)
    per_inv = (production.groupBy("date", "inv_id").agg(F.max("daysum").alias("m"))
               .groupBy("date").agg(G.exact_sum("m").alias("sum_inv_max_w")))
    cons = G.daily_consumption_total(consumption)
    hum = humidity.groupBy("date").agg(F.avg("value_acquired").alias("humidity_mean"))
    tmp = temperature.groupBy("date").agg(F.avg("value_acquired").alias("temperature_mean"))
    rooms = (G.rooms_booked_by_slot(booking).groupBy("date")
             .agg(F.avg("pct_rooms_booked").alias("rooms_booked_pct_mean")))
    return _full([prod.join(per_inv, "date"), cons, hum, tmp, rooms])


def campus_kpis(production, consumption, humidity, temperature, booking) -> DataFrame:
    """Day rows plus month and overall rows (``rollup(month, date)``).

    Month/overall totals sum the day totals; means are means of day means.
    The rollup runs on one row per day, so it is tiny whatever the input.
    """
    day = daily_kpis(production, consumption, humidity, temperature, booking).withColumn(
        "month", F.date_format("date", "yyyy-MM"))
    r = day.rollup("month", "date").agg(
        F.sum(F.col("max_daysum_w").cast("decimal(18,2)")).alias("p"),
        F.sum(F.col("sum_inv_max_w").cast("decimal(18,2)")).alias("pi"),
        F.sum(F.col("sum_variation_w").cast("decimal(18,2)")).alias("c"),
        F.avg("humidity_mean").alias("h"), F.avg("temperature_mean").alias("t"),
        F.avg("rooms_booked_pct_mean").alias("r"),
        F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "day").when(F.col("gid") == 1, "month").otherwise("all")
    kwh = lambda c: F.round(F.col(c).cast("double") / 1000.0, DIGITS)
    return r.select(level.alias("level"), "month", "date",
                    kwh("p").alias("production_kwh"), kwh("pi").alias("production_sum_inverters_kwh"),
                    kwh("c").alias("consumption_kwh"),
                    F.round("h", DIGITS).alias("humidity_mean"), F.round("t", DIGITS).alias("temperature_mean"),
                    F.round("r", DIGITS).alias("rooms_booked_pct_mean"))


def energy_value_chf(production: DataFrame, consumption: DataFrame,
                     sell: float = SELL_CHF_PER_KWH, buy: float = BUY_CHF_PER_KWH) -> DataFrame:
    """CHF value of the day's production and consumption at given tariffs.

    Money is exact: W (2 decimals) times the tariff per W in decimal, so no
    half-way rounding differs between engines.
    """
    d = _full([G.daily_production_total(production), G.daily_consumption_total(consumption)])
    pw = F.coalesce(F.col("max_daysum_w"), F.lit(0.0)).cast("decimal(18,2)")
    cw = F.coalesce(F.col("sum_variation_w"), F.lit(0.0)).cast("decimal(18,2)")
    per_w = lambda chf_per_kwh: F.lit(Decimal(str(chf_per_kwh)) / 1000).cast("decimal(12,9)")
    p_chf, c_chf = pw * per_w(sell), cw * per_w(buy)
    return d.select("date", F.round(pw.cast("double") / 1000.0, DIGITS).alias("production_kwh"),
                    F.round(cw.cast("double") / 1000.0, DIGITS).alias("consumption_kwh"),
                    p_chf.cast("double").alias("production_chf"), c_chf.cast("double").alias("consumption_chf"),
                    (p_chf - c_chf).cast("double").alias("net_chf"))


def production_vs_climate(production: DataFrame, humidity: DataFrame, temperature: DataFrame) -> DataFrame:
    """Daily production with the day's mean temperature and humidity."""
    prod = G.daily_production_total(production)
    hum = humidity.groupBy("date").agg(F.avg("value_acquired").alias("h"))
    tmp = temperature.groupBy("date").agg(F.avg("value_acquired").alias("t"))
    return (prod.join(tmp, "date", "left").join(hum, "date", "left")
            .select("date", F.round(F.col("max_daysum_w") / 1000.0, DIGITS).alias("production_kwh"),
                    F.round("t", DIGITS).alias("temperature_mean"), F.round("h", DIGITS).alias("humidity_mean")))


def forecast_accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE and accuracy % by day, month and overall (our definition).

    accuracy = 100 * (1 - sum|a - p| / sum|a|); sums in decimal (2-decimal inputs).
    """
    x = df.withColumns({"month": F.date_format("date", "yyyy-MM"),
                        "err": F.abs(F.col(actual) - F.col(predicted)).cast("decimal(18,2)"),
                        "mag": F.abs(F.col(actual)).cast("decimal(18,2)")})
    r = x.rollup("month", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("err").alias("se"),
                                      F.sum("mag").alias("sm"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "day").when(F.col("gid") == 1, "month").otherwise("all")
    se, sm = F.col("se").cast("double"), F.col("sm").cast("double")
    return r.select(level.alias("level"), "month", "date", "n",
                    F.round(se / F.col("n"), DIGITS).alias("mae"),
                    F.round((1.0 - F.try_divide(se, sm)) * 100.0, DIGITS).alias("accuracy_pct"))


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame, keys=("date", "time")) -> DataFrame:
    """Actual and predicted series side by side (full outer on the slot)."""
    return actual.join(predicted, list(keys), "full")


def status_class(classes: list[tuple[str, str]] = STATUS_CLASSES):
    out = None
    for name, condition in classes:
        out = F.when(F.expr(condition), F.lit(name)) if out is None else out.when(F.expr(condition), F.lit(name))
    return out


def status_counts(production: DataFrame, classes: list[tuple[str, str]] = STATUS_CLASSES) -> DataFrame:
    """Readings per inverter and status class (the class map is a parameter; pivot with an explicit value list)."""
    names = [c for c, _ in classes]
    wide = production.withColumn("cls", status_class(classes)).groupBy("inv_id").pivot("cls", names).count()
    return wide.select("inv_id", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(
        "n_" + c.lower().replace("-", "_")) for c in names])


def error_counts(production: DataFrame) -> DataFrame:
    """Readings per inverter and error code, with the error label."""
    return (production.groupBy("inv_id", "error").agg(F.count(F.lit(1)).alias("n_readings"))
            .withColumn("error_info", tx.error_label("error")))


def reservations_share(booking: DataFrame, dims=("activity_type", "department", "instructor")) -> DataFrame:
    """Bookings per activity / department / instructor, count and % of all bookings.

    One pass with grouping sets; the total per breakdown is an aggregate of
    the grouped rows joined back on the breakdown name (no window, so a
    breakdown with many values is never one task).
    """
    g = booking.groupingSets([[c] for c in dims], *dims).agg(
        F.count(F.lit(1)).alias("n_bookings"), F.grouping_id().alias("gid"))
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    n = len(dims)
    for i, c in enumerate(dims):
        mask = (1 << n) - 1 - (1 << (n - 1 - i))
        name = F.when(F.col("gid") == mask, F.lit(c)).otherwise(name)
        value = F.when(F.col("gid") == mask, F.col(c).cast("string")).otherwise(value)
    g = g.select(name.alias("breakdown"), value.alias("value"), "n_bookings")
    totals = g.groupBy("breakdown").agg(F.sum("n_bookings").alias("_total"))  # one row per breakdown
    return (g.join(totals, "breakdown")
            .withColumn("pct", F.round(F.col("n_bookings") * 100.0 / F.col("_total"), DIGITS)).drop("_total"))


def booking_hours(booking: DataFrame) -> DataFrame:
    """Hours a booking touches: from its start's hour up to its end, a begun hour counts; bookings without a start are left out."""
    t = tx.normalize_time("end_time", bare_hour=True)
    s, e = tx.hour_num(F.col("start_time")), tx.hour_num(F.col("end_time"))
    begun = F.coalesce(F.substring(t, 4, 5) > "00:00", F.lit(False)).cast("int")
    b = booking.where(F.coalesce(F.trim("start_time"), F.lit("")) != "")
    return b.withColumns({"start_hour": s, "end_hour": F.greatest(e + begun, s + 1)})


def room_date_heatmap(booking: DataFrame) -> DataFrame:
    """G20 (long form): bookings and booked hours per room and date."""
    b = booking_hours(booking)
    return b.groupBy("room_id", "date").agg(F.count(F.lit(1)).alias("n_bookings"),
                                            F.sum(F.col("end_hour") - F.col("start_hour")).cast("long").alias("booked_hours"))


def room_month_matrix(booking: DataFrame) -> DataFrame:
    """G20 as a matrix: a row per room and month with an array of 31 places, the booked hours of each day (0: none, null: no such day).

    The width is the calendar's, so nothing is pivoted and the columns do not depend on the data.
    """
    day = room_date_heatmap(booking).withColumn("month", F.date_trunc("month", F.col("date")).cast("date"))
    g = day.groupBy("room_id", "month").agg(F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("date"), "booked_hours"))).alias("m"),    # at most 31
                                            F.sum("booked_hours").alias("total_hours"))
    place = lambda d: F.when(d <= F.dayofmonth(F.last_day("month")), F.coalesce(F.try_element_at("m", d), F.lit(0).cast("long")))
    return g.select("room_id", F.date_format("month", "yyyy-MM").alias("month"), F.transform(F.sequence(F.lit(1), F.lit(31)), place).alias("hours"), "total_hours")


def room_hour_timeline(booking: DataFrame) -> DataFrame:
    """A booking covers every hour from its start up to (excluding) its end."""
    b = booking_hours(booking)
    h = b.select("date", "room_id", F.explode(F.sequence("start_hour", F.col("end_hour") - 1)).alias("hour"))
    return h.groupBy("date", "hour", "room_id").agg(F.count(F.lit(1)).alias("n_bookings"))


def rooms_secure_view(booking: DataFrame, role: str, school: str | None) -> DataFrame:
    from ..operators.filters import secure_view
    return secure_view(booking, "rooms", role, school)


