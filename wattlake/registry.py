"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the driver's test tables through the silver-feed adapters
(whole tables, no sampling) and runs one operator or load of the pipeline.
Raw-text queries build source-style text from the table values inside the
plan (``dd.MM.yyyy`` dates, comma decimals, French months, quotes, a few
invalid tokens chosen from the row's own ids) and parse it back.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .operators import aggregates as G
from .operators import filters as FL
from .operators import reshape as R
from .operators import windows as WN
from .plans import backtest as BT
from .plans import dims, facts, gold, marts, quality, run, secure
from .plans import forecast as FC
from .plans import silver as SL
from .plans import states as STA
from .session import apply_runtime_conf, scratch_path, shared_dir
from .sinks import writers as W
from .sources import adapters as A
from .sources import drops as DR
from .sources import raw
from .sources import silver as SV
from .streaming import ingest as ST

QUERIES: dict = {}


def query(fn):
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(spark, sf_dir)
    run_query.__name__ = fn.__name__
    run_query.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run_query
    return run_query


def _events(spark, sf_dir):
    ev = A.table(spark, sf_dir, "events")
    return ev.withColumns({"date": F.to_date("ts"), "time": A.slot_time(F.col("ts"))})


# --- C / D: raw text parsed back ---------------------------------------------------------------

@query
def clean_sensor_text(spark, sf_dir):
    """Humidity readings as sensor-file text (d.M.yyyy / dd.MM.yyyy, comma decimals)."""
    ev = _events(spark, sf_dir).where(F.col("event_type") == "view")
    eid = F.col("event_id")
    raw = ev.select(
        F.when(eid % 23 == 0, F.lit("n/a")).when(eid % 2 == 0, F.date_format("date", "dd.MM.yyyy"))
        .otherwise(F.date_format("date", "d.M.yyyy")).alias("raw_date"),
        F.concat(F.lit(" "), F.col("time"), F.lit("  ")).alias("time_str"), F.lit("%").alias("unit"),
        F.when(eid % 19 == 0, F.lit("x,y")).otherwise(F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")))
        .alias("val_raw"),
        F.replace((F.col("user_id") % 7).cast("double").cast("string"), F.lit("."), F.lit(",")).alias("var_raw"))
    parsed = raw.select(tx.parse_eu_date("raw_date").alias("date"), F.trim("time_str").alias("time"), "unit",
                        tx.eu_decimal("val_raw").alias("value_acquired"), tx.eu_decimal("var_raw").alias("variation"))
    return FL.sensor_quality(parsed)


@query
def parse_inverter_date(spark, sf_dir):
    """Inverter rows as export text (dd.MM.yy, numbers as text, some invalid cells)."""
    p = A.production(spark, sf_dir)
    bad_day = (F.dayofmonth("date") % 10 == 0) & (F.col("inv_id") == 3)
    raw = p.select(F.when(bad_day, F.lit("xx.xx.xx")).otherwise(F.date_format("date", "dd.MM.yy")).alias("raw_date"),
                   "time", F.col("inv_id").cast("string").alias("inv_raw"),
                   F.when(F.col("error") > 0, F.lit("-")).otherwise(F.col("pac").cast("string")).alias("pac_raw"),
                   F.col("daysum").cast("string").alias("daysum_raw"), "status",
                   F.col("error").cast("string").alias("error_raw"))
    out = raw.select(tx.parse_short_date("raw_date").alias("date"), "time",
                     tx.to_double("inv_raw").cast("int").alias("inv_id"), tx.to_double("pac_raw").alias("pac"),
                     tx.to_double("daysum_raw").alias("daysum"), "status", tx.to_double("error_raw").alias("error"))
    return out.where(F.col("date").isNotNull())


OFFSETS = ["Z", "+01:00", "-02:30"]


@query
def parse_iso_utc(spark, sf_dir):
    """Forecast times as ISO text with Z / +01:00 / -02:30 offsets, back to UTC date and time."""
    ev = A.table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase"))
    eid = F.col("event_id")
    off = F.element_at(F.array(*[F.lit(o) for o in OFFSETS]), (eid % 3 + 1).cast("int"))
    raw = ev.select("event_id", F.when(eid % 29 == 0, F.lit("not a time"))
                    .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), off)).alias("time_raw"),
                    F.col("value").cast("string").alias("value_raw"))
    ts = tx.parse_iso_utc("time_raw")
    out = raw.select("event_id", ts.alias("ts"), tx.to_double("value_raw").alias("value")).where(F.col("ts").isNotNull())
    return out.select("event_id", F.to_date("ts").alias("date"), tx.ts_time("ts").alias("time"), "value")


@query
def french_date(spark, sf_dir):
    """Booking dates as '05 janv. 2023' text; unparseable -> 1900-01-01."""
    b = A.booking(spark, sf_dir)
    tok = F.element_at(F.array(*[F.lit(fr) for fr, _ in tx.FRENCH_MONTHS]), F.month("date"))
    raw = F.when(F.col("reservation_id") % 31 == 0, F.lit("?? ??? ????")).otherwise(
        F.concat_ws(" ", F.lpad(F.dayofmonth("date").cast("string"), 2, "0"), tok, F.year("date").cast("string")))
    return b.select("reservation_id", raw.alias("raw_date")).select(
        "reservation_id", "raw_date", tx.french_date("raw_date").alias("date"))


def _messy(c, k):
    """Booking cell as exported: quoted, padded, or a missing-value token, by the row id."""
    m = k % 9
    return (F.when(m == 0, F.lit("")).when(m == 1, F.lit("nan")).when(m == 2, F.lit("None"))
            .when(m == 3, F.lit(None).cast("string"))
            .when(m == 4, F.concat(F.lit('"'), c, F.lit('"'))).when(m == 5, F.concat(F.lit('  "'), c, F.lit('" ')))
            .otherwise(c))


@query
def strip_quotes_fill_empty(spark, sf_dir):
    """Quotes stripped, missing tokens -> EMPTY, on booking text cells."""
    b = A.booking(spark, sf_dir)
    k = F.col("reservation_id")
    raw = b.select("reservation_id", _messy(F.col("room_id"), k).alias("room_id"),
                   _messy(F.col("activity_type"), k + 1).alias("activity_type"),
                   _messy(F.col("department"), k + 2).alias("department"),
                   _messy(F.col("reserved_by"), k + 3).alias("reserved_by"),
                   _messy(F.col("class"), k + 4).alias("class"))
    cols = ["room_id", "activity_type", "department", "reserved_by", "class"]
    return raw.select("reservation_id", *[tx.fill_placeholder(tx.strip_quotes(c)).alias(c) for c in cols])


@query
def redact_people(spark, sf_dir):
    """User and professor names -> ANONYMIZED, empty cells stay empty."""
    b = A.booking(spark, sf_dir)
    k = F.col("reservation_id")
    instr = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("  ")).otherwise(F.concat(F.lit("Prof "), "department"))
    return b.select("reservation_id", tx.redact("reserved_by").alias("reserved_by"), tx.redact(instr).alias("instructor"))


@query
def normalize_time(spark, sf_dir):
    """H:MM, HH:MM, bare hour and HH:MM:SS -> HH:MM:SS, hour key and number."""
    b = A.booking(spark, sf_dir)
    k = F.col("reservation_id") % 4
    s = F.col("start_time")
    raw = (F.when(k == 0, s).when(k == 1, F.regexp_replace(s, "^0", ""))
           .when(k == 2, F.regexp_replace(F.split_part(s, F.lit(":"), F.lit(1)), "^0", ""))
           .otherwise(F.concat(s, F.lit(":00"))))
    r = b.select("reservation_id", raw.alias("raw_time"))
    return r.select("reservation_id", "raw_time", tx.normalize_time("raw_time", bare_hour=True).alias("time"),
                    tx.hour_key("raw_time").alias("hour_key"), tx.hour_num("raw_time").alias("hour"))


@query
def sentinel_filter(spark, sf_dir):
    """D3: -99999.0 readings dropped, missing readings kept."""
    w = A.weather(spark, sf_dir)
    i = F.col("issued")
    v = F.when(i % 9 == 0, F.lit(-99999.0)).when(i % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    return FL.sentinel_drop(w.withColumn("value", v)).select("date", "time", "site", "measurement", "value", "issued")


@query
def month_guard(spark, sf_dir):
    """Rows filed under another month's folder are dropped."""
    ev = _events(spark, sf_dir).where(F.col("event_type") == "view")
    m = F.month("date")
    folder = F.lpad(F.when(F.col("event_id") % 10 == 0, m % 12 + 1).otherwise(m).cast("string"), 2, "0")
    rows = ev.select("date", "time", F.col("value").alias("value_acquired"), folder.alias("folder_month"))
    return FL.month_guard(rows)


@query
def rooms_integrity_filter(spark, sf_dir):
    """Booking facts without TimeID or RoomID go to quarantine (flagged)."""
    b = A.booking(spark, sf_dir)
    k = F.col("reservation_id")
    b = b.withColumns({"room_id": F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("room_id")),
                       "start_time": F.when(k % 17 == 0, F.lit("n/a")).otherwise(F.col("start_time"))})
    rows = facts.rooms_fact_flagged(b)  # one pass: the flag, not a union of two filtered copies
    return rows.select("FactID", "TimeID", "RoomID", "ReservationID", "partition_date",
                       (~F.col("_ok")).alias("quarantined"))


@query
def role_filter(spark, sf_dir):
    """A director of school 'F' sees only that school's bookings; technicians see no rooms mart."""
    b = A.booking(spark, sf_dir)
    director = marts.rooms_secure_view(b, "director", "F").withColumn("role", F.lit("director"))
    tech = marts.rooms_secure_view(b, "technician", None).withColumn("role", F.lit("technician"))
    return director.unionByName(tech).select("role", "date", "room_id", "start_time", "reservation_id", "department")


# --- E: reshape ------------------------------------------------------------------------------

@query
def unpivot_inverters(spark, sf_dir):
    """Production pivoted to the 5-block export layout, then unpivoted back in one pass."""
    p = A.production(spark, sf_dir)
    aggs = []
    for b in range(1, R.N_INVERTERS + 1):
        on = F.col("inv_id") == b
        for f in ["inv_id", "pac", "daysum", "status", "error"]:
            aggs.append(F.max(F.when(on, F.col(f).cast("string"))).alias(R.wide_name(b, f)))
    wide = p.groupBy(F.col("date").alias("raw_date"), F.col("time").alias("time_str")).agg(*aggs)
    long = R.unpivot_inverters(wide)
    return long.select(F.col("raw_date").alias("date"), F.col("time_str").alias("time"),
                       F.col("inv_id").cast("int").alias("inv_id"), tx.to_double("pac").alias("pac"),
                       tx.to_double("daysum").alias("daysum"), "status", F.col("error").cast("int").alias("error"))


@query
def distinct_timestamps(spark, sf_dir):
    """Every (date, HH:MM:SS) any of the six feeds mentions."""
    fd = A.feeds(spark, sf_dir)
    return dims.collect_times(fd.production, fd.consumption, fd.humidity, fd.temperature, fd.weather, fd.booking)


# --- L5-L13: dimensions ----------------------------------------------------------------------

@query
def dim_time(spark, sf_dir):
    """DimTime over all feeds."""
    fd = A.feeds(spark, sf_dir)
    return dims.dim_time(dims.collect_times(fd.production, fd.consumption, fd.humidity, fd.temperature,
                                            fd.weather, fd.booking))


@query
def dim_room(spark, sf_dir):
    """L7."""
    return dims.dim_room(A.booking(spark, sf_dir))


@query
def dim_reservation(spark, sf_dir):
    """L6."""
    return dims.dim_reservation(A.booking(spark, sf_dir))


@query
def dim_consumption(spark, sf_dir):
    """L8 (consumption profiles)."""
    return dims.dim_profile(A.consumption(spark, sf_dir), "consumption")


@query
def dim_humidity(spark, sf_dir):
    """L8 (humidity levels)."""
    return dims.dim_profile(A.humidity(spark, sf_dir), "humidity")


@query
def dim_temp(spark, sf_dir):
    """L8 (temperature levels)."""
    return dims.dim_profile(A.temperature(spark, sf_dir), "temperature")


@query
def dim_inverter(spark, sf_dir):
    """L9."""
    return dims.dim_inverter(A.production(spark, sf_dir))


@query
def dim_errors(spark, sf_dir):
    """L10."""
    return dims.dim_errors(A.production(spark, sf_dir))


@query
def dim_forecast(spark, sf_dir):
    """L11."""
    return dims.dim_forecast(A.weather(spark, sf_dir))


@query
def dim_consumption_prediction(spark, sf_dir):
    """L12."""
    return dims.dim_consumption_prediction(A.consumption(spark, sf_dir))


@query
def dim_production_prediction_pac(spark, sf_dir):
    """L13 (pac)."""
    return dims.dim_production_prediction(A.weather(spark, sf_dir), "pac")


@query
def dim_production_prediction_daysum(spark, sf_dir):
    """L13 (daysum)."""
    return dims.dim_production_prediction(A.weather(spark, sf_dir), "daysum")


# --- B: sinks as plans ---------------------------------------------------------------------

@query
def upsert_new_rows(spark, sf_dir):
    """DimTime rows a second run adds after a first run that loaded production times only."""
    fd = A.feeds(spark, sf_dir)
    existing = dims.dim_time(dims.collect_times(production=fd.production))
    new = dims.dim_time(dims.collect_times(fd.production, fd.consumption, fd.humidity, fd.temperature,
                                           fd.weather, fd.booking))
    return W.rows_to_insert(new, existing, "TimeID")


@query
def fact_day_replace(spark, sf_dir):
    """The power fact after a re-run of the weekend days replaced those days."""
    pf = facts.power_fact(A.production(spark, sf_dir), A.consumption(spark, sf_dir))
    v1 = W.with_load_version(pf, 1)
    rerun = W.with_load_version(pf.where(F.dayofweek("partition_date").isin(1, 7)), 2)
    return W.replaced_view(v1, rerun).select("FactID", "partition_date", "load_version")


# --- G: aggregates -------------------------------------------------------------------------

@query
def daily_totals(spark, sf_dir):
    """Production (max daysum) and consumption (sum variation) per day, kWh."""
    p, c = A.production(spark, sf_dir), A.consumption(spark, sf_dir)
    d = G.daily_production_total(p).join(G.daily_consumption_total(c), "date", "full")
    return d.select("date", (F.col("max_daysum_w") / 1000.0).alias("total_production_kwh"),
                    (F.col("sum_variation_w") / 1000.0).alias("total_consumption_kwh"))


@query
def running_pct(spark, sf_dir):
    """Share of inverters running per slot."""
    return G.running_pct(A.production(spark, sf_dir))


@query
def hourly_sensor_mean(spark, sf_dir):
    """Hourly mean humidity and temperature."""
    h = A.humidity(spark, sf_dir).withColumn("feed", F.lit("humidity"))
    t = A.temperature(spark, sf_dir).withColumn("feed", F.lit("temperature"))
    g = G.hourly_mean(h.unionByName(t), by=("feed", "date"))
    return g.select("feed", "date", "hour", F.round("mean_value", 6).alias("mean_value"))


@query
def rooms_booked_by_slot(spark, sf_dir):
    """Distinct rooms per (date, start) against the rooms of the month."""
    return G.rooms_booked_by_slot(A.booking(spark, sf_dir))


# --- L14-L17: facts ------------------------------------------------------------------------

@query
def power_fact(spark, sf_dir):
    """L14 flagship: production vs consumption, running share, day totals, for every day, from feeds stored in buckets of their slot."""
    return facts.power_fact(*facts.store_slots(A.production(spark, sf_dir), A.consumption(spark, sf_dir), scratch_path(spark, "slots")))


@query
def power_fact_unstored(spark, sf_dir):
    """L14 over feeds in any layout: the slot statistics are exchanged."""
    return facts.power_fact(A.production(spark, sf_dir), A.consumption(spark, sf_dir))


@query
def weather_fact(spark, sf_dir):
    """L15."""
    return facts.weather_fact(A.weather(spark, sf_dir), A.humidity(spark, sf_dir), A.temperature(spark, sf_dir))


@query
def rooms_fact(spark, sf_dir):
    """L16."""
    return facts.rooms_fact(A.booking(spark, sf_dir))


@query
def prediction_fact(spark, sf_dir):
    """L17."""
    return facts.prediction_fact(A.consumption(spark, sf_dir), A.weather(spark, sf_dir))


# --- marts ---------------------------------------------------------------------------------

@query
def power_export(spark, sf_dir):
    """The flat power export (fact with time, inverter, consumption, error dims), written as CSV and read back."""
    fd = A.feeds(spark, sf_dir, materialize=True)
    p, c = fd.production, fd.consumption
    times = dims.dim_time(dims.collect_times(p, c, fd.humidity, fd.temperature, fd.weather, fd.booking))
    # the star is read as stored tables: Spark broadcasts the dimensions whose files are small
    star = [W.stage(spark, t, "star") for t in (facts.power_fact(p, c), times, dims.dim_inverter(p),
                                                 dims.dim_profile(c, "consumption"), dims.dim_errors(p))]
    flat = marts.power_export(*star)
    path = scratch_path(spark, "power-export")
    W.export_delimited(flat, path, sep=",")
    return W.read_delimited(spark, path, flat.schema, sep=",")


@query
def campus_kpis(spark, sf_dir):
    """Day / month / overall campus KPIs (bookings on the days of the energy feeds)."""
    fd = A.feeds(spark, sf_dir, energy_bookings=True)
    return marts.campus_kpis(fd.production, fd.consumption, fd.humidity, fd.temperature, fd.booking)


@query
def energy_value_chf(spark, sf_dir):
    """G14."""
    return marts.energy_value_chf(A.production(spark, sf_dir), A.consumption(spark, sf_dir))


@query
def production_vs_climate(spark, sf_dir):
    """G15."""
    return marts.production_vs_climate(A.production(spark, sf_dir), A.humidity(spark, sf_dir),
                                       A.temperature(spark, sf_dir))


@query
def forecast_accuracy(spark, sf_dir):
    """Forecast MAE / accuracy by day, month and overall."""
    return marts.forecast_accuracy(A.weather(spark, sf_dir), "value", "prediction")


@query
def status_counts(spark, sf_dir):
    """G17."""
    return marts.status_counts(A.production(spark, sf_dir))


@query
def error_counts(spark, sf_dir):
    """G18."""
    return marts.error_counts(A.production(spark, sf_dir))


@query
def reservations_share(spark, sf_dir):
    """By activity, department and instructor."""
    b = A.booking(spark, sf_dir)
    prof = F.concat(F.lit("Prof "), (F.col("reservation_id") % 37).cast("string"))
    return marts.reservations_share(b.withColumn("instructor", prof))


def _odd_hours(spark, sf_dir):
    """Bookings with minutes in their times (08:15-09:30), and some without a start."""
    b, k = A.booking(spark, sf_dir), F.col("reservation_id")
    minute = lambda c, m: F.concat(F.substring(c, 1, 3), F.lit(m))
    return b.withColumns({
        "start_time": F.when(k % 17 == 0, F.lit(None).cast("string")).when(k % 3 == 1, minute("start_time", "15")).otherwise(F.col("start_time")),
        "end_time": F.when(k % 3 == 1, minute("end_time", "30")).otherwise(F.col("end_time"))})


@query
def room_date_heatmap(spark, sf_dir):
    """G20."""
    return marts.room_date_heatmap(_odd_hours(spark, sf_dir))


@query
def room_hour_timeline(spark, sf_dir):
    """G21."""
    return marts.room_hour_timeline(_odd_hours(spark, sf_dir))


@query
def most_recent_forecast(spark, sf_dir):
    """Latest issue per (slot, site, measurement)."""
    w = A.weather(spark, sf_dir)
    return WN.most_recent(w, ["date", "time", "site", "measurement"]).select(
        "date", "time", "site", "measurement", "value", "prediction", "issued")


@query
def stalled_inverters(spark, sf_dir):
    """Daysum not rising while a peer's does."""
    return WN.stalled_inverters(A.production(spark, sf_dir))


@query
def peer_underperformers(spark, sf_dir):
    """Pac below half the slot's mean."""
    out = WN.peer_underperformers(A.production(spark, sf_dir))
    return out.withColumn("peer_avg_pac", F.round("peer_avg_pac", 6))


@query
def stall_episodes(spark, sf_dir):
    """Stalls as episodes with start, end, readings and lost production."""
    return WN.stall_episodes(A.production(spark, sf_dir))


@query
def room_month_matrix(spark, sf_dir):
    """The room x date heatmap as one row per room and month; the 31 places are written as text here ('-': no such day)."""
    m = marts.room_month_matrix(_odd_hours(spark, sf_dir))
    return m.withColumn("hours", F.array_join(F.transform("hours", lambda h: h.cast("string")), ",", "-"))


@query
def role_views(spark, sf_dir):
    """The rooms and solar pages as three roles see them through the catalog views; a visitor has no grant."""
    pages = {"rooms": A.booking(spark, sf_dir), "solar": A.production(spark, sf_dir)}
    secure.create(spark, pages, {"rooms": "department"})
    key = {"rooms": F.concat_ws(" ", "department", "room_id"), "solar": F.col("inv_id").cast("string")}
    out = [secure.read_as(spark, page, role, "F").groupBy(F.lit(role).alias("role"), F.lit(page).alias("page"), key[page].alias("item")).agg(F.count(F.lit(1)).alias("n_rows"))
           for role in ("director", "technician", "visitor") for page in pages]
    return R.union_all(out)


# --- V: validation -------------------------------------------------------------------------

def _core_tables(spark, sf_dir):
    """The eleven keyed gold tables over feeds materialised once (the checks share them)."""
    t = gold.build(A.feeds(spark, sf_dir, materialize=True))
    return _damaged({n: t[n] for n in gold.CORE_TABLES})


def _damaged(t):
    """Keys broken on purpose, so that the checks have something to find: rows that stand twice, dimension rows
    that are missing, ids that are NULL or empty."""
    room = F.col("Alt_RoomID")
    t["DimRoom"] = t["DimRoom"].where(~room.endswith("5")).unionByName(t["DimRoom"].where(room.endswith("7")))
    t["DimInverter"] = t["DimInverter"].where("InverterID <> 3")
    day = F.dayofmonth("partition_date")
    f = t["Power_FactTable"]
    t["Power_FactTable"] = f.withColumns({
        "ConsumptionID": F.when(day != 13, F.col("ConsumptionID")), "TimeID": F.when(day == 14, F.lit("")).otherwise(F.col("TimeID"))})
    w = t["Weather_FactTable"]
    t["Weather_FactTable"] = w.unionByName(w.where(day == 2))
    return t


@query
def pk_duplicates(spark, sf_dir):
    """V1."""
    return quality.pk_duplicates(_core_tables(spark, sf_dir))


@query
def fk_orphans(spark, sf_dir):
    """V2."""
    return quality.fk_orphans(_core_tables(spark, sf_dir))


@query
def not_null_counts(spark, sf_dir):
    """V3."""
    return quality.not_null_counts(_core_tables(spark, sf_dir))


@query
def missing_days(spark, sf_dir):
    """V4."""
    fd = A.feeds(spark, sf_dir)
    return quality.missing_days({"production": fd.production, "consumption": fd.consumption,
                                 "humidity": fd.humidity, "temperature": fd.temperature,
                                 "weather": fd.weather, "booking": fd.booking})


@query
def missing_day_ranges(spark, sf_dir):
    """V4: runs of days without rows in each feed (some days of the energy feeds are taken out)."""
    fd, d = A.feeds(spark, sf_dir), F.dayofmonth("date")
    return quality.missing_day_ranges({"production": fd.production.where(~d.isin(5, 6, 7, 20)), "humidity": fd.humidity.where(~d.isin(1, 9)), "booking": fd.booking})


# --- L18-L20, A10 --------------------------------------------------------------------------

@query
def backfill_range(spark, sf_dir):
    """L18 + G12: fact rows per calendar day over the full range of the feeds."""
    return run.backfill_counts(A.feeds(spark, sf_dir, materialize=True, energy_bookings=True))


def _lake(spark, sf_dir, root):
    """The six feeds stored as a silver lake under ``root`` (bookings on the days of the energy feeds); the six writes run side by side."""
    fd = A.feeds(spark, sf_dir, energy_bookings=True)

    def store(name):
        declared = SV.FEED_SCHEMAS[name]
        rows = getattr(fd, name)
        rows = W.conform(rows.select(*[F.col(c).cast(declared[c].dataType) for c in rows.columns if c in declared.fieldNames() and c != "issued"]), declared)
        if name == "booking":
            W.rewrite_layer(rows.withColumn("month", F.date_format("date", "yyyy-MM")), f"{root}/{name}", "month")
        else:
            W.replace_days(rows, f"{root}/{name}", full=True)

    with ThreadPoolExecutor(max_workers=len(gold.FEED_NAMES)) as pool:
        list(pool.map(store, gold.FEED_NAMES))
    return root


@query
def run_log(spark, sf_dir):
    """The log of a backfill of all days from a stored lake: rows of each day and fact as their writes counted them, days without
    rows, and the rows added to the core dimensions."""
    root = _lake(spark, sf_dir, scratch_path(spark, "run-log"))
    first, last = SV.read_feed(spark, root, "booking").agg(F.min("date"), F.max("date")).first()
    log = run.backfill(spark, root, f"{root}/gold", first, last)
    return log.where(F.col("date").isNotNull()).select("table_name", "date", "n_rows", "status")


@query
def rooms_fact_day_runs(spark, sf_dir):
    """The rooms fact and DimReservation as four runs load them (to the middle of a month, one single day, the rest): all
    days of the feed, cut at a third and two thirds of its range."""
    feeds = A.feeds(spark, sf_dir)
    first, last = feeds.booking.agg(F.min("date"), F.max("date")).first()
    day = lambda k: first + (last - first) * k // 3
    one = dt.timedelta(days=1)
    runs = [(first, day(1)), (day(1) + one, day(1) + one), (day(1) + 2 * one, day(2)), (day(2) + one, last)]
    parts = []
    for start, end in runs:
        t = gold.build(feeds, start, end)
        res = t["DimReservation"].select("ReservationID", F.col("Start_time").alias("first_start"))
        parts.append(t["Rooms_FactTable"].join(res, "ReservationID", "left")
                     .select("FactID", "RoomID", "ReservationID", "Pct_Rooms_Booked", "Rooms_Free_Count", "partition_date", "first_start"))
    return R.union_all(parts)


@query
def rooms_fact_bitmaps(spark, sf_dir):
    """The rooms fact of all days, the rooms of a month from the bitmaps that its days stored, not from the month's bookings."""
    root, b = scratch_path(spark, "room-bits"), A.booking(spark, sf_dir)
    STA.store(spark, STA.room_bits(b, STA.number_rooms(spark, root, b)), f"{root}/room_bits")
    return facts.rooms_fact(b, STA.rooms_of_month(STA.read_state(spark, f"{root}/room_bits")))


def _refreshed_states(spark, sf_dir):
    """Day states of a first load whose weekend days were wrong, after these days were delivered again and refreshed alone."""
    root, fd = scratch_path(spark, "states"), A.feeds(spark, sf_dir, materialize=True, energy_bookings=True)
    weekend = F.dayofweek("date").isin(1, 7)
    wrong = A.Feeds(fd.production.withColumn("daysum", F.when(weekend, F.col("daysum") + 7.0).otherwise(F.col("daysum"))),
                    fd.consumption.where(~weekend), fd.humidity, fd.temperature.withColumn("value_acquired", F.when(weekend, 0.0).otherwise(F.col("value_acquired"))),
                    fd.weather.withColumn("prediction", F.when(weekend, F.col("prediction") + 1.0).otherwise(F.col("prediction"))),
                    fd.booking.where(~weekend | (F.col("room_id") < "R03")))
    STA.refresh(spark, root, wrong)
    days = reduce(lambda x, y: x.union(y), [getattr(fd, n).select("date") for n in gold.FEED_NAMES]).where(weekend)
    STA.refresh(spark, root, fd, days)
    return STA.read_states(spark, root)


@query
def campus_kpis_incremental(spark, sf_dir):
    """The campus figures rolled up from day states, after the weekend days alone were refreshed."""
    return STA.campus_kpis(_refreshed_states(spark, sf_dir))


@query
def forecast_accuracy_incremental(spark, sf_dir):
    """Forecast errors by day, month and overall from the refreshed day states."""
    return STA.forecast_accuracy(_refreshed_states(spark, sf_dir))


@query
def future_time_rows(spark, sf_dir):
    """L19 + C20: DimTime rows of the next two days of every run date, mapped into 2023."""
    return run.future_time_rows(A.consumption(spark, sf_dir).select("date"), fixed_year=2023)


# --- bronze files, streaming and the forecast ----------------------------------------------

def _readings(spark, sf_dir, event_type="view", unit="%"):
    ev = _events(spark, sf_dir).where(F.col("event_type") == event_type)
    return ev.select("event_id", "date", "time", F.lit(unit).alias("unit"), F.col("value").alias("value_acquired"),
                     (F.col("user_id") % 7).cast("double").alias("variation"))


def _sensor_drops(spark, sf_dir, name, event_type, unit):
    """Bronze drops of one sensor feed in three shapes: tab, ``;``, and tab with a wider header."""
    root = scratch_path(spark, name)
    eid = F.col("event_id")
    rows = _readings(spark, sf_dir, event_type, unit)
    for i, (sep, header) in enumerate([("\t", DR.SENSOR_HEADER), (";", DR.SENSOR_HEADER), ("\t", DR.SENSOR_HEADER + ["Remark"])]):
        part = rows.where(eid % 3 == i)
        DR.write_lines(DR.sensor_lines(part, eid, sep, n_cells=len(header)), f"{root}/bronze/shape={i}", header, sep, "UTF-16")
    return root


def _sensor_load(spark, sf_dir, name, event_type, unit):
    root = _sensor_drops(spark, sf_dir, name, event_type, unit)
    SL.load_sensor(spark, f"{root}/bronze", f"{root}/silver")
    return SV.read_feed(spark, root, "silver", kind="humidity")


@query
def silver_sensor_load(spark, sf_dir):
    """L1 end to end (A1, A5-A7, A9, C1, C6, C8, D1, D2, B1): humidity readings written as UTF-16 drops in month
    folders (tab, ``;`` and a wider header), scanned by position under each file's own separator and width, cleaned, written by day, read back."""
    return _sensor_load(spark, sf_dir, "silver-sensor", "view", "%")


@query
def silver_mixed_schema(spark, sf_dir):
    """A meter feed whose days 5, 10, ... were stored without ``variation`` (and others with a column more), read under
    the declared schema: rows, variations and total of every day."""
    root = scratch_path(spark, "mixed-schema")
    rows, old = A.consumption(spark, sf_dir), F.dayofmonth("date") % 5 == 0
    W.replace_days(rows.where(old).drop("variation"), f"{root}/consumption")
    W.replace_days(rows.where(~old).withColumn("remark", F.lit("x")), f"{root}/consumption")
    feed = SV.read_feed(spark, root, "consumption")
    counts = feed.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"), F.count("variation").alias("n_variations"))
    return counts.join(G.daily_consumption_total(feed), "date").select("date", "n_rows", "n_variations", "sum_variation_w")


@query
def silver_temperature_load(spark, sf_dir):
    """L1 for the temperature feed."""
    return _sensor_load(spark, sf_dir, "silver-temperature", "click", "C")


@query
def silver_consumption_load(spark, sf_dir):
    """L1 for the consumption feed."""
    return _sensor_load(spark, sf_dir, "silver-consumption", "purchase", "kWh")


@query
def silver_pv_load(spark, sf_dir):
    """L1 for the solar history feed."""
    return _sensor_load(spark, sf_dir, "silver-pv", "signup", "W")


def _by_reason(spark, path):
    return spark.read.parquet(path).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def sensor_rejects(spark, sf_dir):
    """Lines that the sensor load leaves out, from the quarantine that the load writes, counted by reason."""
    root = _sensor_drops(spark, sf_dir, "sensor-rejects", "view", "%")
    SL.load_sensor(spark, f"{root}/bronze", f"{root}/silver", quarantine_path=f"{root}/quarantine")
    return _by_reason(spark, f"{root}/quarantine")


@query
def production_rejects(spark, sf_dir):
    """Lines of the wide export that the inverter load leaves out, from its quarantine, counted by reason."""
    root = scratch_path(spark, "production-rejects")
    long = (F.dayofmonth("date") == 21) & F.col("time").between("10:00:00", "10:59:59")
    DR.write_lines(DR.inverter_lines(A.production(spark, sf_dir), too_long=long), f"{root}/bronze", DR.INVERTER_HEADER, ";")
    SL.load_production(spark, f"{root}/bronze/", f"{root}/silver", quarantine_path=f"{root}/quarantine")
    return _by_reason(spark, f"{root}/quarantine")


@query
def weather_rejects(spark, sf_dir):
    """Forecast lines that the load leaves out, from its quarantine, counted by reason."""
    root = scratch_path(spark, "weather-rejects")
    lines = DR.weather_lines(_forecast_rows(spark, sf_dir), F.col("event_id"), F.col("ts"), F.col("event_id") % 37 == 0)
    DR.write_issues(lines, f"{root}/bronze", DR.WEATHER_HEADER, ",")
    SL.load_weather(spark, f"{root}/bronze", f"{root}/silver", quarantine_path=f"{root}/quarantine")
    return _by_reason(spark, f"{root}/quarantine")


@query
def booking_rejects(spark, sf_dir):
    """A5: the over-long lines of the latest booking export, with the reservation that each names."""
    root = scratch_path(spark, "booking-rejects")
    DR.write_lines(DR.booking_lines(A.booking(spark, sf_dir), long_every=41), f"{root}/bronze/export=1", DR.BOOKING_HEADER, "\t", partition_col=None)
    SL.load_booking(spark, f"{root}/bronze", f"{root}/silver", latest="dir", quarantine_path=f"{root}/quarantine")
    at = DR.BOOKING_HEADER.index(DR.french("reservation_id"))
    return spark.read.parquet(f"{root}/quarantine").select("reason", F.split("line", "\t")[at].alias("reservation_id"))


@query
def incremental_ingest(spark, sf_dir):
    """A10: the drops arrive in three deliveries (days 1-15, the rest, then days 10 and 20 again with other values);
    a file-source stream with availableNow runs after each and rewrites the days it touches."""
    root = scratch_path(spark, "ingest")
    rows = _readings(spark, sf_dir)
    day = F.dayofmonth("date")
    again = rows.where(day.isin(10, 20)).withColumn("value_acquired", F.col("value_acquired") + 1.0)
    eid = F.col("event_id")
    for b, part in enumerate([rows.where(day <= 15), rows.where(day > 15), again], 1):
        DR.write_lines(DR.sensor_lines(part, eid, ";"), f"{root}/bronze/delivery={b}", DR.SENSOR_HEADER, ";", "UTF-8")
        order = F.regexp_extract("file_path", r"delivery=(\d+)", 1)
        ST.run_available_now(ST.sensor_stream(spark, f"{root}/bronze", delivery=order), f"{root}/silver", f"{root}/checkpoint")
    return ST.read_silver(spark, f"{root}/silver")


@query
def forecast_random_forest(spark, sf_dir):
    """Random-forest forecast of next-day hourly production and consumption. Rows-only check."""
    shared_dir(spark)
    fd = A.feeds(spark, sf_dir, energy_bookings=True)
    return FC.forecast_next_day(*_until_last_day(fd), fd.booking, fd.weather)


def _until_last_day(fd):
    """The energy feeds without the last day of production and consumption: that day is held out, the weather forecast reaches it."""
    last = fd.production.select("date").unionByName(fd.consumption.select("date")).agg(F.max("date")).scalar()
    return [getattr(fd, n).where(F.col("date") < last) for n in ("production", "consumption", "humidity", "temperature")]


@query
def forecast_features(spark, sf_dir):
    """The hourly training frame (targets, weather, rooms and weather-forecast features)."""
    fd = A.feeds(spark, sf_dir, energy_bookings=True)
    return FC.hourly_frame(fd.production, fd.consumption, fd.humidity, fd.temperature, fd.booking, fd.weather)


@query
def energy_forecast_accuracy(spark, sf_dir):
    """G16, baseline: each hour predicted as the same hour of the day before, by day, month and overall (the model's own errors: ``forecast_backtest_accuracy``)."""
    fd = A.feeds(spark, sf_dir, energy_bookings=True)
    frame = FC.hourly_frame(fd.production, fd.consumption, fd.humidity, fd.temperature, fd.booking, fd.weather)
    return FC.accuracy(FC.persistence(W.stage(spark, frame, "hourly")))


def _backtest(spark, sf_dir):
    """(hourly frame, its forecasts as the prediction fact stores them, by day)."""
    fd = A.feeds(spark, sf_dir, energy_bookings=True)
    frame = W.stage(spark, FC.hourly_frame(fd.production, fd.consumption, fd.humidity, fd.temperature, fd.booking, fd.weather), "hourly")
    path = scratch_path(spark, "backtest")
    W.replace_days(BT.walk_forward(frame, fd.weather), path, "pred_date")
    return frame, spark.read.schema(BT.SCHEMA).parquet(path)


@query
def forecast_backtest(spark, sf_dir):
    """Every day forecast from the days before it; its actual hours, the hours that each forest was trained on, and whether a
    prediction of both targets is stored."""
    both = BT.compared(*_backtest(spark, sf_dir))
    scored = F.col("predicted_production_kwh").isNotNull() & F.col("predicted_consumption_kwh").isNotNull()
    return both.select("date", "hour", "production_kwh", "consumption_kwh", F.coalesce("n_train_production", F.lit(0)).alias("n_train_production"),
                       F.coalesce("n_train_consumption", F.lit(0)).alias("n_train_consumption"), scored.alias("scored"))


@query
def forecast_backtest_accuracy(spark, sf_dir):
    """Errors of the model's own forecasts of production and consumption, by day, month and overall. Rows-only check (tree model)."""
    return BT.accuracy(BT.compared(*_backtest(spark, sf_dir)))


@query
def prediction_fact_forecast(spark, sf_dir):
    """L17 + L20: the prediction fact after the next day's forecast replaced that day. Rows-only check (tree model)."""
    fd = A.feeds(spark, sf_dir, energy_bookings=True)
    root = scratch_path(spark, "prediction-fact")
    W.replace_fact_days(facts.prediction_fact(fd.consumption, fd.weather), root)
    pred = FC.forecast_next_day(*_until_last_day(fd), fd.booking, fd.weather)
    W.replace_fact_days(FC.prediction_rows(pred), root)
    return spark.read.parquet(root)


@query
def actual_vs_predicted(spark, sf_dir):
    """J14 (+G5): actual production per slot beside the mean of the weather feed's ``prediction`` (the reference's production-forecast
    dimension takes it from there); full outer on the slot. The model's predictions: ``forecast_backtest``."""
    actual = (A.production(spark, sf_dir).withColumn("time", tx.normalize_time("time"))
              .groupBy("date", "time").agg(G.exact_sum("pac").alias("actual_sum_pac")))
    pred = (A.weather(spark, sf_dir).withColumn("time", tx.normalize_time("time"))
            .transform(G.mean_prediction_per_time).select("date", "time", F.round("mean_prediction", 6)
                                                          .alias("pred_sum_pac")))
    return marts.actual_vs_predicted(actual, pred)


@query
def dashboard_slicers(spark, sf_dir):
    """Activity counts for two departments in a date range, some months and a time of day, EMPTY placeholders left out."""
    b = A.booking(spark, sf_dir)
    b = b.withColumn("activity_type", tx.fill_placeholder(tx.strip_quotes(_messy(F.col("activity_type"),
                                                                                  F.col("reservation_id") + 1))))
    s = FL.slicer(FL.drop_placeholders(b, "activity_type"), dates=("1996-01-01", "2000-12-31"), months=[1, 2, 3, 9, 10, 11],
                  times=("08:00", "15:59"), department=["F", "O"])
    return s.groupBy("department", "activity_type").agg(F.count(F.lit(1)).alias("n_bookings"))


@query
def silver_production_load(spark, sf_dir):
    """L2 end to end (A2, A9, E1, C2, C7, D2, S1, B1): inverter readings written as the wide
    5-block export in month folders, scanned by position, unpivoted, cleaned, written by day, read back."""
    root = scratch_path(spark, "silver-production")
    DR.write_lines(DR.inverter_lines(A.production(spark, sf_dir)), f"{root}/bronze", DR.INVERTER_HEADER, ";")
    SL.load_production(spark, f"{root}/bronze/", f"{root}/silver")
    return SV.read_feed(spark, root, "silver", kind="production")


def _forecast_rows(spark, sf_dir):
    ev = A.table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase"))
    return ev.select("event_id", "ts", "value",
                     (F.col("value") + (F.col("user_id") % 4).cast("double")).alias("prediction"),
                     F.concat(F.lit("site"), (F.col("user_id") % 3).cast("string")).alias("site"),
                     F.col("event_type").alias("measurement"),
                     F.when(F.col("event_type") == "signup", F.lit("W/m2")).otherwise(F.lit("C")).alias("unit"))


@query
def silver_weather_load(spark, sf_dir):
    """L3 end to end (A3, A5, C3, C7, D2, D3, B1): forecast rows written as ISO-time CSV drops,
    scanned, parsed to UTC, sentinel and month checked, written by day, read back."""
    root = scratch_path(spark, "silver-weather")
    rows = _forecast_rows(spark, sf_dir)
    DR.write_issues(DR.weather_lines(rows, F.col("event_id"), F.col("ts")), f"{root}/bronze", DR.WEATHER_HEADER, ",")
    SL.load_weather(spark, f"{root}/bronze", f"{root}/silver")
    return SV.read_feed(spark, root, "silver", kind="weather")


@query
def silver_booking_load(spark, sf_dir):
    """L4 end to end (A4-A6, A8, C4, C5, C9-C12, B2): bookings written as two French tab exports, the older one larger and
    with another column order; the latest export alone is read under its own header, over-long lines are dropped, rewritten by date, read back."""
    root = scratch_path(spark, "silver-booking")
    b = A.booking(spark, sf_dir)
    old = b.unionByName(b.withColumn("room_id", F.lit("OLD")))
    DR.write_lines(DR.booking_lines(old, order=list(reversed(DR.BOOKING_HEADER))), f"{root}/bronze/export=1",
                   list(reversed(DR.BOOKING_HEADER)), "\t", partition_col=None)
    DR.write_lines(DR.booking_lines(b, long_every=41), f"{root}/bronze/export=2", DR.BOOKING_HEADER, "\t", partition_col=None)
    SL.load_booking(spark, f"{root}/bronze", f"{root}/silver", latest="dir")
    return SV.read_feed(spark, root, "silver", kind="booking").select(
        "date", "room_id", "start_time", "end_time", "reservation_id", "reserved_by", "activity_type", "instructor", "department", "class")
