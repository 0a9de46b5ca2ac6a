"""Scan plans, schemas, stored layouts, day states, backtest, views (each against a small brute force)."""

import datetime as dt
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake import registry, schemas
from wattlake.operators import aggregates as G
from wattlake.operators import windows as WN
from wattlake.plans import backtest as BT
from wattlake.plans import facts, marts, quality, secure, silver, states
from wattlake.plans import forecast as FC
from wattlake.sinks import writers as W
from wattlake.sources import adapters as A
from wattlake.sources import raw, scan
from wattlake.sources import silver as SV

from .conftest import SF_SMALL


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(d, m=3):
    return dt.date(2023, m, d)


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


# --- scan -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("encoding, end", [("utf-8-sig", "\n"), ("utf-16", "\r\n"), ("utf-16", "\n"), ("utf-8", "\r\n")])
def test_file_is_split(spark, scratch, encoding, end):
    """A1-A3: one file is read by several tasks, whatever its encoding, and every line is read once."""
    n = 20_000
    head = "Datum;Zeit;Einheit;Wert;Var"
    lines = [f"{i % 28 + 1:02d}.03.2023;{i % 24:02d}:{i % 60:02d};%é;{i},5;0,5" for i in range(n)]
    put(f"{scratch}/in/03/01.03.2023-Humidity.csv", end.join([head, *lines]) + end, encoding)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        df = raw.read_sensor(spark, f"{scratch}/in", encoding="UTF-8" if "8" in encoding else "UTF-16")
        assert df.rdd.getNumPartitions() > 3
        rows = df.select("val_raw", "unit").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(int(r.val_raw.split(",")[0]) for r in rows) == list(range(n)) and {r.unit for r in rows} == {"%é"}


def test_plan_reads_headers_alone(spark, scratch):
    """A file larger than any array is listed and planned from its first bytes; files are grouped by encoding, separator and width."""
    put(f"{scratch}/in/03/01.03.2023-Humidity.csv", "\n\na;b;c\n1;2;3\n")
    put(f"{scratch}/in/03/02.03.2023-Humidity.csv", "x;y;z\n1;2;3\n")
    put(f"{scratch}/in/03/03.03.2023-Humidity.csv", "a\tb\n1\t2\n", "utf-16")
    put(f"{scratch}/in/03/04.03.2023-Humidity.csv", "")
    put(f"{scratch}/in/03/05.03.2023-Humidity.csv", 'a;"b;c";d\n1;2;3\n')
    with open(f"{scratch}/in/03/01.03.2023-Humidity.csv", "ab") as fh:
        fh.truncate(3 << 30)
    paths = scan.list_files(spark, f"{scratch}/in")
    assert len(paths) == 4                              # the listing leaves an empty file out
    groups = scan.plan(spark, paths, "UTF-8")
    assert [(g.encoding, g.sep, g.width, len(g.paths)) for g in groups] == [("UTF-16LE", "\t", 2, 1), ("UTF-8", ";", 3, 3)]
    assert scan.lines(spark, groups[1]).rdd.getNumPartitions() > 20


def test_odd_lines(spark, scratch):
    """Quoted cells, an empty first cell beside a quote, a repeated header, blank lines, long and short lines."""
    put(f"{scratch}/in/03/01.03.2023-Humidity.csv", 'd;t;u;v;w\n;"07:15";"a;""b""";1;2\n\nd;t;u;v;w\n1;2\n1;2;3;4;5;6\n  \n')
    rows = raw.read_sensor(spark, f"{scratch}/in", encoding="UTF-8", keep_bad=True).collect()
    assert sorted((r.raw_date, r.time_str, r.unit or "", r[raw.BAD]) for r in rows if r.raw_date) == [("1", "2", "", False), ("1", "2", "3", True)]
    quoted = next(r for r in rows if r.raw_date is None)
    assert (quoted.time_str, quoted.unit, quoted.val_raw, quoted.var_raw) == ("07:15", 'a;"b"', "1", "2")


def test_one_scan_for_rows_and_rejects(spark, scratch):
    """L1-L4: what stays and what goes come from one scan of the files."""
    put(f"{scratch}/in/03/01.03.2023-Humidity.csv", "d;t;u;v;w\n01.03.2023;07:15;%;1;2\nx;07:30;%;1;2\n")
    out = silver.sensor_outcomes(raw.read_sensor(spark, f"{scratch}/in", encoding="UTF-8", keep_bad=True))
    assert physical(out).count("FileScan text") == 1
    kept, gone = silver.split(out, "test")
    assert kept.count() == 1 and [(r.line, r.reason) for r in gone.collect()] == [("x;07:30;%;1;2", "bad date")]


# --- schemas ----------------------------------------------------------------------------------------
def test_mixed_schema(spark, scratch):
    """An old day without ``variation`` changes its own total alone, whichever day is read first."""
    full = spark.createDataFrame([(day(2), "07:15:00", "kWh", 10.0, 1.0), (day(2), "07:30:00", "kWh", 11.0, 2.0)], schemas.SENSOR)
    old = spark.createDataFrame([(day(1), "07:15:00", "kWh", 5.0), (day(3), "07:15:00", "kWh", 6.0)], "date date, time string, unit string, value_acquired double")
    for d in (old, full):
        W.replace_days(d, f"{scratch}/consumption")
    feed = SV.read_feed(spark, scratch, "consumption")
    assert feed.schema.simpleString() == schemas.SENSOR.simpleString()
    total = {r.date: (r.sum_variation_w, r.has_variation) for r in G.daily_consumption_total(feed).collect()}
    assert total == {day(1): (5.0, False), day(2): (3.0, True), day(3): (6.0, False)}
    prod = spark.createDataFrame([(day(d), "07:15:00", 1, 2000.0, 9.0) for d in (1, 2)], "date date, time string, inv_id int, pac double, daysum double")
    diff = {r.partition_date: r.Prod_vs_Consumption_Diff for r in facts.power_fact(prod, feed).collect()}
    assert diff == {day(1): pytest.approx(1.995), day(2): pytest.approx(1.999)}


def test_conform(spark, scratch):
    """Absent columns are NULL, order and types are the schema's, a NULL key fails the write, DDL has NOT NULL."""
    dim = schemas.GOLD["DimForecast"]
    df = spark.createDataFrame([("C", "k")], "Unit string, ForecastID string")
    assert [tuple(r) for r in W.conform(df, dim).collect()] == [("k", None, None, "C")]
    with pytest.raises(Exception, match="ForecastID"):
        W.conform(spark.createDataFrame([(None,)], "ForecastID string"), dim).write.parquet(f"{scratch}/x")
    with pytest.raises(ValueError, match="ForecastID"):
        W.conform(df.drop("ForecastID"), dim)
    ddl = next(x for x in W.gold_ddl(f"{scratch}/wh", "gold_null") if ".DimForecast " in x)
    assert "`ForecastID` string NOT NULL" in ddl and "`Site` string," in ddl
    W.create_catalog_tables(spark, f"{scratch}/wh", "gold_null")
    kept = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold_null.Rooms_FactTable").collect()}
    W.drop_catalog_tables(spark, "gold_null")
    assert kept["not_null"] == "FactID,TimeID,RoomID,partition_date"


# --- stored layout ----------------------------------------------------------------------------------
def test_power_fact_without_exchange_by_slot(spark, scratch):
    """Over feeds in buckets of their slot only the day totals are exchanged, and the rows are the same."""
    p, c = A.production(spark, SF_SMALL), A.consumption(spark, SF_SMALL)
    stored = facts.power_fact(*facts.store_slots(p, c, f"{scratch}/slots", 4))
    exchanged = [x for x in physical(stored).split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanged) == 2 and all(re.search(r"hashpartitioning\(date#\d+, \d+\)", x) for x in exchanged)
    assert sorted(map(str, stored.collect())) == sorted(map(str, facts.power_fact(p, c).collect()))


# --- day states -------------------------------------------------------------------------------------
def test_refresh_of_days(spark, scratch):
    """After single days change, appear and vanish, the states equal those of a build from scratch."""
    fd = A.feeds(spark, SF_SMALL, energy_bookings=True)
    only = lambda keep: A.Feeds(*[getattr(fd, n).where(keep) for n in A.Feeds.__dataclass_fields__])
    d = F.dayofmonth("date")
    states.refresh(spark, scratch, only(~d.isin(4)))                                    # day 4 is late
    states.refresh(spark, scratch, only(~d.isin(9)), spark.createDataFrame([(dt.date(2024, 1, 4),), (dt.date(2024, 1, 9),)], "date date"))     # day 9 was withdrawn
    fresh = f"{scratch}/fresh"
    states.refresh(spark, fresh, only(~F.col("date").isin(dt.date(2024, 1, 9), dt.date(2024, 2, 4))))
    a, b = (sorted(map(str, states.campus_kpis(states.read_states(spark, r)).collect())) for r in (scratch, fresh))
    assert a == b and len(a) > 20


def test_room_numbers_grow(spark, scratch):
    """Known rooms keep their numbers; distinct rooms of a month over 32,768 rooms are counted over two bitmaps."""
    b = lambda names: spark.createDataFrame([(day(1 + i % 3), n) for i, n in enumerate(names)], "date date, room_id string")
    one = {r.room_id: r.number for r in states.number_rooms(spark, scratch, b(["b", "d"])).collect()}
    two = {r.room_id: r.number for r in states.number_rooms(spark, scratch, b(["a", "d", "c", None])).collect()}
    assert one == {"b": 1, "d": 2} and two == {"b": 1, "d": 2, "a": 3, "c": 4}
    many = spark.range(40_000).select(F.lit(day(1)).alias("date"), F.concat(F.lit("r"), "id").alias("room_id"), (F.col("id") + 1).alias("number"))
    bits = states.room_bits(many.select("date", "room_id"), many.select("room_id", "number"))
    assert bits.count() == 2 and states.rooms_of_month(bits).first().rooms_total == 40_000


# --- backtest ---------------------------------------------------------------------------------------
def test_backtest(spark):
    """Each day's forests see earlier days alone, and the reported MAE is that of the stored predictions."""
    frame, predicted = registry._backtest(spark, SF_SMALL)
    rows = {(r.pred_date, r.pred_hour): r for r in predicted.collect()}
    history = BT.History(frame.select("date", "hour", *[f for f in FC.FEATURES if f != "hour"], *[f"{k}_kwh" for k in BT.KINDS]).toArrow())
    known = {}
    fd = A.feeds(spark, SF_SMALL, energy_bookings=True)
    for r in FC.hourly_forecast(fd.weather).collect():
        known.setdefault(r.date, {})[r.hour] = r.forecast
    last = max(d for d, _ in rows)
    num = (last - dt.date(1970, 1, 1)).days
    (n7, p7), (n_all, p_all) = BT.predict_day(history, num, known.get(last, {}), 7, 20, 6, 42)
    assert n7 == sum(num - 7 <= x < num for x in history.day.tolist()) and n_all == sum(x < num for x in history.day.tolist())
    assert [round(float(x), 6) for x in p7] == [rows[last, h].predicted_production_kwh for h in range(24)]
    assert [round(float(x), 6) for x in p_all] == [rows[last, h].predicted_consumption_kwh for h in range(24)]
    history.y["production"][history.day >= num] = 1e9                # the future cannot matter
    (_, again), _ = BT.predict_day(history, num, known.get(last, {}), 7, 20, 6, 42)
    assert (again == p7).all()
    both = [(r, rows[r.date, r.hour]) for r in frame.collect() if (r.date, r.hour) in rows]
    want = np.mean([abs(round(r.production_kwh, 2) - round(p.predicted_production_kwh, 2)) for r, p in both])
    got = BT.accuracy(BT.compared(frame, predicted)).where("kind = 'production' and level = 'all'").first()
    assert got.n == len(both) and got.mae == pytest.approx(want, abs=1e-6)


def test_forest_learns():
    """The forest fits a step that a mean cannot, and falls back on the mean without a signal."""
    rng = np.random.default_rng(1)
    x = rng.random((400, 6))
    y = np.where(x[:, 2] > 0.5, 10.0, -10.0)
    at = np.tile(0.5, (2, 6))
    at[:, 2] = [0.1, 0.9]
    low, high = BT.forest(x, y, at, 3)
    assert low < -5 and high > 5
    assert BT.forest(np.zeros((3, 6)), np.array([1.0, 1.0, 1.0]), np.zeros((1, 6)), 1).tolist() == [1.0]


# --- episodes, matrix, views ------------------------------------------------------------------------
def test_stall_episodes(spark):
    rows = [(1, [0, 5, 9, 9, 9, 12, 12]), (2, [0, 4, 8, 10, 14, 18, 20])]
    df = spark.createDataFrame([(day(1), f"07:{15 * (k % 4):02d}:{k:02d}", i, float(v)) for i, vs in rows for k, v in enumerate(vs)],
                               "date date, time string, inv_id int, daysum double").withColumn("time", F.concat(F.lit("08:00:"), F.substring("time", 7, 2)))
    got = sorted((r.inv_id, r.start_time[-2:], r.end_time[-2:], r.n_readings, r.lost_daysum) for r in WN.stall_episodes(df).collect())
    assert got == [(1, "03", "04", 2, 6.0), (1, "06", "06", 1, 2.0)]
    assert WN.stall_episodes(df.where("inv_id = 1")).count() == 0          # without a peer nothing shows that it should have risen


def test_missing_day_ranges(spark):
    df = spark.createDataFrame([(day(d),) for d in (1, 2, 5, 6, 10, 10)] + [(None,)], "date date")
    got = sorted((r.first_day.day, r.last_day.day, r.n_days) for r in quality.missing_day_ranges({"x": df, "y": df.where("false")}).collect())
    assert got == [(3, 4, 2), (7, 9, 3)]


def test_room_month_matrix(spark):
    b = spark.createDataFrame([("R1", dt.date(2023, 2, 28), "08:00", "10:00"), ("R1", dt.date(2023, 2, 1), "08:00", "09:15"), ("R1", day(31), "8", "9")],
                              "room_id string, date date, start_time string, end_time string")
    got = {r.month: r.hours for r in marts.room_month_matrix(b).collect()}
    assert got["2023-02"] == [2] + [0] * 26 + [2] + [None] * 3 and got["2023-03"] == [0] * 30 + [1]


def test_role_views(spark):
    """A director sees their school's rooms, a technician the solar page, an unknown or missing role nothing."""
    rooms = spark.createDataFrame([("R1", "F"), ("R2", "O"), ("R3", None)], "room_id string, department string")
    solar = spark.createDataFrame([(1,), (2,)], "inv_id int")
    secure.create(spark, {"rooms": rooms, "solar": solar}, {"rooms": "department"})
    seen = lambda page, role, school=None: sorted(r[0] for r in secure.read_as(spark, page, role, school).collect())
    assert seen("rooms", "director", "F") == ["R1"] and seen("rooms", "director") == [] and seen("rooms", "technician", "F") == []
    assert seen("solar", "technician") == [1, 2] and seen("solar", "visitor", "F") == [] and seen("solar", None) == []
