"""Bronze micro fixtures -> silver -> gold, and idempotent sinks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.plans import gold, silver
from wattlake.sinks import writers as W
from wattlake.sources import raw
from wattlake.sources import silver as SV


def write(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def inverter_line(date, time, blocks):
    cells = [date, time]
    for inv, pac, daysum, status, err in blocks:
        cells += [str(inv), pac, daysum, status, err, "1", "2", "3", "4", "25", "230"]
    return ";".join(cells)


@pytest.fixture()
def bronze(scratch):
    b = f"{scratch}/raw"
    # Another separator, and a header (with its lines) of six columns
    write(f"{b}/mixed/03/10.03.2023-Humidity.csv", "Datum;Zeit;Einheit;Wert;Var\n10.03.2023;07:15;%;45,5;0,5\n", "utf-16")
    write(f"{b}/mixed/03/11.03.2023-Humidity.csv", "Datum\tZeit\tEinheit\tWert\tVar\tNotiz\n11.03.2023\t07:15\t%\t46,5\t0,5\tok\n"
          "11.03.2023\t07:30\t%\t47,5\t0,5\n11.03.2023\t07:45\t%\t48,5\t0,5\ta\tb\n", "utf-16")
    write(f"{b}/mixed/sensor.csv", "Datum;Zeit;Einheit;Wert;Var\n12.03.2023;\"07:15\";\"%;x\";1;2\n", "utf-16")
    # UTF-16 (BOM), tab, header present but ignored by name
    write(f"{b}/humidity/03/01.03.2023-Humidity.csv", "\r\n".join([
        "Datum\tZeit\tEinheit\tWert\tVar",
        "01.03.2023\t07:15\t%\t45,5\t0,5",       # good
        "02.03.2023\t07:30\t%\tabc\t0,1",        # bad number -> dropped
        "31.02.2023\t07:45\t%\t44,0\t0,1",       # bad date -> dropped
        "03.03.2023\t08:00\t%\t40,0",            # short line -> kept, variation NULL
        "04.03.2023\t08:15\t%\t41,0\t0,2\tx",    # long line -> dropped
        "05.04.2023\t08:30\t%\t42,0\t0,3",       # wrong month folder -> dropped
        "6.3.2023\t9:00\t%\t43,25\t1",           # single digits accepted
    ]) + "\r\n", "utf-16")
    # Wide inverter export, UTF-8 BOM, ';'
    write(f"{b}/solar/03/min230301.csv", "\n".join([
        ";".join(["#Date", "Time"] + [f"{h}{i}" for i in range(1, 6) for h in
                                      ["INV", "Pac", "DaySum", "Status", "Error", "Pdc1", "Pdc2", "Udc1", "Udc2",
                                       "Temp", "Uac"]]),
        inverter_line("01.03.23", "07:15:00", [(i, str(100 * i), str(10 * i), "6", "0") for i in range(1, 6)]),
        inverter_line("01.03.23", "07:30:00", [(i, "0" if i == 2 else str(100 * i), str(20 * i), "6",
                                                "3" if i == 2 else "0") for i in range(1, 6)]),
        inverter_line("xx.03.23", "07:45:00", [(i, "1", "1", "6", "0") for i in range(1, 6)]),  # bad date
    ]) + "\n", "utf-8-sig")
    # A3/D3: weather forecast issues
    for name, rows in [("Pred_2023-03-01_0600.csv", ["2023-03-01T07:00:00Z,5.5,6.0,siteA,temp,C",
                                                     "2023-03-01T08:00:00Z,-99999.0,6.0,siteA,temp,C",
                                                     "2023-03-01T09:00:00+01:00,,6.5,siteA,temp,C",
                                                     "garbage,1,1,siteA,temp,C"]),
                       ("Pred_2023-03-01_1200.csv", ["2023-03-01T07:00:00Z,5.7,6.1,siteA,temp,C"])]:
        write(f"{b}/weather/03/{name}", "\n".join(["time,value,prediction,site,measurement,unit"] + rows) + "\n",
              "utf-8-sig")
    # Two booking exports, the lexicographically last one wins
    header = "\t".join(["Nom", "Nom Entier", "Date", "Date de début", "Date de fin", "Rés.-no", "Activité",
                        "Professeur", "Division", "Nom de l'utilisateur", "Classe"])
    write(f"{b}/booking/03/RoomAllocations_202303.csv", header + "\nR1\tRoom 1\t05 mars 2023\t08:00\t10:00\t1\tA\tP\tD\tU\tC\n",
          "utf-8-sig")
    write(f"{b}/booking/04/RoomAllocations_202304.csv", "\n".join([
        header,
        '"R1"\tRoom 1\t01 mars 2023\t08:00\t10:00\t10\tLecture\tProf X\tINF\tJane\tC1',
        "R2\tRoom 2\t01 mars 2023\t08:00\t09:00\t11\t\tnan\tINF\tNone\tC1",
        "R1\tRoom 1\t02 avr. 2023\t13:00\t15:00\t12\tLab\tProf Y\tBIO\tJoe\tC2",
        "R3\tRoom 3\t?? ?? ????\t9\t10\t13\tLab\tProf Y\tBIO\tJoe\tC2",
    ]) + "\n", "utf-8-sig")
    return b


def test_sensor_scan_and_clean(spark, bronze):
    df = raw.read_sensor(spark, f"{bronze}/humidity/*/")
    assert set(df.select("feed", "month").distinct().collect()[0]) == {"Humidity", "03"}
    rows = sorted(silver.clean_sensor(df).collect(), key=lambda r: r.date)
    assert [(r.date, r.time, r.value_acquired, r.variation) for r in rows] == [
        (dt.date(2023, 3, 1), "07:15", 45.5, 0.5),
        (dt.date(2023, 3, 3), "08:00", 40.0, None),
        (dt.date(2023, 3, 6), "9:00", 43.25, 1.0)]


def test_sensor_separator_and_width_per_file(spark, bronze):
    """Each file has its own separator and width; five columns are taken; lines beyond the header's width go, with a reason."""
    rows = sorted(silver.clean_sensor(raw.read_sensor(spark, f"{bronze}/mixed")).collect(), key=lambda r: (r.date, r.time))
    assert [(r.date.day, r.time, r.value_acquired) for r in rows] == [(10, "07:15", 45.5), (11, "07:15", 46.5), (11, "07:30", 47.5)]
    bad = silver.sensor_rejects(raw.read_sensor(spark, f"{bronze}/mixed", keep_bad=True)).collect()
    assert sorted((r.file_name, r.reason) for r in bad) == [("11.03.2023-Humidity.csv", "too many cells"), ("sensor.csv", "no month folder")]
    quoted = raw.read_sensor(spark, f"{bronze}/mixed/sensor.csv").first()
    assert (quoted.time_str, quoted.unit, quoted.val_raw) == ("07:15", "%;x", "1")


def test_corrupt_input_fails(spark, scratch):
    """Malformed text, a corrupt feed or an unreadable table is an error; only a missing path is empty."""
    os.makedirs(f"{scratch}/in/03")
    with open(f"{scratch}/in/03/01.03.2023-Humidity.csv", "wb") as fh:
        fh.write(b"\xff\xfe\x00\xd8\x00\xd8")
    with pytest.raises(Exception):
        raw.read_sensor(spark, f"{scratch}/in").collect()
    os.makedirs(f"{scratch}/lake/humidity/date=2023-03-01")
    with open(f"{scratch}/lake/humidity/date=2023-03-01/part-0.parquet", "wb") as fh:
        fh.write(b"no parquet")
    with pytest.raises(Exception):
        SV.read_feed(spark, f"{scratch}/lake", "humidity").collect()
    with pytest.raises(Exception):
        W.upsert_dim(spark, spark.createDataFrame([("k", 1)], "id string, v int"), f"{scratch}/lake/humidity", "id")
    assert os.listdir(f"{scratch}/lake/humidity") == ["date=2023-03-01"]
    assert SV.read_feed(spark, f"{scratch}/lake", "temperature").count() == 0


def test_wider_inverter_export(spark, scratch):
    """A sixth block is ignored, the first five are kept."""
    head = ["#Date", "Time"] + [f"{h}{i}" for i in range(1, 7) for h in ["INV", "Pac", "DaySum", "Status", "Error", "Pdc1", "Pdc2", "Udc1", "Udc2", "Temp", "Uac"]]
    line = inverter_line("01.03.23", "07:15:00", [(i, str(100 * i), "1", "6", "0") for i in range(1, 7)])
    write(f"{scratch}/solar/03/min230301.csv", ";".join(head) + "\n" + line + "\n", "utf-8-sig")
    rows = silver.clean_production(raw.read_inverters(spark, f"{scratch}/solar")).collect()
    assert sorted((r.inv_id, r.pac, r.status) for r in rows) == [(i, 100.0 * i, "6") for i in range(1, 6)]


def test_month_replace_drops_withdrawn_days(spark, scratch):
    """B1: a day that left its month's source leaves the feed; other months stay."""
    day = lambda m, d: dt.date(2023, m, d)
    make = lambda rows: spark.createDataFrame(rows, "date date, v int")
    W.replace_months(make([(day(3, 1), 1), (day(3, 2), 2), (day(4, 1), 3)]), f"{scratch}/feed")
    W.replace_months(make([(day(3, 2), 5)]), f"{scratch}/feed")
    assert sorted((r.date, r.v) for r in spark.read.parquet(f"{scratch}/feed").collect()) == [(day(3, 2), 5), (day(4, 1), 3)]


def test_inverter_unpivot(spark, bronze):
    rows = silver.clean_production(raw.read_inverters(spark, f"{bronze}/solar/*/")).collect()
    assert len(rows) == 10  # 2 good lines x 5 blocks; the bad date line is dropped
    r = [x for x in rows if x.time == "07:30:00" and x.inv_id == 2][0]
    assert (r.pac, r.daysum, r.error, r.pdc1, r.uac) == (0.0, 40.0, 3.0, 1.0, 230.0)


def test_weather_clean(spark, bronze):
    df = raw.read_weather(spark, f"{bronze}/weather/*/")
    rows = sorted(silver.clean_weather(df).collect(), key=lambda r: (r.time, r.issued))
    assert [(r.time, r.value, r.issued.hour) for r in rows] == [
        ("07:00:00", 5.5, 6), ("07:00:00", 5.7, 12), ("08:00:00", None, 6)]


def test_booking_latest_file(spark, bronze):
    rows = sorted(silver.clean_booking(raw.read_booking(spark, f"{bronze}/booking/")).collect(),
                  key=lambda r: r.reservation_id)
    assert [r.reservation_id for r in rows] == ["10", "11", "12", "13"]
    assert rows[0].room_id == "R1" and rows[0].date == dt.date(2023, 3, 1)
    assert (rows[1].activity_type, rows[1].instructor, rows[1].reserved_by) == ("EMPTY", "EMPTY", "EMPTY")
    assert rows[3].date == dt.date(1900, 1, 1)


def test_silver_to_gold_idempotent(spark, bronze, scratch):
    s = f"{scratch}/silver"
    silver.load_sensor(spark, f"{bronze}/humidity/*/", f"{s}/humidity")
    silver.load_production(spark, f"{bronze}/solar/*/", f"{s}/production")
    silver.load_weather(spark, f"{bronze}/weather/*/", f"{s}/weather")
    silver.load_booking(spark, f"{bronze}/booking/", f"{s}/booking")
    # a re-run of a day replaces only that day (B1)
    silver.load_sensor(spark, f"{bronze}/humidity/*/", f"{s}/humidity")
    assert SV.read_feed(spark, s, "humidity").count() == 3
    assert SV.read_feed(spark, s, "humidity", "2023-03-03", "2023-03-03").count() == 1
    assert SV.read_feed(spark, s, "temperature").count() == 0  # A12: missing feed -> empty
    feeds = SV.read_feeds(spark, s)
    g = f"{scratch}/gold"
    first = gold.load(spark, feeds, g)
    again = gold.load(spark, feeds, g)
    assert first["DimInverter"] == 5 and first["DimRoom"] == 3
    assert all(v == 0 for v in again.values())  # B4: second load adds nothing
    pf = spark.read.parquet(f"{g}/Power_FactTable")
    assert pf.count() == 10  # B5: day replaced, not duplicated
    assert pf.where(F.col("ConsumptionID") != "").count() == 0  # no consumption feed


def test_upsert_and_replace(spark, scratch):
    path = f"{scratch}/dim"
    a = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 3)], "id string, v int")
    assert W.upsert_dim(spark, a, path, "id") == 2  # in-batch duplicate keys collapse (Q11)
    b = spark.createDataFrame([("k2", 9), ("k3", 3)], "id string, v int")
    assert W.upsert_dim(spark, b, path, "id") == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ["k1", "k2", "k3"]
    facts = f"{scratch}/fact"
    d1, d2 = dt.date(2023, 3, 1), dt.date(2023, 3, 2)
    W.replace_fact_days(spark.createDataFrame([("a", d1), ("b", d2)], "FactID string, partition_date date"), facts)
    W.replace_fact_days(spark.createDataFrame([("c", d2)], "FactID string, partition_date date"), facts)
    W.replace_fact_days(spark.createDataFrame([], "FactID string, partition_date date"), facts)
    assert sorted(r.FactID for r in spark.read.parquet(facts).collect()) == ["a", "c"]


def test_create_tables(spark, scratch):
    W.create_tables(spark, f"{scratch}/wh", schemas.catalogue())
    assert sorted(os.listdir(f"{scratch}/wh")) == sorted(schemas.GOLD)
    assert spark.read.parquet(f"{scratch}/wh/DimTime").columns == schemas.GOLD["DimTime"].fieldNames()


def test_missing_columns_get_defaults(spark):
    """No error column -> '0' / 'No Error'; no pac -> running share 0; missing measures -> 0."""
    from wattlake.operators import aggregates as G
    from wattlake.plans import dims, facts
    prod = spark.createDataFrame([(dt.date(2023, 3, 1), "07:15", 1, 10.0)], "date date, time string, inv_id int, daysum double")
    cons = spark.createDataFrame([], "date date, time string, value_acquired double, variation double")
    assert [tuple(r) for r in dims.dim_errors(prod).select("Error_info").collect()] == [("No Error",)]
    assert G.running_pct(prod).first().pct_running == 0.0
    f = facts.power_fact(prod.withColumn("pac", F.lit(None).cast("double")), cons).first()
    assert (f.Status, f.PDC1, f.ConsumptionID, f.Total_Consumption_End_of_day, f.TimeID != "") == (
        "Unknown", 0.0, "", 0.0, True)


def test_delimited_export_round_trip(spark, scratch):
    """Redacted booking export with ';' reads back the same rows."""
    from wattlake.functions import text as tx
    df = spark.createDataFrame([("R1", "Jane", ""), ("R2", "", "Prof X")], "room_id string, reserved_by string, instructor string")
    out = df.select("room_id", tx.redact("reserved_by").alias("reserved_by"), tx.redact("instructor").alias("instructor"))
    W.export_delimited(out, f"{scratch}/export", sep=";")
    back = spark.read.option("header", True).option("sep", ";").csv(f"{scratch}/export").fillna("")
    assert sorted(map(tuple, back.collect())) == [("R1", "ANONYMIZED", ""), ("R2", "", "ANONYMIZED")]


def test_backfill_log(spark, scratch):
    """A day whose file is damaged is logged as failed, the others are loaded and counted by their own writes."""
    from wattlake.plans import run
    day = lambda d: dt.date(2023, 3, d)
    rows = [(day(d), f"{h:02d}:00:00", i, float(h + i), float(h), "6", 0.0) for d in (1, 2, 4) for h in (7, 8) for i in (1, 2)]
    made = spark.createDataFrame(rows, "date date, time string, inv_id int, pac double, daysum double, status string, error double")
    s, g = f"{scratch}/silver", f"{scratch}/gold"
    W.replace_days(W.conform(made, schemas.PRODUCTION), f"{s}/production")
    part = [f for f in os.listdir(f"{s}/production/date=2023-03-02") if f.endswith(".parquet")][0]
    os.remove(f"{s}/production/date=2023-03-02/.{part}.crc")
    with open(f"{s}/production/date=2023-03-02/{part}", "wb") as fh:
        fh.write(b"no parquet")
    log = run.backfill(spark, s, g, "2023-03-01", "2023-03-04")
    power = {r.date: (r.n_rows, r.status) for r in log.where("table_name = 'Power_FactTable'").collect()}
    assert power == {day(1): (4, "loaded"), day(3): (0, "empty"), day(4): (4, "loaded")}
    assert [(r.date, r.status) for r in log.where("status = 'failed'").collect()] == [(day(2), "failed")]
    assert spark.read.parquet(f"{g}/Power_FactTable").count() == 8
    r = run.run_summary(spark.read.parquet(f"{g}/run_log")).first()
    assert (r.dates_succeeded, r.dates_empty, r.dates_failed, r.first_date, r.last_date) == (2, 1, 1, day(1), day(4))
    assert sum(x.n_rows for x in log.where("table_name = 'DimInverter' and date is null").collect()) == 2


def test_catalog_ddl_create_and_drop(spark, scratch):
    """16 tables registered with day partitioning and key descriptions; drop-all empties the database."""
    names = W.create_catalog_tables(spark, f"{scratch}/wh", "gold_test")
    assert len(names) == 16
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE gold_test.Power_FactTable").collect()}
    assert "DimTime.TimeID" in desc["TimeID"] and desc["FactID"].startswith("surrogate key")
    assert spark.table("gold_test.Rooms_FactTable").count() == 0
    W.drop_catalog_tables(spark, "gold_test")
    assert [t.name for t in spark.catalog.listTables("gold_test") if not t.isTemporary] == []


def test_default_run_date(spark):
    from wattlake.functions import text as tx
    r = spark.range(1).select(tx.default_run_date(0).alias("a"), tx.default_run_date(1095).alias("b")).first()
    assert (r.a - r.b).days == 1095 and r.a < dt.date.today() + dt.timedelta(days=1)


def test_backfill_from_silver(spark, bronze, scratch):
    """One job over a date set reads silver with day pruning and loads gold for those days only."""
    from wattlake.plans import run
    s = f"{scratch}/silver"
    silver.load_production(spark, f"{bronze}/solar/*/", f"{s}/production")
    silver.load_booking(spark, f"{bronze}/booking/", f"{s}/booking")
    g = f"{scratch}/gold"
    run.backfill(spark, s, g, "2023-03-01", "2023-03-01")
    assert spark.read.parquet(f"{g}/Power_FactTable").count() == 10
    rooms = spark.read.parquet(f"{g}/Rooms_FactTable")
    assert [r.partition_date for r in rooms.select("partition_date").distinct().collect()] == [dt.date(2023, 3, 1)]
