"""Steps of the backfill (``run_log``) whose work a row grew too fast: times are normalised per distinct text, with the results of the full chain."""

import datetime as dt

from pyspark.sql import functions as F

from wattlake.functions import text as tx
from wattlake.plans import dims
from wattlake.sinks import writers as W

ODD = [None, "", " ", "7", "12", "7:5", "7:05", " 07:05 ", "07:05", "07:05\n", "7:05:09", "07:05:09", "123:45", "12:345", "24:00", "23:59:60", "23:59:59",
       "a:b", "ab:cd", "x", ":", "::", "12:34:56:78", "٧:٠٥", "\U0001f600:00", "07h05", "-7:05"]


def chain(c, bare):
    """Every text by the rewrites alone."""
    s = F.trim(F.col(c))
    if bare:
        s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^$", "00"), r"^([^:])$", "0$1"), r"^([^:]+)$", "$1:00:00")
    return F.when(F.col(c).isNotNull(), tx.zfill(F.regexp_replace(s, r"^([^:]*:[^:]*)$", "$1:00"), 8))


def test_usual_and_odd_times_as_the_chain(spark):
    rows = [(d, t) for d in (None, dt.date(1, 1, 1), dt.date(1899, 2, 28), dt.date(2024, 2, 29), dt.date(9999, 12, 31)) for t in ODD]
    df = spark.createDataFrame(rows, "date date, time string")
    parsed = F.try_to_timestamp(F.concat_ws(" ", tx.date_iso("date"), chain("time", True)), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    got = df.select("date", "time", *[x.alias(n) for n, x in (
        ("a", tx.normalize_time("time")), ("b", chain("time", False)), ("c", tx.normalize_time("time", True)), ("d", chain("time", True)),
        ("e", tx.date_time_ts("date", "time").cast("string")), ("f", parsed.cast("string")))]).collect()
    assert [r for r in got if (r.a, r.c, r.e) != (r.b, r.d, r.f)] == []
    assert sum(r.e is not None for r in got) > 10


def test_dim_time_normalises_distinct_texts(spark):
    """No rewrite and no pattern below the first aggregate, where every row of every feed would pay for it."""
    feed = lambda c: spark.createDataFrame([(dt.date(2024, 1, d), t) for d in (1, 2) for t in ("7:00", "07:00", "07:00:00", "8", None, "xx") for _ in range(3)], f"date date, {c} string")
    out = dims.dim_time(dims.collect_times(consumption=feed("time"), booking=feed("start_time")))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = max(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert [line for line in plan[first + 1:] if "regexp" in line.lower() or "rlike" in line.lower()] == []
    rows = sorted((r.Year, r.Month, r.Day, r.Hour, r.Minute, r.Second) for r in out.collect())
    assert rows == [(2024, 1, d, h, 0, 0) for d in (1, 2) for h in (7, 8)]


def test_days_counted_by_their_write(spark, scratch):
    day = lambda d: dt.date(2024, 1, d)
    df = spark.createDataFrame([(day(d) if d else None, i) for d, n in ((1, 3), (3, 5), (0, 2), (9, 1)) for i in range(n)], "date date, x int")
    w = W.Written([day(d) for d in range(1, 5)])
    W.replace_days(df, f"{scratch}/f", written=w)
    assert w.by_day() == {day(1): 3, day(2): 0, day(3): 5, day(4): 0} and w.total() == 11
