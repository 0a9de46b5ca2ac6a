"""Runs over date sets.

The reference runs one process per date; here a backfill is one job over the
date set: silver is read with a partition filter on ``date`` (pruned at the
scan) and every gold plan is keyed by date already.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as tx
from ..operators import filters as FL
from ..sources import silver as SV
from ..sources.adapters import Feeds
from . import gold

FACTS = ["Power_FactTable", "Weather_FactTable", "Rooms_FactTable", "Prediction_FactTable"]


def backfill_counts(feeds: Feeds, start=None, end=None) -> DataFrame:
    """L18 + G12: rows each fact gets per calendar day of the range (0 = nothing to load).

    Without bounds the range spans every feed's first to last day.
    """
    tables = gold.build(feeds, start, end)
    counts = [tables[n].groupBy(F.col("partition_date").alias("date"))
              .agg(F.count(F.lit(1)).alias(f"n_{n.split('_')[0].lower()}_rows")) for n in FACTS]
    days = reduce(lambda a, b: a.unionByName(b),
                  [getattr(feeds, n).select(F.col("date").cast("date").alias("date")) for n in gold.FEED_NAMES])
    bounds = days.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    if start is not None and end is not None:
        bounds = bounds.select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    cal = bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("date"))
    out = cal
    for c in counts:
        out = out.join(c, "date", "left")
    return out.fillna(0)


RUN_LOG = "table_name string, date date, n_rows long, status string, error string"
CHUNK_DAYS = 92         # days that one job per table loads, and that a write counts apart


def backfill(spark: SparkSession, silver_root: str, gold_root: str, start, end, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Load gold for [start, end] from a silver lake, one job per table and chunk; returns the run log.

    The log has a row per day and fact (``loaded`` or ``empty``), a row per dimension and chunk (rows added, no day), and a
    row per day that could not be loaded (``failed``, with the error). A chunk that fails is halved until its bad days stand
    alone, so the other days are loaded. The log is also kept under ``gold_root/run_log``. What a day loads equals
    a run of that day alone, so the chunks only decide how many jobs there are.
    """
    first, last = FL.as_date(start), FL.as_date(end)
    rows: list = []
    todo = [(first + dt.timedelta(days=i), min(first + dt.timedelta(days=i + chunk_days - 1), last))
            for i in range(0, (last - first).days + 1, chunk_days)][::-1]
    while todo:
        a, b = todo.pop()
        log: list = []
        try:
            gold.load(spark, SV.read_feeds(spark, silver_root), gold_root, a, b, lambda x, y: SV.read_feed(spark, silver_root, "booking", x, y), log)
        except (PySparkException, Py4JJavaError) as e:         # of the data or the store; errors of the code itself are not caught
            if a < b:
                half = a + (b - a) // 2
                todo += [(half + dt.timedelta(days=1), b), (a, half)]
            else:
                rows.append((None, a, 0, "failed", str(e).splitlines()[0][:500]))
            continue
        rows += [(name, day, n, "loaded" if n else "empty", None) for name, day, n in log]
    done = spark.createDataFrame(rows, RUN_LOG)                 # a few rows per day
    done.coalesce(1).write.mode("append").parquet(f"{gold_root}/run_log")
    return done


def run_summary(log: DataFrame) -> DataFrame:
    """Days that were loaded, days without any row, days that failed, and the range, as one row."""
    days = log.where(F.col("date").isNotNull()).groupBy("date").agg(
        F.max(F.col("status") == "loaded").alias("loaded"), F.max(F.col("status") == "failed").alias("failed"))
    return days.agg(F.count_if("loaded").alias("dates_succeeded"), F.count_if(~F.col("loaded") & ~F.col("failed")).alias("dates_empty"),
                    F.count_if("failed").alias("dates_failed"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def future_time_rows(run_dates: DataFrame, fixed_year: int | None = 2023, days_ahead: int = 2,
                     slot_minutes: int = 15) -> DataFrame:
    """L19 + C20: DimTime rows for every slot of the next ``days_ahead`` days.

    Each target day is mapped into ``fixed_year`` on its own (Feb 29 -> 28;
    Q18 fix), so a run on Dec 30/31 still yields two days. Slots come from a
    ``sequence`` per target day, not from a cross join.
    """
    d = run_dates.select(F.col("date").cast("date").alias("run_date")).distinct()
    targets = d.select(F.explode(F.sequence(F.date_add("run_date", 1), F.date_add("run_date", days_ahead)))
                       .alias("target"))
    if fixed_year is not None:
        targets = targets.select(tx.map_into_year("target", fixed_year).alias("target"))
    targets = targets.distinct()
    start = F.col("target").cast("timestamp_ntz")
    end = start + F.expr(f"INTERVAL {24 * 60 - slot_minutes} MINUTES")
    slots = targets.select(F.explode(F.sequence(start, end, F.expr(f"INTERVAL {slot_minutes} MINUTES"))).alias("ts"))
    t = slots.select(F.to_date("ts").alias("date"), tx.ts_time("ts").alias("time"), "ts")
    return t.select(K.time_id("date", "time").alias("TimeID"),
                    *[c.alias(n) for n, c in tx.calendar_parts("ts").items()]).distinct()
