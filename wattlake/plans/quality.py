"""Validation operators (V1-V4): the keys the warehouse declares but never enforces.

Each check is an aggregate per table (or an anti join per relationship); the
results are tiny summary frames, unioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def pk_duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    """V1: per table, rows and keys seen more than once.

    The keys of every table go through one aggregation on (table, key): a key
    repeated many times is combined map-side, and the per-table totals are
    one global aggregate (tables with no rows report 0).
    """
    names = list(tables)
    keys = _union([tables[n].select(F.lit(i).alias("tbl"), F.col(schemas.PRIMARY_KEYS[n]).cast("string").alias("key"))
                   for i, n in enumerate(names)])
    per_key = keys.groupBy("tbl", "key").agg(F.count(F.lit(1)).alias("n"))
    of = lambda i, c: F.when(F.col("tbl") == i, c)
    rows = F.array(*[F.struct(F.lit(n).alias("table_name"),
                              F.coalesce(F.sum(of(i, F.col("n"))), F.lit(0)).cast("long").alias("n_rows"),
                              F.count(of(i, F.when(F.col("n") > 1, F.lit(1)))).cast("long").alias("n_duplicate_keys"))
                     for i, n in enumerate(names)])
    return per_key.agg(rows.alias("_r")).select(F.inline("_r"))


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """V2: per declared relationship, fact rows whose non-empty id has no dimension row.

    Pre-aggregate, then join: each fact is read once and its id columns are
    counted per (relationship, id) -- a hot id (e.g. 'No Error', a third of
    all rows) is combined map-side to one row per task. Only those distinct
    ids meet the dimension keys, in one anti join on (relationship, id) with
    no skew left to split; the orphan counts are one global aggregate.
    """
    rels = [(f, c, d, k) for f, c, d, k in schemas.FOREIGN_KEYS if f in tables and d in tables]
    ids = []
    for fact in dict.fromkeys(f for f, _, _, _ in rels):
        cols = [F.struct(F.lit(i).alias("rel"), F.col(c).cast("string").alias("id"))
                for i, (f, c, _, _) in enumerate(rels) if f == fact]
        ids.append(tables[fact].select(F.inline(F.array(*cols))))
    counted = (_union(ids).where(F.col("id").isNotNull() & (F.col("id") != ""))
               .groupBy("rel", "id").agg(F.count(F.lit(1)).alias("n")))
    # each dimension is read once; its keys are tagged with every relationship that references it
    refs = {}
    for i, (_, _, d, k) in enumerate(rels):
        refs.setdefault((d, k), []).append(i)
    dim_keys = _union([tables[d].select(F.explode(F.array(*[F.lit(i) for i in idx])).alias("rel"),
                                        F.col(k).cast("string").alias("id"))
                       for (d, k), idx in refs.items()]).where(F.col("id").isNotNull()).distinct()
    orphans = counted.join(dim_keys, ["rel", "id"], "left_anti")
    rows = F.array(*[F.struct(F.lit(f).alias("fact_table"), F.lit(c).alias("column_name"), F.lit(d).alias("dim_table"),
                              F.coalesce(F.sum(F.when(F.col("rel") == i, F.col("n"))), F.lit(0)).cast("long")
                              .alias("n_orphans"))
                     for i, (f, c, d, _) in enumerate(rels)])
    return orphans.agg(rows.alias("_r")).select(F.inline("_r"))


def not_null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """V3: NULL (or empty id) count of every NOT NULL column."""
    out = []
    for name, df in tables.items():
        cols = schemas.not_null_columns(name)
        agg = df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).cast("long").alias(c)
                       for c in cols])
        stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in cols]))
        out.append(agg.select(F.lit(name).alias("table_name"), stack))
    return _union(out)


def missing_day_ranges(feeds: dict[str, DataFrame]) -> DataFrame:
    """V4 as ranges: per feed, each run of calendar days without rows between two days with rows.

    Only the distinct days are ordered: one row per calendar day and feed.
    """
    days = _union([df.select(F.lit(name).alias("feed"), F.col("date").cast("date").alias("date")).where(F.col("date").isNotNull()).distinct() for name, df in feeds.items()])
    nxt = F.lead("date").over(Window.partitionBy("feed").orderBy("date"))
    gaps = days.withColumn("next", nxt).where(F.datediff("next", "date") > 1)
    return gaps.select("feed", F.date_add("date", 1).alias("first_day"), F.date_sub("next", 1).alias("last_day"), (F.datediff("next", "date") - 1).alias("n_days"))


def missing_days(feeds: dict[str, DataFrame]) -> DataFrame:
    """V4: per feed, calendar days between its first and last day with no rows.

    The calendar comes from a one-row-per-feed aggregate exploded with
    ``sequence``; loaded days are removed with an anti join.
    """
    out = []
    for name, df in feeds.items():
        days = df.select(F.col("date").cast("date").alias("date")).where(F.col("date").isNotNull()).distinct()
        cal = (days.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
               .where(F.col("lo").isNotNull())
               .select(F.explode(F.sequence("lo", "hi")).alias("date")))
        out.append(cal.join(days, "date", "left_anti").select(F.lit(name).alias("feed"), "date"))
    return _union(out)
