"""Window-style operators.

Group statistics are computed with ``groupBy`` + equi-join rather than an
unordered window: the aggregate combines map-side, so a hot slot does not
land whole in one task. A slot holds at most one row per inverter (or per site and
measurement), so the joins back have no hot key to split. Ordered windows are only used where the partition is
bounded by the domain (one inverter's day: at most one row per slot).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_stat_on_row(df: DataFrame, keys: list[str], stats: dict) -> DataFrame:
    """Attach per-group statistics (``{name: agg column}``) to every row."""
    agg = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(agg, keys, "left")


def most_recent(df: DataFrame, slot: list[str], issued: str = "issued") -> DataFrame:
    """The latest issue of each slot, as one combinable aggregate (equal issues: the largest row)."""
    rest = [c for c in df.columns if c not in slot and c != issued]
    last = df.groupBy(*slot).agg(F.max(F.struct(issued, *rest)).alias("_last"))
    return last.select(*slot, *[F.col(f"_last.{c}").alias(c) for c in df.columns if c not in slot])


def stalled_inverters(production: DataFrame) -> DataFrame:
    """An inverter whose ``daysum`` did not rise while a peer's did.

    ``prev_daysum`` is the inverter's previous reading of the day (ordered
    window per date and inverter: at most 96 rows). Peers rising at the same
    slot are counted with a per-slot aggregate joined back.
    """
    w = Window.partitionBy("date", "inv_id").orderBy("time")
    p = (production.select("date", "time", "inv_id", "daysum")
         .withColumn("prev_daysum", F.lag("daysum").over(w))
         .withColumn("rising", F.col("daysum") > F.col("prev_daysum")))
    slot = p.groupBy("date", "time").agg(F.count_if("rising").alias("n_rising"))
    return (p.join(slot, ["date", "time"])
            .withColumn("n_peers_rising", F.col("n_rising") - F.when(F.col("rising"), 1).otherwise(0))
            .where((F.col("daysum") <= F.col("prev_daysum")) & (F.col("n_peers_rising") > 0))
            .select("date", "time", "inv_id", "daysum", "prev_daysum", "n_peers_rising"))


def stall_episodes(production: DataFrame) -> DataFrame:
    """W4 as episodes: readings of an inverter in a row that did not rise while a peer's did, with what the risers gained meanwhile.

    Gaps and islands on the readings of one inverter's day (at most 96): readings that do not stall number the islands.
    ``lost_daysum`` is the sum over the episode of the mean rise of the peers that rose, the production that is missing.
    """
    w = Window.partitionBy("date", "inv_id").orderBy("time")
    p = production.select("date", "time", "inv_id", "daysum").withColumn("rise", F.col("daysum") - F.lag("daysum").over(w))
    slot = p.groupBy("date", "time").agg(F.count_if(F.col("rise") > 0).alias("n"), F.sum(F.when(F.col("rise") > 0, F.col("rise").cast("decimal(18,2)"))).alias("gain"))
    p = p.join(slot, ["date", "time"]).withColumn("stalled", F.coalesce((F.col("rise") <= 0) & (F.col("n") > 0), F.lit(False)))
    p = p.withColumn("island", F.sum(F.when(F.col("stalled"), 0).otherwise(1)).over(w)).where("stalled")
    return p.groupBy("date", "inv_id", "island").agg(
        F.min("time").alias("start_time"), F.max("time").alias("end_time"), F.count(F.lit(1)).alias("n_readings"),
        F.round(F.sum(F.col("gain").cast("double") / F.col("n")), 4).alias("lost_daysum")).drop("island")


def peer_underperformers(production: DataFrame, ratio: float = 0.5) -> DataFrame:
    """Readings below ``ratio`` x the mean ``pac`` of all inverters in the slot (W1 on each row)."""
    p = group_stat_on_row(production, ["date", "time"], {"peer_avg_pac": F.avg("pac"),
                                                         "n_inverters": F.count(F.lit(1))})
    return (p.where((F.col("n_inverters") > 1) & (F.col("pac") < F.col("peer_avg_pac") * ratio))
            .select("date", "time", "inv_id", "pac", "peer_avg_pac", "n_inverters"))
