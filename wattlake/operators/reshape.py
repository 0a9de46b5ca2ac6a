"""Reshape and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

# --- fixed values -----------------------------------------------------------
# Per-inverter block of the wide inverter export, in file order.
INVERTER_BLOCK = ["inv_id", "pac", "daysum", "status", "error", "pdc1", "pdc2", "udc1", "udc2", "temp", "uac"]
N_INVERTERS = 5
# ---------------------------------------------------------------------------


def wide_name(block: int, field: str) -> str:
    return f"{field}_{block}"


def unpivot_inverters(wide: DataFrame, keep: list[str] = ("raw_date", "time_str"),
                      n_blocks: int = N_INVERTERS, fields: list[str] = INVERTER_BLOCK) -> DataFrame:
    """``[keep..., block1..., block5...]`` -> one row per block (one pass, no unions).

    Blocks whose columns are absent in the file are filled with NULL; rows of
    an empty block (NULL inverter id) are dropped (Q22).
    """
    present = set(wide.columns)

    def field(b, f):
        n = wide_name(b, f)
        return F.col(n) if n in present else F.lit(None).cast("string")

    blocks = F.array(*[F.struct(*[field(b, f).cast("string").alias(f) for f in fields])
                       for b in range(1, n_blocks + 1)])
    return (wide.select(*keep, F.inline(blocks))
            .where(F.col(fields[0]).isNotNull() & (F.trim(F.col(fields[0])) != "")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name, tolerating missing columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_timestamps(frames: list[tuple[DataFrame, str]], bare_hour_cols: tuple = ("start_time",)) -> DataFrame:
    """(date, normalised time) of every feed, distinct.

    Feeds lacking the time column are skipped (A13). Each feed is projected to
    two columns first, and its texts are made distinct before they are normalised: a text is
    normalised once per day, not once per row. The text is taken together with its count, which keeps filters
    on the normalised time above that step (Spark moves a filter on grouping keys alone below it, to every row).
    """
    parts = []
    for df, tcol in frames:
        if tcol not in df.columns or "date" not in df.columns:
            continue
        parts.append(df.select(F.col("date").cast("date").alias("date"), F.col(tcol).cast("string").alias("raw"), F.lit(tcol in bare_hour_cols).alias("bare")))
    texts = (union_all(parts).where(F.col("date").isNotNull() & F.col("raw").isNotNull())
             .groupBy("date", "raw", "bare").agg(F.count(F.lit(1)).alias("n"))
             .select("date", F.when(F.col("n") > 0, F.col("raw")).alias("raw"), "bare"))
    t = F.when(F.col("bare"), tx.normalize_time("raw", bare_hour=True)).otherwise(tx.normalize_time("raw"))
    return texts.select("date", t.alias("time")).distinct()


def set_difference(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (left anti join)."""
    return new.join(existing.select(*keys), keys, "left_anti")
