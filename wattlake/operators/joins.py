"""Join helpers for attaching per-key statistics back onto rows.

Facts join small per-slot or per-day tables back onto their rows. Sort-merge
joins only get AQE's skew split when both inputs are plain shuffle stages; a
statistics table that is itself the output of a join or aggregate is
already partitioned, so a hot key would land whole in one task. ``salted_join``
spreads every key over ``buckets`` tasks regardless of plan shape: the rows
get a salt from a hash of their own columns (deterministic, so a retried
task sees the same salt) and the statistics table is replicated once per
salt value, which costs ``buckets`` copies of a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
DEFAULT_BUCKETS = 8
BUCKETS_CONF = "wattlake.saltBuckets"


def salted_join(rows: DataFrame, stats: DataFrame, keys: list[str], how: str = "left",
                buckets: int | None = None) -> DataFrame:
    """``rows.join(stats, keys, how)`` with each key split over ``buckets`` salt values.

    ``stats`` must hold at most one row per key (it is replicated per salt).
    Without ``buckets``, the session setting ``wattlake.saltBuckets`` (default 8) applies.
    """
    if buckets is None:
        buckets = int(rows.sparkSession.conf.get(BUCKETS_CONF, str(DEFAULT_BUCKETS)))
    if buckets <= 1:
        return rows.join(stats, keys, how)
    salted_rows = rows.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(buckets)))
    salted_stats = stats.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return salted_rows.join(salted_stats, keys + [SALT], how).drop(SALT)
