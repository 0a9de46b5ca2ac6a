"""Sharding by a permutation-filled lookup table (Maglev-style), DataFrame functions only.

Every shard walks its own permutation of a prime-sized table; shards take
turns, each claiming the next free slot of its preference order, until the
table is full. A document's slot is a hash of its key modulo the table size,
so placement is one lookup in a broadcast table: no shuffle, and a shard
owns between floor and ceil of slots / shards. Removing one shard of n moves about
1/n of the keys plus a small remainder.

Defined cases: a null key is the empty text (one fixed shard); equal keys
share a shard; an empty table gives an empty result; input columns named
like an output column (``slot``, ``shard``) are replaced by the output.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SLOTS = 1 << 20     # proven size bound of the broadcast table


def next_prime(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _hash32(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def lookup(shards: list[str], slots: int) -> list[int]:
    """Shard index of every slot. A configuration table: its size depends on the shards alone."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and not empty")
    if slots != next_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime between the number of shards and {MAX_SLOTS}")
    step = [_hash32(f"{s}:skip") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    at = [_hash32(f"{s}:offset") % slots for s in shards]
    owner, free, turn = [-1] * slots, slots, 0
    while free:
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % slots
        owner[at[i]] = i
        free, turn = free - 1, turn + 1
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    text = ",".join(map(str, lookup(shards, slots)))
    return (spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard"))
            .select("slot", F.col("shard").cast("int").alias("shard")))


def slot_of(key: Column, slots: int, seed: str = "") -> Column:
    """md5-based slot of a key."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def assign(df: DataFrame, key: str, shards: list[str], slots: int | None = None, seed: str = "") -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (index into ``shards``) of ``key``."""
    slots = slots or next_prime(100 * len(shards))
    key_col = F.col(f"`{key}`")
    placed = df.withColumn("__slot", slot_of(key_col, slots, seed))
    table = lookup_table(df.sparkSession, shards, slots).select(F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    out = placed.join(F.broadcast(table), "__slot")
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    return out.select(*keep, F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))
