"""Placement of rows in shards through a permutation-filled lookup table.

The table has a prime number of slots. Every shard has an order of preference over all
slots, a permutation that follows from its name. Shards take turns, and each claims
its first free slot, until the table is full: shards end within one slot of each
other, and when a shard goes or comes, few of the other slots change hands. A row's
slot is a hash of its key, so that placing it is one look into a table of fixed size.

A null key counts as an empty text and has a place like any other; rows that repeat a
key share a shard. The table's size is a parameter and doesn't grow with the rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 32
SLOTS = 8209  # prime, over 250 slots for each shard


def names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that holds each slot."""
    if len(set(shards)) != len(shards) or not 0 < len(shards) <= slots:
        raise ValueError("shards need names of their own, and a slot each")
    if slots < 3 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be a prime over 2")
    digests = [hashlib.md5(name.encode()).hexdigest() for name in shards]
    place = [int(d[:15], 16) % slots for d in digests]
    skip = [int(d[16:31], 16) % (slots - 1) + 1 for d in digests]
    table, free = [-1] * slots, slots
    while free:
        for shard in range(len(shards)):
            while table[place[shard]] >= 0:
                place[shard] = (place[shard] + skip[shard]) % slots
            table[place[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one row per slot."""
    table = ",".join(map(str, fill(shards, slots)))
    held = F.array(*[F.lit(s) for s in shards])
    return spark.range(1).select(F.posexplode(F.split(F.lit(table), ",")).alias("slot", "_shard")).select(
        "slot", F.element_at(held, F.col("_shard").cast("int") + 1).alias("shard"))


def slot(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(key, slot, shard) of every row."""
    # `slots` rows, whatever the input.
    table = F.broadcast(lookup(rows.sparkSession, shards, slots))
    return rows.select(key, slot(F.col(key), slots).alias("slot")).join(table, "slot").select(key, "slot", "shard")
