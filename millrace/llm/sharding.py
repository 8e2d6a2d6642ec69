"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name

# Hexadecimal digits taken from a hash: 52 bits, exact in every engine.
DIGITS = 13


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """The shard (its index) of each slot.

    A shard's preference order starts at one hash of its name and goes on in steps of
    another; as ``slots`` is prime, it visits each slot once. The shards take turns
    claiming their next free slot, so sizes differ by one at most, and a shard that goes
    gives its slots to the others while most others stay.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need names, each another")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime not below the number of shards")
    at = [_hash(f"{name}#offset") % slots for name in shards]
    step = [_hash(f"{name}#skip") % (slots - 1) + 1 for name in shards]
    table, filled = [-1] * slots, 0
    while True:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            filled += 1
            if filled == slots:
                return table


def slot_of(key: Column, slots: int) -> Column:
    """A null key is placed as an empty one."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    rows = [(slot, shards[shard]) for slot, shard in enumerate(lookup_table(shards, slots))]
    return spark.createDataFrame(rows, "slot long, shard string")


def with_shard(df: DataFrame, key: str, shards: list[str], slots: int = 65537, into: str = "shard") -> DataFrame:
    """Adds the shard of each row by its key, with the lookup table broadcast.

    The table has ``slots`` rows (a parameter, two MB at the default), whatever the
    data. Rows of a key stay together, repeated rows too. Give a hundred slots or more
    to a shard. A column named like ``into`` is replaced.
    """
    plain = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != into.lower() or c == key])
    slot, shard = free_name(plain, "slot__"), free_name(plain, "shard__")
    lookup = table_frame(df.sparkSession, shards, slots).toDF(slot, shard)
    placed = plain.withColumn(slot, slot_of(F.col(f"`{key}`"), slots)).join(F.broadcast(lookup), slot)
    return placed.select(*[F.col(f"`{c}`") for c in plain.columns if c.lower() != into.lower()],
                         F.col(shard).alias(into))
