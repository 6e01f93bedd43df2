"""Sharding by a permutation-filled lookup table.

Each shard has a preference order of the slots of a prime-sized table (an offset and a step, both from a hash of
its name). Shards take turns; in its turn a shard claims its next free slot, or as many as its weight says. A row
goes to the shard in the slot of its key's hash. The table has a fixed size, so it is broadcast, and losing a
shard moves few keys of the others.

A null key has a slot of its own kind (it hashes as the empty text); equal keys share a shard; columns of the
input stay, and are replaced where they are called ``slot`` or ``shard``. A table without rows gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime far above the number of shards; its rows, of two numbers and a name, bound the broadcast.
SLOTS = 65_537


def preferences(name: str, slots: int) -> tuple[int, int]:
    """Offset and step of the order in which a shard wants the slots."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill(shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> np.ndarray:
    """The index of the shard (in the order given) that owns each slot; a mapping gives whole-number weights."""
    names = list(shards)
    weights = [shards[n] for n in names] if isinstance(shards, Mapping) else [1] * len(names)
    if not names or len(set(names)) < len(names) or min(weights) < 0 or not sum(weights):
        raise ValueError("shards need different names and weights of which one is above 0")
    if slots < len(names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime above the number of shards")
    orders = []
    for name in names:
        offset, step = preferences(name, slots)
        orders.append(iter((offset + step * np.arange(slots, dtype=np.int64)) % slots))
    table = np.full(slots, -1, dtype=np.int32)
    free = slots
    while free:
        for shard, weight in enumerate(weights):
            for _ in range(min(weight, free)):
                slot = next(s for s in orders[shard] if table[s] < 0)
                table[slot] = shard
                free -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, modulo the table's size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def lookup(spark: SparkSession, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> DataFrame:
    """The table as rows (slot, shard)."""
    names = list(shards)
    owners = fill(shards, slots).tolist()
    return spark.createDataFrame([(i, names[o]) for i, o in enumerate(owners)], "slot long, shard string")


def place(df: DataFrame, key: str, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> DataFrame:
    """``df`` with the slot and the shard of each row."""
    table = F.broadcast(lookup(df.sparkSession, shards, slots))
    return df.withColumn("slot", slot_of(F.col(f"`{key}`"), slots)).drop("shard").join(table, "slot")


def write_shards(df: DataFrame, path: str, key: str, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> None:
    """One folder of Parquet files for each shard; a large shard is cut into several files by adaptive execution."""
    placed = place(df, key, shards, slots)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
