"""Operator 4: sharding by a permutation-filled lookup table.

Every shard ranks the slots of a table of prime size by its own preference (offset and step derived
from its name); the shards take turns, each claiming the next slot of its list that is still free,
until the table is full. A key goes to the shard in slot ``hash(key) mod size``: one probe of a
broadcast table, no shuffle. Shards get equal shares, and adding or removing one moves few keys.

The table has ``TABLE_SIZE`` rows whatever the data (the proven bound of what is broadcast).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import fresh

TABLE_SIZE = 65_537  # prime; at least 100 times the shards keeps shares within about 1 %
SHARDS = 64


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, key=salt.encode()).digest(), "big")


def fill_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Shard number per slot. ``size`` must be a prime above the number of shards."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be given and differ")
    if size <= len(names) or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime above the number of shards")
    at = [_number(name, "offset") % size for name in names]
    step = [_number(name, "step") % (size - 1) + 1 for name in names]
    table = [-1] * size
    free = size
    while free:
        for shard in range(len(names)):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + step[shard]) % size
            table[slot] = shard
            at[shard] = (slot + step[shard]) % size
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key; a null key has a slot of its own making (the hash of null), like any other."""
    return F.pmod(F.xxhash64(key), F.lit(size)).cast("int")


def table_frame(spark: SparkSession, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    rows = [(slot, shard, names[shard]) for slot, shard in enumerate(fill_table(names, size))]
    return spark.createDataFrame(rows, "slot int, shard int, shard_name string")


def place(docs: DataFrame, names: list[str] | None = None, key: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` plus slot, shard and shard_name (the names get a trailing ``_`` if taken).

    Equal keys always meet in one shard; null keys too; an empty table gives no rows.
    """
    names = names or shard_names(SHARDS)
    slot, shard, label = (fresh(docs, c) for c in ("slot", "shard", "shard_name"))
    table = table_frame(docs.sparkSession, names, size).toDF(slot, shard, label)
    rows = docs.withColumn(slot, slot_of(F.col(key), size)).join(F.broadcast(table), slot)
    return rows.select(*docs.columns, slot, shard, label)


def write_shards(docs: DataFrame, path: str, names: list[str] | None = None, key: str = "doc_id") -> None:
    """Write ``docs`` with one folder per shard. The rebalance hint lets Spark cut a shard that a hot key
    has made large into several files and put small ones together."""
    placed = place(docs, names, key)
    label = placed.columns[-1]
    placed.drop(*placed.columns[-3:-1]).hint("rebalance", label).write.partitionBy(label).parquet(path)
