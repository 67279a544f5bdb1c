"""Consistent sharding by a permutation-filled lookup table.

Each shard derives from its name an order of preference over the slots of a
prime-sized table (an offset and a step; a step below a prime visits every
slot). The shards take turns, each claiming its next free slot, until the
table is full. Shares differ by one slot at most, and a shard that leaves or
joins moves little beyond its own share. A row's slot is the hash of its key
modulo the table's size; the table is broadcast, so placement takes one hash
and one lookup, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shards and table size of the check query; the table holds over a hundred slots a shard.
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
TABLE_SIZE = 10_007
#: The table is broadcast, so its size is bounded.
MAX_TABLE = 1_000_003
#: Leading hex digits of the key's SHA-256 that make its hash (60 bits).
HASH_DIGITS = 15


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: tuple[str, ...], size: int) -> list[int]:
    """The shard (by its place in ``shards``) of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be distinct, and one at least")
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE:
        raise ValueError(f"the table size must be a prime from {len(shards)} to {MAX_TABLE}: {size}")
    order = []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        order.append((int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:16], "big") % (size - 1) + 1))
    table, tried, free = [-1] * size, [0] * len(shards), size
    while free:
        for shard, (offset, step) in enumerate(order):
            while True:
                slot = (offset + tried[shard] * step) % size
                tried[shard] += 1
                if table[slot] < 0:
                    break
            table[slot] = shard
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key; a null key is hashed as the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, HASH_DIGITS), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key_col: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE,
          carry: list[str] | None = None) -> DataFrame:
    """Add ``slot`` (int) and ``shard`` (name) of each row by its key; columns of these names give way.

    Rows with equal keys share a shard; null keys share one too. DataFrame operations only: the table enters
    as one literal string, at most MAX_TABLE slots, and is broadcast.
    """
    table = fill_table(shards, size)
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() not in ("slot", "shard")]
    lookup = (df.sparkSession.range(1)
              .select(F.posexplode(F.split(F.lit(",".join(shards[i] for i in table)), ",")).alias("slot", "shard")))
    placed = df.select(*[df[c] for c in kept], slot_of(df[key_col], size).alias("slot"))
    return placed.join(F.broadcast(lookup), "slot").select(*kept, "slot", "shard")


def write_shards(placed: DataFrame, path: str, key_col: str = "doc_id", files_per_shard: int = 4) -> None:
    """Write one folder per shard; a salt from the key spreads each shard over ``files_per_shard`` tasks."""
    salt = F.pmod(F.xxhash64(F.col(key_col)), F.lit(files_per_shard))
    placed.repartition("shard", salt).write.mode("overwrite").partitionBy("shard").parquet(path)


def place_sql(table: str = "documents", key: str = "doc_id") -> str:
    """DuckDB SQL for :func:`place` with the default shards."""
    names = ",".join(SHARDS[i] for i in fill_table(SHARDS, TABLE_SIZE))
    return f"""
WITH lookup AS (SELECT string_split('{names}', ',') AS shards),
slots AS (SELECT {key}, (('0x' || substr(sha256(coalesce(CAST({key} AS VARCHAR), '')), 1, {HASH_DIGITS}))::BIGINT
                         % {TABLE_SIZE})::INTEGER AS slot FROM {table})
SELECT {key}, slot, shards[slot + 1] AS shard FROM slots, lookup"""
