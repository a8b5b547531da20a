"""Placement by a lookup table that shards fill in turns.

Each shard prefers the slots of a prime-sized table in an order of its own: from an offset on, by a fixed step. Shards take
turns, each claiming the next free slot it prefers, until the table is full. All shards get nearly the same number of slots,
and when a shard comes or goes few keys of the others move. A key's slot is a hash of it, so placing is one look into a table
whose size is fixed, however many rows there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.frames import column

#: Slots: a prime, at least a hundred for each shard.
SLOTS = 65_537
#: The table is broadcast, so its size is checked.
MOST_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8"), digest_size=8, person=use.encode()).digest(), "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard, as its position in ``shards``, of each slot. The order of ``shards`` does not matter for who owns a slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names, and there must be one")
    if not _is_prime(slots) or slots > MOST_SLOTS or slots < len(shards):
        raise ValueError("slots must be a prime number, at least as many as shards and at most a million")
    turn = sorted(range(len(shards)), key=lambda i: shards[i])
    place = {i: _number(shards[i], "offset") % slots for i in turn}
    step = {i: _number(shards[i], "step") % (slots - 1) + 1 if slots > 1 else 1 for i in turn}
    table = [-1] * slots
    free = slots
    while True:
        for i in turn:
            at = place[i]
            while table[at] >= 0:
                at = (at + step[i]) % slots
            table[at] = i
            place[i] = (at + step[i]) % slots
            free -= 1
            if not free:
                return table


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``slot, shard`` with one row for each slot."""
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))]
    return spark.createDataFrame(rows, T.StructType.fromDDL("slot int, shard string"))


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str], slots: int = SLOTS, names: tuple[str, str] = ("slot", "shard")) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (or other ``names``). No shuffle: the table, of fixed size, is broadcast.

    Rows with equal keys share a shard. Null keys have a slot like any other value. A column of ``df`` that has one of the new
    names is an error; all other columns stay. An empty table stays empty.
    """
    if set(names) & set(df.columns):
        raise ValueError(f"the table has a column named {' or '.join(names)}; give other names")
    table = table_frame(df.sparkSession, shards, slots).select(F.col("slot").alias(names[0]), F.col("shard").alias(names[1]))
    placed = df.withColumn(names[0], slot_of(*[column(k) for k in keys], slots=slots))
    joined = placed.join(F.broadcast(table), names[0])
    return joined.select(*[column(c) for c in df.columns], *names)


def write_shards(placed: DataFrame, path: str, parts: int = 8, shard: str = "shard") -> None:
    """One folder for each shard. A shard's rows are dealt to ``parts`` tasks by content, so a large shard is no large task."""
    salt = F.pmod(F.xxhash64(*[column(c) for c in placed.columns]), F.lit(parts))
    placed.repartition(column(shard), salt).write.partitionBy(shard).parquet(path)


def moved(before: Sequence[str], after: Sequence[str], slots: int = SLOTS) -> float:
    """The share of slots, and so of keys, that change their shard."""
    old, new = lookup_table(before, slots), lookup_table(after, slots)
    return sum(before[a] != after[b] for a, b in zip(old, new)) / slots
