"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table: a start and a stride
taken from a digest of its name.  Shards take turns; in its turn a shard claims the first slot of
its order that is still free.  The filled table sends a key to ``table[digest(key) mod size]``:
one lookup for a row, shards differ by at most one slot, and adding or removing a shard moves
little else than that shard's slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import fresh

#: A prime; over 100 slots for each of up to 655 shards.
TABLE_SIZE = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> position in ``shards``. ``size`` must be a prime of at least the number of shards
    and at most 1,048,573, which bounds what is broadcast."""
    if not _is_prime(size) or size > 1_048_573:
        raise ValueError("size must be a prime of at most 1048573")
    if not 1 <= len(shards) <= min(size, 65536) or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, 1 to min(size, 65536) of them")
    start, stride = [], []
    for name in shards:
        d = hashlib.sha256(name.encode()).digest()
        start.append(int.from_bytes(d[:8], "big") % size)
        stride.append(int.from_bytes(d[8:16], "big") % (size - 1) + 1 if size > 2 else 1)
    table, tried, claimed = [-1] * size, [0] * len(shards), 0
    while True:
        for s in range(len(shards)):
            slot = (start[s] + tried[s] * stride[s]) % size
            while table[slot] >= 0:
                tried[s] += 1
                slot = (start[s] + tried[s] * stride[s]) % size
            table[slot], tried[s], claimed = s, tried[s] + 1, claimed + 1
            if claimed == size:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 52 bits of the MD5 of its text, modulo the size; null counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard`` (a name from ``shards``).

    Rows with equal keys share a shard, repeated rows stay repeated, a null key counts as empty
    text, an empty table gives an empty table.  Input columns called ``slot`` or ``shard`` are
    replaced.  The broadcast table has ``size`` rows whatever the input is; no row is shuffled.
    """
    table = fill_table(shards, size)
    packed = bytearray(b"".join(i.to_bytes(2, "big") for i in table))
    code = F.conv(F.hex(F.substring(F.lit(bytes(packed)), (F.col("id") * 2 + 1).cast("int"), F.lit(2))), 16, 10).cast("int")
    keep = [c for c in df.columns if c.lower() not in (slot.lower(), shard.lower())]
    at, at2, name = fresh(df.columns, "__slot", "__slot2", "__shard")
    lookup = df.sparkSession.range(size).select(F.col("id").cast("int").alias(at2), code.alias("code"))
    lookup = lookup.select(at2, F.element_at(F.array(*map(F.lit, shards)), F.col("code") + 1).alias(name))
    out = df.withColumn(at, slot_of(df[key], size)).join(F.broadcast(lookup), F.col(at) == F.col(at2))
    return out.select(*[F.col(f"`{c}`") for c in keep], F.col(at).alias(slot), F.col(name).alias(shard))
