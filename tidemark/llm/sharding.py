"""Placement by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table. Shards
take turns; each claims the first slot in its order that is still free. A key's slot is its
hash modulo the table size, its shard the slot's owner: one probe of a small broadcast
table. Shards own almost equally many slots, and a changed shard list moves few slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 32
SLOTS = 3203
#: The largest table that is filled: its size bounds the broadcast.
MOST_SLOTS = 1_000_003


def _number(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(names: list[str], slots: int) -> list[int]:
    """Owner of each slot, as a place in ``names``."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be given once each")
    if not _is_prime(slots) or not len(names) <= slots <= MOST_SLOTS:
        raise ValueError(f"the table size must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_number(f"{n}/offset") % slots for n in names]
    step = [_number(f"{n}/skip") % (slots - 1) + 1 if slots > 2 else 1 for n in names]
    owner, left = [-1] * slots, slots
    while left:
        for i in range(len(names)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """``slot``, ``shard`` (a name) for every slot."""
    owners = F.lit(",".join(map(str, fill(names, slots))))
    labels = F.split(F.lit("\n".join(names)), "\n")
    rows = spark.range(1).select(F.posexplode(F.split(owners, ",")).alias("slot", "owner"))
    return rows.select(F.col("slot").cast("long"), F.element_at(labels, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; a null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: str, names: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``, which replace columns of these names.

    Equal keys share a shard; null keys are placed like the empty text. No row moves.
    """
    table = F.broadcast(lookup_table(df.sparkSession, names, slots))  # at most MOST_SLOTS rows
    return df.drop("shard").withColumn("slot", slot_of(F.col(key), slots)).join(table, "slot")
