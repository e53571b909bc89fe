"""Placement of rows in shards by a permutation-filled lookup table.

The shards take turns at claiming slots of a table of prime size, each in the
order of its own permutation of the slots, until all are taken. The table has a
fixed size (``SLOTS``), whatever the data, so it is broadcast, and a row finds
its shard with one hash and one lookup. Shards differ by one slot at most, and
when a shard comes or goes few slots change hands beyond its own.

The table is built once, on the driver, from the names of the shards; rows are
placed with DataFrame functions alone.

Defined results: a null key is placed like the empty text; equal keys go to the
same shard; an empty table gives an empty result. Columns of the input named
``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime. With 64 shards each gets 127 or 128 slots; give a larger one for more
# than some hundred shards.
SLOTS = 8191


def hash60(text: str) -> int:
    """The first 60 bits of an MD5, the same number as in ``key_slot``."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def preference(shard: str, slots: int) -> tuple[int, int]:
    """First slot and step: with a prime number of slots, a permutation of them."""
    return hash60(f"offset:{shard}") % slots, hash60(f"step:{shard}") % (slots - 1) + 1


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must have distinct names, one at least")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, no less than that of the shards")
    owner = [-1] * slots
    places = [preference(s, slots) for s in shards]
    at = [start for start, _ in places]
    left = slots
    while left:
        for i, (_, step) in enumerate(places):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    rows = [(slot, shards[i]) for slot, i in enumerate(fill_table(shards, slots))]
    return spark.createDataFrame(rows, "slot bigint, shard string")


def key_slot(key: Column, slots: int = SLOTS) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % slots


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The rows with the columns ``slot`` and ``shard``; no row moves."""
    table = F.broadcast(lookup_table(df.sparkSession, shards, slots))
    own = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    return df.select(*own, key_slot(F.col(key), slots).alias("slot")).join(table, "slot").select(
        *own, "slot", "shard"
    )
