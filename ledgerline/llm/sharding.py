"""Placement of rows on shards by a permutation-filled lookup table.

Each shard prefers the slots of a table of prime size in an order of its own, a permutation given by an offset and a skip. The
shards take turns; at its turn a shard claims the first slot of its order that is still free. The table is small, so it is
broadcast, and a row finds its shard by one hash and one lookup. Losing or adding a shard moves few rows of the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.native import fresh

#: Slots of the table, a prime, and shards of the registered query.
SLOTS, SHARDS = 3203, 32
#: A table larger than this is not broadcast.
MOST_SLOTS = 1_000_003


def _digits(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The shard number that owns each slot."""
    if not shards or len(set(shards)) != len(shards) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError("needs distinct shards, no more than slots, and a table of bounded size")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    offset = [_digits(f"{s}:offset") % slots for s in shards]
    skip = [_digits(f"{s}:skip") % (slots - 1) + 1 for s in shards]
    owner, tried = np.full(slots, -1, np.int32), [0] * len(shards)
    for turn in range(slots):
        s = turn % len(shards)
        while True:
            slot = (offset[s] + tried[s] * skip[s]) % slots
            tried[s] += 1
            if owner[slot] < 0:
                owner[slot] = s
                break
    return owner


def placed(df: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with the slot and the shard of each row, by the text of its ``key``.

    Rows of the same key go together; a null key counts as the empty text. Columns already called so are replaced; all others
    and repeated rows stay. No shuffle: the table has ``slots`` short rows and is broadcast.
    """
    spark: SparkSession = df.sparkSession
    owner = lookup_table(shards, slots)
    df = df.drop(slot, shard)
    place = fresh("place", df)
    table = spark.createDataFrame([(i, shards[o]) for i, o in enumerate(owner.tolist())], f"`{place}` long, `{shard}` string")
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 15)
    found = df.withColumn(slot, F.conv(digits, 16, 10).cast("long") % slots)
    return found.join(F.broadcast(table), F.col(slot) == F.col(place)).drop(place)
