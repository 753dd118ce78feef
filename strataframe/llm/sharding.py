"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table (an offset and a skip made from its name). The
shards take turns; each claims the next slot of its permutation that is still free, until none is. A key belongs to the
shard in slot ``hash(key) mod size``. Shards differ by one slot at most, and when one goes, few keys of others move.

The table (its size is a parameter, 65,537 by default) is a literal in the plan, four bytes a slot, that Spark broadcasts
to the executors with the stage; placement is one lookup for a row, without a join or a shuffle, so hot sources or keys cost nothing.

Cases: a null key is placed as the text ``\\N``. Equal keys go to the same shard, so repeated rows stay together. Texts
are not read. Extra columns pass through; an existing column of the output's name makes it ``shard_2`` and so on. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

SIZE = 65_537
SHARDS = 64


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(names: list[str], size: int = SIZE) -> list[int]:
    """Slot -> position in ``names``. ``size`` must be a prime that exceeds their number."""
    if len(names) >= size or size < 3 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("size must be a prime above the number of shards")
    at = [_number(f"offset:{n}") % size for n in names]
    skip = [_number(f"skip:{n}") % (size - 1) + 1 for n in names]
    table = [-1] * size
    left = size
    while left:
        for i in range(len(names)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot(key: Column, size: int = SIZE) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo ``size``."""
    text = F.coalesce(key.cast("string"), F.lit("\\N"))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % size).cast("int")


def shard(df: DataFrame, names: list[str], key: str = "doc_id", size: int = SIZE, out_col: str = "shard") -> DataFrame:
    """Adds the position in ``names`` of each row's shard."""
    table = F.lit(b"".join(i.to_bytes(4, "big") for i in lookup_table(names, size)))
    entry = F.substring(table, 4 * slot(F.col(key), size) + 1, F.lit(4))
    return df.withColumn(fresh(df, out_col), F.conv(F.hex(entry), 16, 10).cast("int"))
