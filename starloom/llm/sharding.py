"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size:
``(offset + i * skip) mod size``, with offset and skip from its name's digest. The
shards take turns; in each turn a shard claims the first slot of its order that is
free, until the table is full. So all shards hold as many slots, give or take one, and
when a shard leaves, few slots besides its own change hands. A document's slot is
a digest of its key, and its shard is looked up there.

The table has ``size`` rows whatever the input, so the driver fills it and it is
broadcast; placing a document is one hash and one look-up, without a shuffle, and no
key is gathered anywhere. The size must be a prime of at least 100 slots a shard.

Cases: a null key has the slot of the empty text; equal keys share a shard; columns of
the input named ``slot`` or ``shard`` are replaced; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS_PER_SHARD = 100
MOST_SLOTS = 1_000_003  # bounds what is broadcast


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def table_size(shards: int) -> int:
    """The least prime of at least ``SLOTS_PER_SHARD`` slots a shard."""
    size = SLOTS_PER_SHARD * shards
    while not is_prime(size):
        size += 1
    return size


def _number(text: str) -> int:
    """The first 15 hexadecimal digits of the MD5, as in ``slot_of``."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], size: int) -> list[int]:
    """The shard number in each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need names, each its own")
    if not is_prime(size) or len(shards) > size or size > MOST_SLOTS:
        raise ValueError(f"the size must be a prime from the number of shards to {MOST_SLOTS}")
    place = [_number(f"offset:{name}") % size for name in shards]
    skip = [_number(f"skip:{name}") % (size - 1) + 1 if size > 2 else 1 for name in shards]
    table = [-1] * size
    left = size
    while left:
        for shard in range(len(shards)):
            while table[place[shard]] >= 0:
                place[shard] = (place[shard] + skip[shard]) % size
            table[place[shard]] = shard
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, size: int) -> Column:
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digest, 16, 10).cast("long") % size


def lookup_table(spark: SparkSession, shards: Sequence[str], size: int) -> DataFrame:
    """``slot, shard`` as a table, ``size`` rows."""
    table = ",".join(map(str, fill(shards, size)))
    return spark.sql(
        "select cast(pos as bigint) slot, cast(col as int) shard"
        f" from (select posexplode(split('{table}', ',')))"
    )


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def assign(
    docs: DataFrame, shards: Sequence[str], *, key: str = "doc_id", size: int | None = None
) -> DataFrame:
    """The documents with ``slot`` and ``shard``."""
    size = size or table_size(len(shards))
    kept = [c for c in docs.columns if c.lower() not in ("slot", "shard")]
    table = lookup_table(docs.sparkSession, shards, size)
    return (
        docs.select(*kept, slot_of(F.col(key), size).alias("slot"))
        .join(F.broadcast(table), "slot")
        .select(*kept, "slot", "shard")
    )


def write_shards(
    docs: DataFrame, shards: Sequence[str], path: str, *, key: str = "doc_id",
    size: int | None = None,
) -> None:
    """Write the documents in one folder per shard; large shards are split over tasks."""
    placed = assign(docs, shards, key=key, size=size).drop("slot")
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
