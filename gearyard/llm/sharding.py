"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table. Shards
take turns claiming the next free slot they prefer. The table is nearly even,
and when a shard goes, most keys of the others stay where they are. The table
has a fixed size, whatever the input, so broadcasting it is bounded; placing a
row is one hash and one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
SLOTS_PER_SHARD = 100
# A table of this many slots is a few hundred kB: the bound on what is broadcast.
MAX_SLOTS = 200_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def table_size(n_shards: int) -> int:
    """The smallest prime with about a hundred slots for each shard."""
    size = max(n_shards * SLOTS_PER_SHARD, 101)
    while not _is_prime(size):
        size += 1
    if size > MAX_SLOTS:
        raise ValueError(f"{n_shards} shards need a table of {size} slots; {MAX_SLOTS} is the most")
    return size


def _number(name: str, purpose: str) -> int:
    return int(hashlib.md5(f"{purpose}/{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int) -> list[int]:
    """slot -> index of its shard. Depends on names, not on their positions."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be given and differ")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    offset = [_number(name, "offset") % size for name in shards]
    skip = [_number(name, "skip") % (size - 1) + 1 for name in shards]
    asked, slots, free = [0] * len(shards), [-1] * size, size
    while True:
        for i in order:
            while slots[slot := (offset[i] + skip[i] * asked[i]) % size] >= 0:
                asked[i] += 1
            slots[slot] = i
            free -= 1
            if not free:
                return slots


def placement_key(docs: DataFrame, key: str, content: str) -> Column:
    """The key as text. A NULL key is replaced by the content's digest, so rows
    without one spread over all shards; a row with neither counts as empty."""
    digest = F.md5(F.coalesce(F.col(content), F.lit("")).cast("binary"))
    return F.coalesce(F.col(key).cast("string"), digest)


def slot_of(key: Column, size: int) -> Column:
    """The first 60 bits of the key's md5, modulo the table's size."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long") % size


def slot_table(spark: SparkSession, slots: list[int]) -> DataFrame:
    """(_slot, shard): the lookup table as rows made inside the engine."""
    listed = F.split(F.lit(",".join(map(str, slots))), ",")
    return spark.range(1).select(F.posexplode(listed).alias("_slot", "_shard")).select(
        F.col("_slot").cast("long").alias("_slot"), F.col("_shard").cast("int").alias("shard")
    )


def place(docs: DataFrame, shards: list[str] | int = SHARDS, key: str = "doc_id",
          content: str = "text") -> DataFrame:
    """The rows with their ``shard`` (a number; it replaces a column of that name).

    No shuffle: the table is broadcast, its size bounded by ``MAX_SLOTS``.
    Equal keys go to one shard, so repeated rows stay together; rows without a
    key go by their content.
    """
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    size = table_size(len(names))
    table = slot_table(docs.sparkSession, lookup_table(names, size))
    kept = [c for c in docs.columns if c != "shard"]
    slotted = docs.select(*kept, slot_of(placement_key(docs, key, content), size).alias("_slot"))
    return slotted.join(F.broadcast(table), "_slot").select(*kept, "shard")


def write_shards(placed: DataFrame, path: str, max_rows_per_file: int = 1_000_000, spread: int = 16) -> None:
    """Write each shard as files of its own folder.

    A shard is dealt over ``spread`` tasks by row content, so that one hot key
    does not make one task write a whole shard.
    """
    salt = F.pmod(F.xxhash64(*[c for c in placed.columns if c != "shard"]), F.lit(spread))
    placed.repartition("shard", salt).write.option("maxRecordsPerFile", max_rows_per_file).partitionBy(
        "shard"
    ).mode("overwrite").parquet(path)
