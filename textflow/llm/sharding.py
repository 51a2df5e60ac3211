"""Placement of rows on shards by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.llm.tables import without

TABLE_SIZE = 65_537
# Hex digits of an MD5 that a placement uses: 60 bits, which a long holds.
HASH_DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HASH_DIGITS], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def slot_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the place of its shard in `shards`.

    Each shard has a permutation of the slots, `offset + i * skip` modulo the prime size, from hashes of its
    name. The shards take turns; in its turn a shard claims the first slot of its permutation that is still
    free. So each shard has the same number of slots, give or take one, and when a shard comes or goes few slots
    of the others change. The table has `size` entries whatever the rows are.
    """
    if not _is_prime(size):
        raise ValueError(f"{size} is not a prime")
    if not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("shards need different names and a slot each")
    at = [_number(f"{name}:offset") % size for name in shards]
    skip = [_number(f"{name}:skip") % (size - 1) + 1 for name in shards]
    slots = [-1] * size
    for turn in range(size):
        k = turn % len(shards)
        while slots[at[k]] >= 0:
            at[k] = (at[k] + skip[k]) % size
        slots[at[k]] = k
    return slots


def slot_of(keys: Sequence[Column], size: int = TABLE_SIZE) -> Column:
    """The slot of the first key that is not null; without any, that of the empty text."""
    key = F.coalesce(*[k.cast("string") for k in keys], F.lit(""))
    number = F.conv(F.substring(F.md5(key), 1, HASH_DIGITS), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(size)).cast("int")


def place(rows: DataFrame, keys: Sequence[Column], shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """Rows with `slot` and `shard` (the name).

    The lookup table has `size` rows, a parameter, so it is broadcast whatever the rows are; rows stay in their
    tasks, and one frequent key costs no more than others. Null keys pass on to the next key. Equal keys get
    equal shards, so repeated rows stay together. Empty tables stay empty. Columns `slot` and `shard` of the
    rows are replaced.
    """
    spark = rows.sparkSession
    filled = F.from_json(F.lit(json.dumps(slot_table(shards, size))), "array<int>")
    names = F.from_json(F.lit(json.dumps(list(shards))), "array<string>")
    lookup = spark.range(0, size, 1, 1).select(
        F.col("id").cast("int").alias("slot"), F.get(names, F.get(filled, F.col("id").cast("int"))).alias("shard")
    )
    kept = without(rows.withColumn("__slot_of_row", slot_of(keys, size)), "slot", "shard")
    lookup = lookup.withColumn("__slot_of_row", F.col("slot"))
    return kept.join(F.broadcast(lookup), "__slot_of_row", "left").drop("__slot_of_row")
