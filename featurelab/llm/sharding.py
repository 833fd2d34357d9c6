"""Sharding by a permutation-filled lookup table.

The table has a prime number of slots. Every shard has its own order of preference over all slots,
offset + k * skip modulo the size, from hashes of its name. The shards take turns; whoever's turn it is
claims the first slot of its order that is still free, until none is left. So all shards hold equally
many slots, give or take one, and when a shard leaves, few slots change hands beside its own.

A document is placed by the slot its id hashes to: one look into a broadcast table of fixed size,
without a shuffle. A null id is placed by the hash of its text, so rows without id do not gather in
one shard; null in both is placed like an empty text. Rows of one id share a shard. An empty table gives an empty
result. Only id and text are read, so columns with clashing names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import read

SHARDS = 64
SLOTS = 65_537  # prime, and many times the number of shards


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, size: int) -> tuple[int, int]:
    """Offset and skip of a shard's order of slots."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def fill(names: Sequence[str], size: int = SLOTS) -> list[int]:
    """The number of the shard that holds each slot."""
    if not is_prime(size) or len(names) > size or not names or len(set(names)) < len(names):
        raise ValueError("the table needs a prime size and 1 to that many different shards")
    at, skips = (list(x) for x in zip(*(preference(n, size) for n in names)))
    table, free = [-1] * size, size
    while True:
        for shard, skip in enumerate(skips):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + skip) % size
            table[slot], at[shard] = shard, (slot + skip) % size
            free -= 1
            if not free:
                return table


def slot_of(key: Column, text: Column, size: int) -> Column:
    def digits(value: Column) -> Column:
        return F.conv(F.substring(F.md5(value), 1, 12), 16, 10).cast("long")

    return F.coalesce(digits(key.cast("string")), digits(F.coalesce(text, F.lit("")))) % size


def placed(
    df: DataFrame,
    names: Sequence[str],
    size: int = SLOTS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row as a struct `row`, with its slot and shard."""
    table = df.sparkSession.createDataFrame(
        [(slot, shard, names[shard]) for slot, shard in enumerate(fill(names, size))],
        "slot bigint, shard int, shard_name string",
    )
    rows = df.select(
        F.struct(*df.columns).alias("row"), slot_of(F.col(key), F.col(text), size).alias("slot")
    )
    return rows.join(F.broadcast(table), "slot")  # `size` rows, a parameter


def write_shards(df: DataFrame, path: str, names: Sequence[str], rows_per_file: int = 1_000_000) -> str:
    """Write a folder for each shard. Large shards are dealt to several tasks, and cut into files.

    Returns the name of the column that the folders stand for: `shard`, with underscores added if the table has such a column.
    """
    taken, shard = {c.lower() for c in df.columns}, "shard"
    while shard in taken:
        shard += "_"
    rows = placed(df, names).select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns], F.col("shard_name").alias(shard))
    rows.hint("rebalance", shard).write.option("maxRecordsPerFile", rows_per_file).partitionBy(shard).parquet(path)
    return shard


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    names = [f"shard-{i:03d}" for i in range(SHARDS)]
    rows = placed(read(spark, folder, "documents").select("doc_id", "text"), names)
    return rows.select("row.doc_id", "slot", "shard")
