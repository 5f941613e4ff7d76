"""Sharding by a lookup table that the shards fill in turn from their own permutations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import shared_dir


def _number(name: str, salt: int, below: int) -> int:
    """A stable number below ``below`` from a shard's name (FNV-1a)."""
    h = 0xCBF29CE484222325 ^ salt
    for byte in name.encode():
        h = (h ^ byte) * 0x100000001B3 % 2**64
    return (h ^ h >> 29) % below


def fill_table(shards: list[str], size: int = 65537) -> np.ndarray:
    """The shard number of each slot of a table of prime ``size``.

    Shard ``s`` prefers the slots ``(offset + j * skip) % size`` for j = 0, 1, ...,
    a permutation because ``size`` is prime. The shards take turns, each claiming
    its next preferred slot that is still free, until the table is full. So their
    shares differ by one slot at most, and a shard that is added or removed moves
    little else.
    """
    if not shards:
        raise ValueError("at least one shard is needed")
    if size < len(shards) or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime of at least the number of shards")
    offset = [_number(s, 0, size) for s in shards]
    skip = [_number(s, 0x5BD1E995, size - 1) + 1 for s in shards]
    table, turn = np.full(size, -1, np.int32), 0
    for _ in range(size):
        s = turn % len(shards)
        while table[offset[s]] >= 0:
            offset[s] = (offset[s] + skip[s]) % size
        table[offset[s]] = s
        turn += 1
    return table


def place(df: DataFrame, shards: int | list[str] = 64, size: int = 65537, key: tuple[str, ...] = ("doc_id",), slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard`` (name them otherwise if they clash).

    The key's hash picks a slot, and the slot table of ``size`` rows, whatever the
    data, is broadcast: no row is shuffled, and a hot key costs no task more than
    its own rows. A row whose key columns are all null is placed by the hash of all
    its columns, so that such rows don't pile up in one shard. Rows of equal keys,
    repeated rows included, share a shard. An empty table gives an empty result.
    """
    if {slot, shard} & set(df.columns):
        raise ValueError(f"{slot} or {shard} is a column already; pass other names")
    names = [f"shard-{k:05d}" for k in range(shards)] if isinstance(shards, int) else list(shards)
    schema = T.StructType([T.StructField(slot, T.IntegerType()), T.StructField(shard, T.IntegerType())])
    table = df.sparkSession.createDataFrame(list(enumerate(fill_table(names, size).tolist())), schema)
    hash_ = F.when(F.coalesce(*[df[k].cast("string") for k in key]).isNull(), F.xxhash64(*[df[c] for c in df.columns])).otherwise(F.xxhash64(*[df[k] for k in key]))
    return df.withColumn(slot, F.pmod(hash_, F.lit(size)).cast("int")).join(F.broadcast(table), slot).select(*[df[c] for c in df.columns], slot, shard)


def write_shards(df: DataFrame, path: str, shards: int = 64, **options) -> None:
    """Write ``df`` as Parquet below ``path``, one folder per shard.

    The rows are brought together by shard and rebalanced by their bytes: adaptive
    execution splits a large shard over as many tasks as
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` calls for and joins small ones,
    so that neither files nor tasks grow with the data.
    """
    place(df, shards, **options).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def sharded(df: DataFrame, path: str, shards: int = 64) -> DataFrame:
    """``df`` written below ``path`` by ``write_shards`` and read again, with ``slot`` and ``shard``."""
    write_shards(df, path, shards)
    return df.sparkSession.read.schema(place(df, shards).schema).parquet(path)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents are written by shard; their places are those read from the files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sharded(docs, shared_dir(spark, "shards")).select("doc_id", "slot", "shard")
