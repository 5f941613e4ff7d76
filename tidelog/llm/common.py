"""Shared-folder tables and Arrow helpers used by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share.

    The folder is ``spark.checkpoint.dir`` of the session. Where that is unset in a
    single-machine session (tests), one temporary folder is made and the setting is
    filled in, so that later calls use the same folder. On a cluster it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the reread table.

    This cuts the lineage: what follows reads files that survive the loss of
    any executor instead of recomputing everything before.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Bound the bytes that Spark sends to a Python worker at once, where the session doesn't bound them already.

    By default a batch has up to 64 MB, of which a worker holds several copies.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, "67108864b"):  # Spark's default
        spark.conf.set(name, most)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hot_join(left: DataFrame, right: DataFrame, key: str, total: int, weight: str = "n_left", most: int = 10_000) -> DataFrame:
    """``left`` left-joined with ``right``, which has one row for a key and says in ``weight`` how many rows of ``left`` have it.

    A key with more than one in ``most`` of all ``total`` rows is hot. There are fewer
    than ``most`` of those, so their rows of ``right`` are broadcast whatever the size
    of the data; the rows of ``left`` they belong to, and those with a null key, are
    dealt by a hash of the whole row. All other keys meet in an ordinary shuffle, in
    which no key has more than that share.
    """
    names = [c for c in right.columns if c not in (key, weight)]
    side = right.select(F.col(key).alias("_key"), weight, F.struct(*names).alias("_cold"))
    hot = side.where(F.col(weight) * most > total).select(F.col("_key").alias("_hot_key"), F.col("_cold").alias("_hot"))
    marked = left.join(F.broadcast(hot), left[key] == F.col("_hot_key"), "left").drop("_hot_key")
    apart = F.when(F.col(key).isNull() | F.col("_hot").isNotNull(), F.xxhash64(*left.columns)).otherwise(0)
    none = F.shiftright(F.col(weight), 63)  # 0, but no literal: that would be folded, and the shuffle go by the key alone
    joined = marked.withColumn("_apart", apart).join(side.select("_key", "_cold", none.alias("_none")), (F.col(key) == F.col("_key")) & (F.col("_apart") == F.col("_none")), "left")
    value = F.coalesce("_hot", "_cold")
    return joined.select(*left.columns, *[value[c].alias(c) for c in names])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many leading underscores as make it different from all columns of ``df`` (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_bucket(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def _trim() -> None:
    """Give freed memory back to the system: a worker that waits for its next task would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)


def lean(run):
    """``run`` of a ``mapInArrow``, giving back a task's memory at its end."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            _trim()

    return task


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from arrays or lists, cast to the schema."""
    arrays = []
    for field in schema:
        values = columns[field.name]
        arrays.append(values if isinstance(values, pa.Array) and values.type == field.type else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each row starts; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, bounds - bounds[0]


def blocks_of(bounds: np.ndarray, most: int):
    """Runs ``(first, last)`` of rows whose bytes together stay near ``most``; a longer row is a run of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def slices(batches, most: int = 8 << 20, column: str = "text"):
    """The batches cut into runs of rows with about ``most`` bytes of ``column`` at most, which bounds a task's memory; a longer row is alone."""
    for b in batches:
        x = b.column(column)
        bounds = np.append(0, np.cumsum(pc.binary_length(x), dtype=np.int64)) if pa.types.is_binary(x.type) else text_bytes(x)[1]
        for first, last in blocks_of(bounds, most):
            yield b.slice(first, last - first)
