"""Running sums and numbers over a total order, without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.sources.shared import written

#: Rows for which one bucket is meant.
ROWS_PER_PART = 250_000


def parts_for(table: DataFrame, least: int) -> int:
    """How many buckets the rows of a written table are dealt into: ``least``, and more where those would be too large. The count comes from the files' footers."""
    return max(least, -(-table.count() // ROWS_PER_PART))


def in_ranges(df: DataFrame, by: str, parts: int | None = None) -> DataFrame:
    """``df`` written to the shared folder in ranges of ``by``, with the number of the range as ``_part``: values of a lower range come first, nulls before all.

    The width is the session's number of shuffle partitions, or ``parts``. A row finds
    its range by a search in Spark's own bounds, so many ranges cost no more than few.
    """
    dealt = df.repartitionByRange(F.col(by)) if parts is None else df.repartitionByRange(parts, F.col(by))
    return written(dealt.withColumn("_part", F.spark_partition_id()), "ranges")


def running_sum(df: DataFrame, by: str, value: Column, name: str, parts: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` up to and including the row, in order of ``by`` (unique, numeric or string).

    Sums within ranges of ``by`` run in parallel, once ``df`` is written in ranges; the
    ranges' own sums are a row each.
    """
    rows = in_ranges(df.withColumn("_value", value), by, parts)
    sums = rows.groupBy("_part").agg(F.sum("_value").alias("_sum"))
    before = sums.select("_part", (F.sum("_sum").over(W.orderBy("_part")) - F.col("_sum")).alias("_before"))  # a row per range
    inside = F.sum("_value").over(W.partitionBy("_part").orderBy(by).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("_inside", inside).join(F.broadcast(before), "_part").withColumn(name, F.col("_inside") + F.col("_before")).drop("_part", "_value", "_inside", "_before")


def number_in_order(keys: DataFrame, by: str, parts: int | None = None) -> DataFrame:
    """Add ``_rn``, counting distinct keys from 1 in their order."""
    return running_sum(keys, by, F.lit(1).cast("long"), "_rn", parts)


def batch_boundaries(df: DataFrame, by: str, rows: int) -> DataFrame:
    """``boundary``: the values of ``by`` at which batches of about ``rows`` rows end; rows of one value stay together."""
    counts = df.groupBy(by).agg(F.count("*").alias("_n"))
    summed = running_sum(counts, by, F.col("_n"), "_sum")
    return summed.where(F.floor(F.col("_sum") / rows) > F.floor((F.col("_sum") - F.col("_n")) / rows)).select(F.col(by).alias("boundary"))
