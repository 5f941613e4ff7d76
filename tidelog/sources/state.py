"""Reading the current state of a collection, and snapshots and event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.diff import split_confirms
from tidelog.specs import CollectionSpec


def read_snapshot(spark: SparkSession, path: str, coll: CollectionSpec, kind: str = "parquet") -> DataFrame:
    """A snapshot (parquet, json, csv or orc) with the collection's own schema; nothing is inferred."""
    reader = spark.read.schema(", ".join(f"`{n}` {t}" for n, t in coll.fields.items()))
    return reader.option("header", "true").format(kind).load(path)


def write_events(events: DataFrame, path: str) -> None:
    """Write changes and confirms to two folders, as they are applied apart."""
    changes, confirms = split_confirms(events)
    changes.write.mode("overwrite").parquet(f"{path}/changes")
    confirms.write.mode("overwrite").parquet(f"{path}/confirms")


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The changes and the confirms below ``path``."""
    return spark.read.parquet(f"{path}/changes"), spark.read.parquet(f"{path}/confirms")


def entities(state: DataFrame, tids: DataFrame, with_deleted: bool = False) -> DataFrame:
    """The rows of ``tids`` (column ``tid``); deleted ones only if asked for."""
    live = state if with_deleted else state.where("_date_deleted IS NULL")
    return live.join(tids, live["_tid"] == tids["tid"], "left_semi")


def current_tids(state: DataFrame, exclude_deleted: bool = True) -> DataFrame:
    return (state.where("_date_deleted IS NULL") if exclude_deleted else state).select("_tid")


def last_events(state: DataFrame) -> DataFrame:
    """``_tid, _last_event``, to be joined and not collected."""
    return state.select("_tid", "_last_event")


def column_values(state: DataFrame, source: str, column: str, key: str, value) -> DataFrame:
    """The distinct values of ``column`` where ``key`` is ``value``, within a source."""
    return state.where((F.col("_source") == source) & (F.col(key) == value)).select(column).distinct()


def last_column_value(state: DataFrame, source: str, column: str, template: str) -> DataFrame:
    """One row ``value``: the largest value of ``column`` that fits the LIKE template, within a source."""
    return state.where((F.col("_source") == source) & F.col(column).like(template)).agg(F.max(column).alias("value"))
