"""Rewrites of stored tables and events when a schema changes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.sources.eventlog import CONTENTS
from tidelog.specs import ColumnChange


def split_json(df: DataFrame, column: str, mapping: dict[str, str], types: dict[str, str]) -> DataFrame:
    """Typed columns from the keys of a JSON column: ``mapping`` is new column -> key."""
    return df.withColumns({n: F.get_json_object(column, f"$.{key}").try_cast(types[n]) for n, key in mapping.items()}).drop(column)


def merge_json(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """The inverse: one JSON column of the mapped columns, nulls kept."""
    return df.withColumn(column, F.to_json(F.struct(*[F.col(n).alias(key) for n, key in mapping.items()]), {"ignoreNullFields": "false"})).drop(*mapping)


def rename_relation(log: DataFrame, table: DataFrame, old: str, new: str, column: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Log and table after a relation's new name; swapping the arguments undoes it."""
    return log.withColumn("entity", F.when(F.col("entity") == old, new).otherwise(F.col("entity"))), table.withColumnRenamed(*column)


def column_occurrence(log: DataFrame) -> DataFrame:
    """``key, first_id, last_id``: the events between which a column occurs, in ADDs and MODIFYs. One pass."""
    c = F.from_json("contents", CONTENTS)
    keys = F.when(F.col("action") == "ADD", F.map_keys(c["entity"])).when(F.col("action") == "MODIFY", F.transform(c["modifications"], lambda m: m["key"]))
    return log.select("eventid", F.explode(keys).alias("key")).groupBy("key").agg(F.min("eventid").alias("first_id"), F.max("eventid").alias("last_id"))


@dataclass(frozen=True)
class Migration:
    """From a schema version to the next: ``changes`` are (kind, column[, new column]); kinds: add, delete, rename, split_json."""

    version: str
    following: str
    changes: tuple[tuple[str, ...], ...]


def version_boundaries(occurrence: DataFrame, migrations: list[Migration]) -> DataFrame:
    """``version, from_id``, one row per version: the first event that can have it.

    An added column's first event, one past a deleted column's last, of a rename the
    lesser of both; the least over a migration's changes. A migration whose changes
    left no trace has null, and its version begins with the next one's.
    """
    first = lambda c: F.max(F.when(F.col("key") == c, F.col("first_id")))
    after = lambda c: F.max(F.when(F.col("key") == c, F.col("last_id"))) + 1

    def bound(change) -> Column:
        kind, *columns = change
        if kind == "add":
            return first(columns[0])
        if kind == "delete":
            return after(columns[0])
        if kind == "rename":
            return F.least(after(columns[0]), first(columns[1]))
        if kind == "split_json":
            return F.lit(None).cast("long")
        raise ValueError(f"unknown kind of change: {kind}")

    one = occurrence.agg(*[F.least(*[bound(c) for c in m.changes], F.lit(None).cast("long")).alias(f"b{i}") for i, m in enumerate(migrations)])
    rows = [F.struct(F.lit(migrations[0].version).alias("version"), F.lit(0).cast("long").alias("from_id"))] + [F.struct(F.lit(m.following).alias("version"), F.col(f"b{i}").alias("from_id")) for i, m in enumerate(migrations)]
    return one.select(F.inline(F.array(*rows)))


def repair_versions(log: DataFrame, migrations: list[Migration]) -> DataFrame:
    """The log with each event's ``version`` by its id: the last version whose range has begun. The boundaries are one row per migration."""
    bounds = [(r["version"], r["from_id"]) for r in version_boundaries(column_occurrence(log), migrations).collect()]  # one row per migration
    version = F.lit(bounds[0][0])
    for name, start in bounds[1:]:
        if start is not None:
            version = F.when(F.col("eventid") >= start, name).otherwise(version)
    return log.withColumn("version", version)


def backfill_tids(log: DataFrame, entities: DataFrame) -> DataFrame:
    """Events without a tid get that of the entity with their source and source id."""
    known = entities.groupBy("_source_id", "_source").agg(F.min("_tid").alias("_known"))
    joined = log.join(known, (log["source_id"] == known["_source_id"]) & (log["source"] == known["_source"]), "left")
    return joined.withColumn("tid", F.coalesce("tid", "_known")).select(*log.columns)


def backfill_ids(table: DataFrame, has_states: bool) -> DataFrame:
    """``_tid`` from the id and state number, and ``_id`` from ``id`` where it is missing."""
    tid = F.concat("_id", F.lit("."), F.col("seqnr").cast("string")) if has_states else F.col("_id")
    return table.withColumn("_id", F.coalesce("_id", F.col("id").cast("string"))).withColumn("_tid", tid)


def change_columns(df: DataFrame, changes: list[ColumnChange]) -> tuple[DataFrame, DataFrame]:
    """The table with its columns cast and renamed, and ``column, failed``: how many values didn't survive. Type ``json`` encodes as JSON text."""
    by = {c.column: c for c in changes}

    def cast(name: str) -> Column:
        return F.to_json(F.struct(F.col(name).alias("value"))) if by[name].type == "json" else F.col(name).try_cast(by[name].type)

    out = df.select(*[cast(n).alias(by[n].rename or n) if n in by else F.col(n) for n in df.columns])
    failed = df.agg(*[F.count_if(F.col(n).isNotNull() & cast(n).isNull()).alias(n) for n in by])
    return out, failed.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("failed")) for n in by])))


def purge(log: DataFrame, catalogue: str, entity: str) -> DataFrame:
    """The log without a collection's events."""
    return log.where(~((F.col("catalogue") == catalogue) & (F.col("entity") == entity)))
