"""Metadata of a row: canonical text, hash, technical id; and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.specs import CollectionSpec


def as_text(column: Column, kind: str) -> Column:
    """A value as text that doesn't depend on the session: ISO dates and timestamps, decimals at their scale."""
    if kind == "timestamp":
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if kind == "date":
        return F.date_format(column, "yyyy-MM-dd")
    return column.cast(kind).cast("string")


def row_hash(columns: list[Column]) -> Column:
    """md5 over text columns; null, separators and backslashes can't be mistaken for one another."""
    escaped = [F.coalesce(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p")), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("|", *escaped))


def populate(df: DataFrame, coll: CollectionSpec, application: str, source: str) -> DataFrame:
    """Add ``_id, _tid, _version, _application, _source, _hash`` to the rows of a snapshot.

    ``_tid`` is the id, followed by the state number where the collection has
    states. The hash covers all columns in name order, the id, the version and the
    application, and not the ``_tid``.
    """
    id_ = F.col(coll.entity_id).cast("string")
    names = sorted(coll.fields)
    hashed = [as_text(F.col(n), coll.fields[n]) for n in names] + [id_, F.lit(coll.version), F.lit(application)]
    tid = F.concat(id_, F.lit("."), F.col("seqnr").cast("string")) if coll.has_states else id_
    return df.withColumns({"_id": id_, "_version": F.lit(coll.version), "_application": F.lit(application), "_source": F.lit(source), "_hash": row_hash(hashed)}).withColumn("_tid", tid)


def staged(df: DataFrame, coll: CollectionSpec) -> DataFrame:
    """The slim snapshot ``_tid, _source, _hash, _original_value``, the original as JSON with nulls kept."""
    original = F.to_json(F.struct(*[as_text(F.col(n), k).alias(n) for n, k in coll.fields.items()]), {"ignoreNullFields": "false"})
    return df.select("_tid", "_source", "_hash", original.alias("_original_value"))


def normalize_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Dates and text to timestamps, so that periods compare alike."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def text_map(coll: CollectionSpec, of: str | None = None) -> Column:
    """All fields of a row as a map from name to text, null values included."""
    at = lambda n: F.col(f"{of}.{n}") if of else F.col(n)
    return F.map_from_arrays(F.array(*[F.lit(n) for n in coll.fields]), F.array(*[as_text(at(n), k) for n, k in coll.fields.items()]))
