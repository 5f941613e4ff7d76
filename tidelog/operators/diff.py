"""Compare a snapshot with the current state and make events of the differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.keys import as_text, text_map
from tidelog.functions.ranges import parts_for
from tidelog.sources.shared import written
from tidelog.specs import CollectionSpec

MODES = ("full", "delete", "update")


def diff(new: DataFrame, current: DataFrame, source: str, mode: str = "full") -> DataFrame:
    """One full outer join on ``_tid`` that classifies every row.

    Only in ``current``: DELETE while live and in mode ``full`` or ``delete``, else
    left out. Only in ``new``, or deleted in ``current``: ADD. Equal hashes: CONFIRM.
    Else MODIFY. Kept are rows whose new or current ``_source`` is ``source``.
    Returns ``_tid, _source, _entity_source, _entity_tid, _last_event, _hash, type``
    and both whole rows as structs ``new`` and ``current``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    n = new.select(F.col("_tid").alias("_new_tid"), F.struct(*new.columns).alias("new"))
    c = current.select(F.col("_tid").alias("_cur_tid"), F.struct(*current.columns).alias("current"))
    joined = n.join(c, n["_new_tid"] == c["_cur_tid"], "full_outer")
    gone, deleted = F.col("_new_tid").isNull(), F.col("current._date_deleted").isNotNull()
    kind = (
        F.when(gone & deleted, "SKIP")
        .when(gone, "SKIP" if mode == "update" else "DELETE")
        .when(F.col("_cur_tid").isNull() | deleted, "ADD")
        .when(F.col("new._hash").eqNullSafe(F.col("current._hash")), "CONFIRM")
        .otherwise("MODIFY")
    )
    ours = (F.col("new._source") == source) | (F.col("current._source") == source)
    return joined.withColumn("type", kind).where((F.col("type") != "SKIP") & ours).select(
        F.col("_new_tid").alias("_tid"), F.col("new._source").alias("_source"), F.col("current._source").alias("_entity_source"), F.col("_cur_tid").alias("_entity_tid"),
        F.col("current._last_event").alias("_last_event"), F.coalesce("new._hash", "current._hash").alias("_hash"), "type", "new", "current",
    )


def initial_load(new: DataFrame) -> DataFrame:
    """The events of a first snapshot: every row an ADD, without a join."""
    return new.select("_tid", "_source", F.lit(None).cast("string").alias("_entity_source"), F.lit(None).cast("string").alias("_entity_tid"), F.lit(None).cast("long").alias("_last_event"), "_hash", F.lit("ADD").alias("type"), F.struct(*new.columns).alias("new"))


def modifications(coll: CollectionSpec, old: str = "current", new: str = "new") -> Column:
    """The fields whose text differs, as ``key, old_value, new_value`` in field order."""
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), as_text(F.col(f"{old}.{n}"), k).alias("old_value"), as_text(F.col(f"{new}.{n}"), k).alias("new_value")) for n, k in coll.fields.items()])
    return F.filter(pairs, lambda m: ~m["old_value"].eqNullSafe(m["new_value"]))


def to_events(compared: DataFrame, coll: CollectionSpec) -> DataFrame:
    """Events ``event, tid, last_event, version, hash, entity, modifications`` from ``diff``.

    ADD carries all fields as text (and the last event of a deleted predecessor),
    MODIFY the changed fields, CONFIRM and DELETE only the current row's last event.
    A MODIFY without a changed field is a CONFIRM. The current row of a MODIFY is
    already on the joined row, so nothing is looked up again.
    """
    changed = F.when(F.col("type") == "MODIFY", modifications(coll))
    events = compared.withColumn("modifications", changed)
    event = F.when((F.col("type") == "MODIFY") & (F.size("modifications") == 0), "CONFIRM").otherwise(F.col("type"))
    events = events.withColumn("event", event)
    is_ = lambda x: F.col("event") == x
    return events.select(
        "event", F.when(is_("ADD"), F.col("_tid")).otherwise(F.coalesce("_entity_tid", "_tid")).alias("tid"), F.col("_last_event").alias("last_event"), F.lit(coll.version).alias("version"),
        F.when(is_("ADD") | is_("MODIFY"), F.col("_hash")).alias("hash"), F.when(is_("ADD"), text_map(coll, "new")).alias("entity"), F.when(is_("MODIFY"), F.col("modifications")).alias("modifications"),
    )


def split_confirms(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes, and confirms (single or bulk)."""
    confirm = F.col("event").isin("CONFIRM", "BULKCONFIRM")
    return events.where(~confirm), events.where(confirm)


def spread_key(column: Column, buckets: int) -> Column:
    """A stable bucket number from the first 32 bits of an md5."""
    return F.pmod(F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def pack_confirms(confirms: DataFrame, most: int | None = 10_000, buckets: int | None = None, part: int | None = None) -> DataFrame:
    """CONFIRMs packed into BULKCONFIRMs of at most ``most`` members; a lone one stays a CONFIRM.

    Packs are made within hash buckets of the tid, in tid order, so packing is parallel and repeatable;
    there are 64 buckets, or more for very many confirms, which are written first then. Without
    ``most`` a bucket is one pack. With ``part`` a pack takes a row for every ``part`` members, so
    that no row grows with the table; its rows have one ``pack`` number and are one event, for
    ``assign_ids`` gives them one id. Returns ``event, tid, last_event, confirms, pack``.
    """
    if part is not None and part < 2:
        raise ValueError("part must be 2 or more: a first row of one member is a pack of one")
    if buckets is None:
        confirms = written(confirms, "confirms")
        buckets = parts_for(confirms, 64)
    nth = F.row_number().over(W.partitionBy("_bucket").orderBy("tid", "last_event")) - 1
    numbered = confirms.withColumn("_bucket", spread_key(F.col("tid"), buckets)).withColumn("_nth", nth)
    numbered = numbered.withColumn("_pack", F.floor(F.col("_nth") / most) if most else F.lit(0).cast("long"))
    within = F.col("_nth") - F.col("_pack") * (most or 0)
    numbered = numbered.withColumn("_row", F.floor(within / part) if part else F.lit(0).cast("long"))
    packed = numbered.groupBy("_bucket", "_pack", "_row").agg(F.array_sort(F.collect_list(F.struct("tid", "last_event"))).alias("confirms"))
    one = (F.size("confirms") == 1) & (F.col("_row") == 0)  # a later row of one member is the rest of a pack
    first = F.get("confirms", F.lit(0))
    number = F.when(~one, F.col("_pack") * buckets + F.col("_bucket"))
    return packed.select(F.when(one, "CONFIRM").otherwise("BULKCONFIRM").alias("event"), F.when(one, first["tid"]).alias("tid"), F.when(one, first["last_event"]).alias("last_event"), F.when(~one, F.col("confirms")).alias("confirms"), number.alias("pack"))


def compare_stats(new: DataFrame, events: DataFrame) -> DataFrame:
    """``metric, n``: rows received, and events of each type."""
    received = new.agg(F.count("*").alias("n")).select(F.lit("received").alias("metric"), "n")
    return received.unionByName(events.groupBy(F.col("event").alias("metric")).agg(F.count("*").alias("n")))
