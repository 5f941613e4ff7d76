"""Fold the tail of the event log into the current state."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.skew import frequent, spread_join
from tidelog.sources.eventlog import CONTENTS, model_status
from tidelog.sources.shared import written
from tidelog.specs import CollectionSpec

META = {"_tid": "string", "_source": "string", "_application": "string", "_version": "string", "_hash": "string", "_last_event": "long", "_date_created": "timestamp", "_date_modified": "timestamp", "_date_deleted": "timestamp", "_date_confirmed": "timestamp"}


@dataclass
class Folded:
    """The new state; events that break the rules; events on objects that don't exist; and up to which event the log is applied, where that is known."""

    state: DataFrame
    violations: DataFrame
    orphans: DataFrame
    applied: int | None = None


def _latest(value: Column, when: Column) -> Column:
    """The value at the highest event id for which ``when`` holds, wrapped with that id so that a null value counts."""
    return F.max_by(F.struct(value.alias("v"), F.col("eventid").alias("e")), F.when(when, F.col("eventid")))


def judged(state: DataFrame, log_tail: DataFrame, pieces: int | None = None) -> DataFrame:
    """The events of objects after their row's last event, with ``_before``: the standing that each meets.

    ``_before`` is ADD (live), DELETE (deleted) or null (absent): the latest ADD or DELETE
    before the event, or what the row says, if the object has a row or had an ADD.
    A stretch of an object's log so acts on its standing by two values, whether it
    has an ADD and its last ADD or DELETE, and these compose. An object with a large
    share of all events is cut into ``pieces`` stretches by event id; what comes before a
    stretch is put together from the stretches' values, and each is judged by itself.
    """
    pieces = pieces or int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = state.select(F.col("_tid").alias("_old_tid"), F.when(F.col("_date_deleted").isNull(), "ADD").otherwise("DELETE").alias("_standing"), F.col("_last_event").alias("_mark"))
    hot = frequent(log_tail, F.struct("tid"), pieces) if pieces > 1 else []
    events = spread_join(log_tail, first, [("tid", "_old_tid")], "left", pieces=pieces, hot=hot).select("src.*", "dst._standing", "dst._mark").drop("_piece")
    events = events.where("_mark IS NULL OR eventid > _mark")
    turning = F.when(F.col("action").isin("ADD", "DELETE"), F.col("action"))
    added, carried = F.lit(False), F.lit(None).cast("string")
    if hot:
        low, high = log_tail.agg(F.min("eventid"), F.max("eventid")).first()
        stretch = F.floor((F.col("eventid") - low) * pieces / (high - low + 1))
        events = events.withColumn("_stretch", F.when(F.xxhash64(F.struct("tid")).isin(hot), stretch).otherwise(0))
        effects = events.where(F.xxhash64(F.struct("tid")).isin(hot)).groupBy("tid", "_stretch").agg(F.max(F.col("action") == "ADD").alias("_adds"), F.max_by("action", F.when(turning.isNotNull(), F.col("eventid"))).alias("_turn"))
        past = W.partitionBy("tid").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
        before = effects.select("tid", "_stretch", F.max("_adds").over(past).alias("_added"), F.last("_turn", ignorenulls=True).over(past).alias("_carried"))
        events = events.join(F.broadcast(before), ["tid", "_stretch"], "left")  # ``pieces`` rows for each of ``2 * pieces`` objects at most
        added, carried = F.coalesce("_added", F.lit(False)), F.col("_carried")
    else:
        events = events.withColumn("_stretch", F.lit(0))
    earlier = W.partitionBy("tid", "_stretch").orderBy("eventid").rowsBetween(W.unboundedPreceding, -1)
    exists = F.col("_standing").isNotNull() | added | F.coalesce(F.max(F.col("action") == "ADD").over(earlier), F.lit(False))
    standing = F.when(exists, F.coalesce(F.last(turning, ignorenulls=True).over(earlier), carried, F.col("_standing")))
    return events.withColumn("_before", standing).select(*log_tail.columns, "_before")


def fold(state: DataFrame, log_tail: DataFrame, coll: CollectionSpec, pieces: int | None = None) -> Folded:
    """Apply events in id order, per object, without a loop over rows.

    Each event's standing follows from the ADDs and DELETEs before it (``judged``): an
    ADD needs an absent or deleted object, other events a live one; else the event is
    a violation and not applied. Events on an object that has no row and no earlier
    ADD, or without a tid, are orphans and are dropped. The judged events are written to
    the shared folder, as all three results come from them. For the rest, one grouping by
    tid takes each field's latest value (an ADD sets all fields, explicit nulls
    included) and the metadata, and one join merges it with the old state. Bulk confirms
    name many objects and none as their own; they aren't events of an object and are
    left to ``confirm_in_bulk``.
    """
    log_tail = log_tail.where("action <> 'BULKCONFIRM'")
    nameless, named = log_tail.where("tid IS NULL"), log_tail.where("tid IS NOT NULL")
    events = written(judged(state, named, pieces), "fold-events")
    live, absent, add = F.col("_before").eqNullSafe("ADD"), F.col("_before").isNull(), F.col("action") == "ADD"
    orphan, violation = absent & ~add, F.when(add, live).otherwise(~absent & ~live)
    violations = events.where(violation).select("eventid", "tid", "action", F.coalesce("_before", F.lit("none")).alias("standing"))
    orphans = events.where(orphan).select("eventid", "tid", "action").unionByName(nameless.select("eventid", "tid", "action"))

    good = events.where(~violation & ~orphan).withColumn("c", F.from_json("contents", CONTENTS))
    change = F.when(add, F.col("c.entity")).when(F.col("action") == "MODIFY", F.map_from_entries(F.transform("c.modifications", lambda m: F.struct(m["key"], m["new_value"]))))
    good = good.withColumn("_change", change)
    made = F.col("_change")
    values = [_latest(made[n], add | F.coalesce(F.map_contains_key(made, n), F.lit(False))).alias(f"_f_{n}") for n in coll.fields]
    acted = lambda *a: F.col("action").isin(*a)
    at = lambda *a: _latest(F.col("timestamp"), acted(*a))
    grouped = good.groupBy("tid").agg(
        *values, F.max("eventid").alias("_e_last"), at("ADD").alias("_e_created"), at("MODIFY").alias("_e_modified"), at("CONFIRM").alias("_e_confirmed"),
        F.max_by("action", F.when(acted("ADD", "DELETE"), F.col("eventid"))).alias("_e_turn"), at("DELETE").alias("_e_deleted"),
        _latest(F.col("c._hash"), acted("ADD", "MODIFY")).alias("_e_hash"), F.max_by(F.struct("source", "application", "version"), "eventid").alias("_e_of"),
    )
    old = state.withColumnRenamed("_tid", "_old")
    joined = old.join(grouped, old["_old"] == grouped["tid"], "full_outer")
    pick = lambda new, name: F.when(F.col(new).isNotNull(), F.col(f"{new}.v")).otherwise(F.col(name))
    fresh = F.col("_e_created").isNotNull()
    since = lambda new, name: F.when(F.col(new).isNotNull() & (~fresh | (F.col(f"{new}.e") > F.col("_e_created.e"))), F.col(f"{new}.v")).when(~fresh, F.col(name))
    fields = [pick(f"_f_{n}", n).cast(k).alias(n) if k != "timestamp" else F.when(F.col(f"_f_{n}").isNotNull(), F.to_timestamp(f"_f_{n}.v")).otherwise(F.col(n)).alias(n) for n, k in coll.fields.items()]
    deleted = F.when(F.col("_e_turn") == "DELETE", F.col("_e_deleted.v")).when(F.col("_e_turn") == "ADD", F.lit(None)).otherwise(F.col("_date_deleted"))
    result = joined.select(
        *fields, F.coalesce("_old", "tid").alias("_tid"), F.coalesce("_e_of.source", "_source").alias("_source"), F.coalesce("_e_of.application", "_application").alias("_application"),
        F.coalesce("_e_of.version", "_version").alias("_version"), pick("_e_hash", "_hash").alias("_hash"), F.coalesce("_e_last", "_last_event").alias("_last_event"),
        pick("_e_created", "_date_created").alias("_date_created"), since("_e_modified", "_date_modified").alias("_date_modified"),
        deleted.alias("_date_deleted"), since("_e_confirmed", "_date_confirmed").alias("_date_confirmed"),
    )
    return Folded(result, violations, orphans)


def first_state(log_tail: DataFrame, coll: CollectionSpec) -> DataFrame:
    """The state after a first load, whose events are all ADDs of different objects: a projection, without window or join.

    ``fold`` on an empty state gives the same at the cost of both.
    """
    wrong = F.raise_error(F.concat(F.lit("a first load has ADDs only: "), F.col("action")))
    made = F.from_json("contents", CONTENTS)
    rows = log_tail.withColumn("c", F.when(F.col("action") == "ADD", made).when(wrong.cast("string").isNotNull(), made))
    fields = [(F.to_timestamp(F.col("c.entity")[n]) if k == "timestamp" else F.col("c.entity")[n].cast(k)).alias(n) for n, k in coll.fields.items()]
    meta = {"_tid": "tid", "_source": "source", "_application": "application", "_version": "version", "_hash": "c._hash", "_last_event": "eventid", "_date_created": "timestamp"}
    return rows.select(*fields, *[(F.col(meta[n]) if n in meta else F.lit(None)).cast(k).alias(n) for n, k in META.items()])


def empty_state(coll: CollectionSpec, spark) -> DataFrame:
    """A state without rows."""
    return spark.createDataFrame([], ", ".join(f"`{n}` {k}" for n, k in (coll.fields | META).items()))


def confirmed_tids(confirms: DataFrame) -> DataFrame:
    """The tids of CONFIRM and BULKCONFIRM events; any other type is an error."""
    wrong = F.when(~F.col("event").isin("CONFIRM", "BULKCONFIRM"), F.raise_error(F.concat(F.lit("unexpected event among confirms: "), F.col("event"))))
    tids = F.when(F.col("event") == "CONFIRM", F.array("tid")).otherwise(F.coalesce(wrong.cast("array<string>"), F.transform("confirms", lambda c: c["tid"])))
    return confirms.select(F.explode(tids).alias("tid")).where("tid IS NOT NULL").distinct()


def _stamp(state: DataFrame, tids: DataFrame) -> DataFrame:
    """``state`` confirmed at ``_at`` where ``tids`` has its ``_ctid``. Only rows that were confirmed before and at another moment change; ``_last_event`` doesn't."""
    joined = state.join(tids, state["_tid"] == tids["_ctid"], "left")
    stamped = F.when(F.coalesce(F.col("_date_confirmed") != F.col("_at"), F.lit(False)), F.col("_at")).otherwise(F.col("_date_confirmed"))
    return joined.withColumn("_date_confirmed", stamped).select(*state.columns)


def apply_confirms(state: DataFrame, confirms: DataFrame, timestamp: Column) -> DataFrame:
    """Stamp the confirmed objects with ``timestamp``. Only rows that were confirmed before and at another moment change; ``_last_event`` doesn't."""
    return _stamp(state, confirmed_tids(confirms).select(F.col("tid").alias("_ctid"), timestamp.alias("_at")))


def confirm_in_bulk(state: DataFrame, log_tail: DataFrame) -> DataFrame:
    """Stamp the objects that the log's bulk confirms name, with the latest event's timestamp, as ``apply_confirms`` does."""
    members = log_tail.where("action = 'BULKCONFIRM'").select("timestamp", F.explode(F.from_json("contents", CONTENTS)["confirms"]).alias("m"))
    return _stamp(state, members.groupBy(F.col("m.tid").alias("_ctid")).agg(F.max("timestamp").alias("_at")))


def apply_all(log: DataFrame, states: dict[str, tuple[CollectionSpec, DataFrame]], applied: dict[str, int] | None = None) -> tuple[dict[str, Folded | None], DataFrame]:
    """Bring each collection up to date with its part of the log; also a summary by ``applied_range``.

    A collection whose state is ahead of the log is an error; one that is up to date keeps
    its state. Events of objects are folded first, then the bulk confirms are stamped.
    ``applied`` has the marks of ``read_marks``: up to which event each state has its log.
    Without a mark the state's greatest last event counts, so that bulk confirms at the
    log's head are stamped again, which changes nothing. ``marks`` of the results
    are to be written once the states are.
    """
    results, rows = {}, []
    for name, (coll, state) in states.items():
        own = log.where((F.col("catalogue") == coll.catalogue) & (F.col("entity") == coll.name))
        mark = model_status(state, own, (applied or {}).get(name)).first()
        if mark["status"] == "corrupted":
            raise ValueError(f"{name}: the state is ahead of the log ({mark['entity_max']} > {mark['log_max']})")
        new = own.where(F.col("eventid") > mark["entity_max"])
        results[name] = None
        if mark["status"] != "up to date":
            folded = fold(state, new, coll)
            results[name] = Folded(confirm_in_bulk(folded.state, new), folded.violations, folded.orphans, mark["log_max"])
        members = F.when(F.col("action") == "BULKCONFIRM", F.size(F.from_json("contents", CONTENTS)["confirms"])).otherwise(1)
        rows.append(new.select(F.lit(name).alias("collection"), F.lit(mark["entity_max"]).cast("long").alias("before"), "eventid", "action", members.alias("members")))
    return results, applied_range(reduce(DataFrame.unionByName, rows))


def marks(spark: SparkSession, results: dict[str, Folded | None]) -> DataFrame:
    """``collection, applied`` of the collections that ``apply_all`` changed, for ``write_marks``."""
    return spark.createDataFrame([(name, f.applied) for name, f in results.items() if f is not None], "collection string, applied long")


def applied_range(applied: DataFrame) -> DataFrame:
    """One row over all applied events: the least id before, the greatest after, and how many of each action. A BULKCONFIRM counts its ``members`` as confirms."""
    members = F.col("members") if "members" in applied.columns else F.lit(1)
    counts = [F.count_if(F.col("action") == a).alias(a.lower()) for a in ("ADD", "MODIFY", "DELETE")]
    confirms = F.coalesce(F.sum(F.when(F.col("action").isin("CONFIRM", "BULKCONFIRM"), members)), F.lit(0)).cast("long").alias("confirm")
    return applied.agg(F.min("before").alias("before"), F.max("eventid").alias("after"), *counts, confirms)
