"""Build and maintain relation tables between two collections.

Source rows have ``_id, _source, _application, _last_event, _date_deleted`` and a
reference column ``ref``: ``struct<value, begin>``, or an array of those. Destination
rows have ``_id, _source, _last_event, _date_deleted`` and the attributes that the
specs name. Both may have ``_expiration_date``; with states they have ``seqnr,
valid_from, valid_to``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.skew import spread_join
from tidelog.functions.spatial import inside
from tidelog.functions.temporal import validity_match, with_periods
from tidelog.sources.eventlog import assign_ids
from tidelog.sources.shared import written
from tidelog.specs import RelationSpec

VERSION = "0.1"
_OPTIONAL = {"seqnr": "int", "valid_from": "timestamp", "valid_to": "timestamp", "_expiration_date": "timestamp"}


def _completed(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(k) for n, k in _OPTIONAL.items() if n not in df.columns})


def check_specs(src: DataFrame, specs: list[RelationSpec]) -> DataFrame:
    """The applications in ``src`` for which there is no spec."""
    return src.select("_application").distinct().where(~F.col("_application").isin([s.application for s in specs]))


def precondition(src: DataFrame, specs: list[RelationSpec]) -> None:
    """An error that names the applications of ``src`` for which there is no spec, if there are any."""
    unknown = [r[0] for r in check_specs(src, specs).limit(10).collect()]
    if unknown:
        raise ValueError(f"no relation spec for {', '.join(map(str, unknown))}")


def by_application(specs: list[RelationSpec], value) -> Column:
    """A column that depends on the row's application; no switch where all specs agree."""
    values = [value(s) for s in specs]
    if len({str(v) for v in values}) == 1:
        return values[0] if isinstance(values[0], Column) else F.lit(values[0])
    return reduce(lambda acc, sv: acc.when(F.col("_application") == sv[0].application, sv[1]), zip(specs, values, strict=True), F)


def derivation(specs: list[RelationSpec]) -> Column:
    """The destination attribute that a relation was derived by."""
    return by_application(specs, lambda s: s.destination_attribute)


def relation_key(specs: list[RelationSpec], src_states: bool, dst_states: bool) -> Column:
    """``src_id[.seqnr].source.value``, and the destination too where several are allowed. Null if any part is."""
    dot = F.lit(".")
    parts = [F.col("src_id"), *([dot, F.col("src_seqnr").cast("string")] if src_states else []), dot, F.col("src_source"), dot, F.col("value")]
    dst = [dot, F.col("dst_id"), *([dot, F.col("dst_seqnr").cast("string")] if dst_states else [])]
    return by_application(specs, lambda s: F.concat(*parts, *dst) if s.multiple_allowed else F.concat(*parts))


def references(src: DataFrame, many: bool) -> DataFrame:
    """One row per reference: the element in ``ref``. Elements of a list without a value are dropped."""
    return src.withColumn("ref", F.explode("ref")).where("ref.value IS NOT NULL") if many else src


_SRC = ["valid_from", "valid_to", "_expiration_date", "_last_event", "_date_deleted"]
_DST = ["_source", "valid_from", "valid_to", "_expiration_date", "_last_event"]


#: References and destinations of one value that meet in one block, where values are crowded.
BLOCK = (1024, 16_384)


def _in_blocks(refs: DataFrame, each: DataFrame, how: str) -> DataFrame:
    """``refs`` joined with the numbered ``each`` by value, in blocks of ``BLOCK`` references and destinations.

    A reference is there once for each block of its value's destinations, and the other way
    round; only values with several blocks are looked up, which are few. Blocks are dealt
    out to as many tasks as there are shuffle partitions: few bytes make very many pairs
    here and would be put into few tasks otherwise. A task holds one block's references
    and goes through its destinations, so pairs of a destination come together, which files keep small.
    """
    pieces = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none, number = F.lit(0).cast("long"), F.row_number().over(W.partitionBy("value").orderBy("_id", "seqnr", "_source"))
    s = refs.withColumn("_block", F.floor((number - 1) / BLOCK[0]))
    d = each.withColumn("_dst_block", F.floor((F.col("row_number") - 1) / BLOCK[1]))
    tops = lambda df, key, block, name: F.broadcast(df.groupBy(F.col(key).alias("_of")).agg(F.max(block).alias(name)).where(F.col(name) > 0))
    several = lambda name: F.explode(F.sequence(none, F.coalesce(name, none)))
    src = s.join(tops(d, "_key", "_dst_block", "_top"), F.col("value") == F.col("_of"), "left").withColumn("_dst_block", several("_top")).drop("_of", "_top")
    dst = d.join(tops(s, "value", "_block", "_top"), F.col("_key") == F.col("_of"), "left").withColumn("_block", several("_top")).drop("_of", "_top")
    src, dst = src.repartition(pieces, "value", "_block", "_dst_block"), dst.repartition(pieces, "_key", "_block", "_dst_block")
    fits = (F.col("dst._key") == F.col("src.value")) & (F.col("dst._block") == F.col("src._block")) & (F.col("dst._dst_block") == F.col("src._dst_block"))
    return dst.alias("dst").join(src.hint("merge").alias("src"), fits, "right" if how == "left" else "inner")


def _by_value(src: DataFrame, dst: DataFrame, attribute: str, how: str, spread: bool, last: bool, crowded: bool) -> DataFrame:
    """``match`` of references whose value alone says which of ``dst`` they fit.

    Then all references of a value have the same destinations, so each side is grouped
    and numbered before the join, and the pairs are neither grouped nor sorted.
    """
    refs = src.withColumn("value", F.col("ref.value")).groupBy("_application", "_id", "seqnr", "_source", "value").agg(F.max("ref.begin").alias("_begin"), F.max_by(F.struct(*_SRC), F.col("_last_event")).alias("_src"))
    each = dst.where(F.col(attribute).isNotNull()).groupBy(F.col(attribute).alias("_key"), "_id").agg(F.max("seqnr").alias("seqnr"), F.max_by(F.struct(*_DST), F.coalesce("seqnr", F.lit(0))).alias("_dst"))
    if last:
        one = each.groupBy("_key").agg(F.max_by(F.struct("_id", "seqnr", "_dst"), F.struct(F.col("_id").isNull(), "_id")).alias("_one"), F.count("*").cast("int").alias("row_number"))
        each = one.select("_key", "_one.*", "row_number")
    else:
        each = each.withColumn("row_number", F.row_number().over(W.partitionBy("_key").orderBy(F.col("_id").asc_nulls_last())))
    if crowded and not last:
        joined = _in_blocks(refs, each, how)
    else:
        joined = spread_join(refs, each, [("value", "_key")], how, hot=None if spread else [])
    return joined.select(
        "src._application", F.col("src._id").alias("src_id"), F.col("src.seqnr").alias("src_seqnr"), F.col("src._source").alias("src_source"), "src.value", F.col("dst._id").alias("dst_id"),
        F.col("dst.seqnr").alias("dst_seqnr"), "dst._dst", "src._begin", "src._src", F.coalesce("dst.row_number", F.lit(1)).alias("row_number"),
    )


def match(src: DataFrame, dst: DataFrame, specs: list[RelationSpec], many: bool = False, src_states: bool = False, dst_states: bool = False, as_of: Column | None = None, keep_unmatched: bool = False, spread: bool = False, period_days: int | None = None, last: bool = False, crowded: bool = False) -> DataFrame:
    """Each reference with the live destinations it fits, the latest fitting state of each.

    One equality join per application, then a union, so that no condition with OR
    turns into a nested loop; what periods demand is a residual of the equality. Where
    the value alone decides, both sides are grouped and numbered before they are joined (``_by_value``). With
    ``spread`` values that very many references share are split over all tasks. Where
    both sides have many states to a key, ``period_days`` lets them meet by stretches of
    that length and not all with all (``with_periods``). A relation by location joins on grid cells. Sources whose geometry isn't valid fit nothing.
    The destination's row of the latest state comes with the grouping, so nothing
    is joined again. ``row_number`` counts a reference's distinct destinations in
    order of their id: beyond 1 it is ambiguous. Without ``keep_unmatched``
    references that fit nothing give no row. With ``last`` each reference has only the
    last of its destinations, whose ``row_number`` says how many there are. ``crowded`` is
    for values that many references and many destinations share: they meet in blocks (``_in_blocks``), whatever ``spread`` says.
    """
    rows = references(_completed(src), many)
    live = _completed(dst).where("_date_deleted IS NULL")
    alone = len({s.application for s in specs}) == len(specs) and not (src_states and dst_states)
    parts, done = [], []
    for spec in specs:
        s, d = rows.where(F.col("_application") == spec.application), live
        wanted = F.col(spec.source_attribute) if spec.source_attribute else F.col("ref.value")
        s = s.withColumn("_wanted", wanted)
        valid, how = validity_match("src", "dst", src_states, dst_states, as_of), "left" if keep_unmatched else "inner"
        if spec.method == "lies_in":
            pairs = inside(s, live, F.col("_wanted"), F.col(spec.destination_attribute), spec.cell).select(F.col("_s").alias("src"), F.col("_d").alias("dst")).where(valid)
            if keep_unmatched:
                missed = s.select(F.struct("*").alias("src")).join(pairs.select(F.col("src").alias("_src")).distinct(), F.col("src").eqNullSafe(F.col("_src")), "left_anti")
                pairs = pairs.unionByName(missed, allowMissingColumns=True)
            joined = pairs
        elif alone and not spec.source_attribute and dst.schema[spec.destination_attribute].dataType == rows.select("ref.value").schema[0].dataType:
            done.append(_by_value(s, d.alias("dst").where(valid), spec.destination_attribute, how, spread, last, crowded))
            continue
        else:
            if period_days and src_states and dst_states:
                s, d = with_periods(s, d, period_days)
                valid &= F.col("src._period").eqNullSafe(F.col("dst._period"))
            if spread:
                joined = spread_join(s, d, [("_wanted", spec.destination_attribute)], how, valid)
            else:
                joined = s.alias("src").join(d.alias("dst"), (F.col(f"dst.{spec.destination_attribute}") == F.col("src._wanted")) & valid, how)
        parts.append(joined.select(
            F.col("src._application").alias("_application"), F.col("src._id").alias("src_id"), F.col("src.seqnr").alias("src_seqnr"), F.col("src._source").alias("src_source"), F.col("src.ref.value").alias("value"),
            F.col("src.ref.begin").alias("_begin"), F.struct(*[f"src.{c}" for c in _SRC]).alias("_src"),
            F.col("dst._id").alias("dst_id"), F.col("dst.seqnr").alias("dst_seqnr"), F.struct(*[f"dst.{c}" for c in _DST]).alias("_dst"),
        ))
    if parts:
        found = reduce(DataFrame.unionByName, parts)
        key = ["_application", "src_id", "src_seqnr", "src_source", "value", "dst_id"]
        latest = found.groupBy(*key).agg(F.max("dst_seqnr").alias("dst_seqnr"), F.max_by("_dst", F.coalesce("dst_seqnr", F.lit(0))).alias("_dst"), F.max("_begin").alias("_begin"), F.max_by("_src", F.col("_src._last_event")).alias("_src"))
        reference = W.partitionBy("_application", "src_id", "src_seqnr", "src_source", "value")
        numbered = latest.withColumn("row_number", F.row_number().over(reference.orderBy(F.col("dst_id").asc_nulls_last())))
        done.append(numbered.withColumn("_n", F.count("*").over(reference)).where("row_number = _n").drop("_n") if last else numbered)
    return reduce(DataFrame.unionByName, done)


def relation_rows(matched: DataFrame, specs: list[RelationSpec], src_states: bool = False, dst_states: bool = False) -> DataFrame:
    """The full rows of a relation: key, derivation, periods (the latest begin, the earliest end), high-water marks."""
    keyed = matched.withColumn("id", relation_key(specs, src_states, dst_states)).withColumn("derivation", derivation(specs))
    found = F.col("dst_id").isNotNull()
    begin = F.when(found, F.greatest("_src.valid_from", "_dst.valid_from", "_begin"))
    end = F.when(found, F.least("_src.valid_to", "_dst.valid_to"))
    return keyed.select(
        "id", "_application", "derivation", "src_source", "src_id", "src_seqnr", F.col("_dst._source").alias("dst_source"), "dst_id", "dst_seqnr", "value", begin.alias("valid_from"), end.alias("valid_to"),
        F.least("_src._expiration_date", "_dst._expiration_date").alias("_expiration_date"), F.col("_src._last_event").alias("_last_src_event"), F.col("_dst._last_event").alias("_last_dst_event"),
        F.col("_src._date_deleted").alias("src_deleted"), "row_number",
    )


def _one_per_key(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("id").orderBy(F.col("dst_id").asc_nulls_last(), F.col("dst_seqnr").desc_nulls_last(), "src_id")
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def in_range(df: DataFrame, after: int | None, upto: int | None) -> DataFrame:
    """Rows whose last event lies in ``(after, upto]``; 0 or None leaves a side open."""
    if after:
        df = df.where(F.col("_last_event") > after)
    return df.where(F.col("_last_event") <= upto) if upto else df


def marks(src: DataFrame, dst: DataFrame, rel: DataFrame) -> DataFrame:
    """One row of the relation's high-water marks and the collections' last events."""
    one = lambda df, **aggs: df.agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(n) for n, c in aggs.items()]).withColumn("_k", F.lit(1))
    return one(rel, last_src="_last_src_event", last_dst="_last_dst_event").join(one(src, max_src="_last_event"), "_k").join(one(dst, max_dst="_last_event"), "_k").drop("_k")


def change_ratio(src: DataFrame, dst: DataFrame, last_src: int, last_dst: int) -> DataFrame:
    """One row ``src_ratio, dst_ratio, full``: the changed share of both sides (1 for an empty side); together 1 or more calls for a full run."""
    share = lambda df, last, n: df.agg(F.count("*").alias("t"), F.count_if(F.col("_last_event") > last).alias("c")).select(F.when(F.col("t") == 0, 1.0).otherwise(F.col("c") / F.col("t")).alias(n), F.lit(1).alias("_k"))
    both = share(src, last_src, "src_ratio").join(share(dst, last_dst, "dst_ratio"), "_k").drop("_k")
    return both.withColumn("full", F.col("src_ratio") + F.col("dst_ratio") >= 1.0)


def obsolete_relations(rel: DataFrame, src: DataFrame, dst: DataFrame, rows: DataFrame) -> DataFrame:
    """Live relations of the changed ``src`` and ``dst`` rows whose key isn't among the new ``rows``."""
    live = rel.where("_date_deleted IS NULL")
    key = lambda side, df: [live[f"{side}_id"] == df["_id"]] + ([live[f"{side}_seqnr"].eqNullSafe(df["seqnr"])] if "seqnr" in df.columns else [])
    of_src, of_dst = live.join(src, key("src", src), "left_semi"), live.join(dst, key("dst", dst), "left_semi")
    touched = of_src.union(of_dst).dropDuplicates(["id"])
    return touched.join(rows.select(F.col("id").alias("_new_id")).distinct(), touched["id"] == F.col("_new_id"), "left_anti")


def relate(src: DataFrame, dst: DataFrame, rel: DataFrame, specs: list[RelationSpec], mode: str = "full", last_src: int = 0, last_dst: int = 0, many: bool = False, src_states: bool = False, dst_states: bool = False, as_of: Column | None = None, keep_unmatched: bool = False) -> DataFrame:
    """New relation rows with the existing relation's columns as ``rel_*``, and the obsolete relations as rows without ``id``.

    ``full`` relates all sources. ``incremental`` relates the sources changed after
    ``last_src`` to all destinations, then the unchanged sources to the destinations
    changed after ``last_dst``. One row per key remains, then the existing relation
    is joined by key. A source of an application without a spec ends the run.
    """
    unknown = F.raise_error(F.concat(F.lit("no relation spec for "), F.col("_application"))).cast("boolean")
    src = src.where(F.when(F.col("_application").isin([s.application for s in specs]) | F.col("_application").isNull(), True).otherwise(unknown))
    args = {"many": many, "src_states": src_states, "dst_states": dst_states, "as_of": as_of, "keep_unmatched": keep_unmatched}
    make = lambda s, d: relation_rows(match(s, d, specs, **args), specs, src_states, dst_states)
    if mode == "full":
        rows, changed_src, changed_dst = make(src, dst), src, dst
    else:
        changed_src, changed_dst = in_range(src, last_src, None), in_range(dst, last_dst, None)
        rows = make(changed_src, dst).unionByName(make(src.where(F.col("_last_event") <= last_src), changed_dst))
    rows = _one_per_key(rows)
    old = rel.select("id", "dst_id", "dst_seqnr", "valid_from", "valid_to", "_expiration_date", "_last_event", "_date_deleted")
    old = old.toDF(*[f"rel_{c}" for c in old.columns])
    result = rows.join(old, rows["id"] == old["rel_id"], "left")
    gone = obsolete_relations(rel, changed_src, changed_dst, rows)
    gone = gone.select(*[F.col(c.removeprefix("rel_")).alias(c) for c in old.columns])
    return result.unionByName(gone, allowMissingColumns=True)


def relation_events(rows: DataFrame, dst_states: bool = False) -> DataFrame:
    """Events that bring the relation table up to date: ``event, tid, last_event, version, modifications``.

    No relation or a deleted one: ADD. Source gone or deleted: DELETE. Else MODIFY
    with the changed fields, or nothing where none changed.
    """
    compared = {"dst_id": "string", "_expiration_date": "timestamp", "valid_from": "timestamp", "valid_to": "timestamp"} | ({"dst_seqnr": "string"} if dst_states else {})
    text = lambda c, k: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if k == "timestamp" else F.col(c).cast("string")
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), text(f"rel_{n}", k).alias("old_value"), text(n, k).alias("new_value")) for n, k in compared.items()])
    rows = rows.withColumn("modifications", F.filter(pairs, lambda m: ~m["old_value"].eqNullSafe(m["new_value"])))
    absent = F.col("rel_id").isNull() | F.col("rel__date_deleted").isNotNull()
    gone = F.col("src_id").isNull() | F.col("src_deleted").isNotNull()
    event = F.when(gone & absent, F.lit(None)).when(gone, "DELETE").when(absent, "ADD").when(F.size("modifications") > 0, "MODIFY")
    events = rows.withColumn("event", event).where("event IS NOT NULL")
    return events.select("event", F.coalesce("id", "rel_id").alias("tid"), F.when(F.col("event") != "ADD", F.col("rel__last_event")).alias("last_event"), F.lit(VERSION).alias("version"), F.when(F.col("event") == "MODIFY", F.col("modifications")).alias("modifications"))


def fold_relation(rel: DataFrame, rows: DataFrame, events: DataFrame, at: Column) -> DataFrame:
    """The relation table after ``events`` (of ``relation_events``, with ``eventid``) that ``rows`` (of ``relate``) led to.

    ADD and MODIFY put the new row in place of the old one, DELETE ends the old one at
    ``at``; each row they touch has the event's id as ``_last_event``.
    """
    change = events.select(F.col("tid").alias("_tid"), F.col("event").alias("_event"), "eventid")
    made = rows.where("id IS NOT NULL").join(change.where("_event <> 'DELETE'"), F.col("id") == F.col("_tid"))
    made = made.withColumns({"_last_event": F.col("eventid"), "_date_deleted": F.lit(None).cast("timestamp")}).select(*[F.col(c).cast(rel.schema[c].dataType) for c in rel.columns])
    kept = rel.join(change, rel["id"] == F.col("_tid"), "left").where("_event IS NULL OR _event = 'DELETE'")
    ended = F.col("_event").isNotNull()
    kept = kept.withColumns({"_date_deleted": F.when(ended, at).otherwise(F.col("_date_deleted")), "_last_event": F.when(ended, F.col("eventid")).otherwise(F.col("_last_event"))})
    return kept.select(*rel.columns).unionByName(made)


def empty_relation(src: DataFrame, dst: DataFrame, specs: list[RelationSpec], **args) -> DataFrame:
    """A relation table of these collections without rows."""
    rows = relation_rows(match(src, dst, specs, **args), specs, args.get("src_states", False), args.get("dst_states", False))
    return rows.drop("src_deleted", "row_number").withColumns({"_last_event": F.lit(0).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")}).where("false")


def update(src: DataFrame, dst: DataFrame, rel: DataFrame, specs: list[RelationSpec], start: int, at: Column, last: tuple[int, int] | None = None, **args) -> tuple[DataFrame, DataFrame, str]:
    """Bring a relation up to date: the new table, its events (ids above ``start``) and the mode of the run.

    A source application without a spec is an error. The run is full where the relation
    is empty or the changed shares of both sides come to 1 or more, else incremental
    from ``last``, the last events of source and destination that an earlier run has
    seen. Without it the relation's own high-water marks count, in which changes that
    had no effect left no trace, so that they are related again. ``args`` are those
    of ``match``. The matched rows and the events are written to the shared folder, as
    both are used twice.
    """
    precondition(src, specs)
    mark = marks(src, dst, rel).first().asDict() if last is None else {"last_src": last[0], "last_dst": last[1]}
    full = (last is None and rel.isEmpty()) or change_ratio(src, dst, mark["last_src"], mark["last_dst"]).first()["full"]
    mode = "full" if full else "incremental"
    rows = written(relate(src, dst, rel, specs, mode, mark["last_src"], mark["last_dst"], **args), "relation-rows")
    events = written(assign_ids(relation_events(rows, args.get("dst_states", False)), start), "relation-events")
    return fold_relation(rel, rows, events, at), events, mode


def conflicts(matched: DataFrame, specs: list[RelationSpec]) -> DataFrame:
    """References that fit more than one destination, where only one is allowed: the candidates beyond the first, or only the last one if matched so. States of one destination are no conflict."""
    single = [s.application for s in specs if not s.multiple_allowed]
    return matched.where(F.col("_application").isin(single) & (F.col("row_number") > 1)).select("_application", "src_id", "src_seqnr", "src_source", "value", "dst_id", "row_number")


def relate_all(catalogue: dict[str, dict]) -> dict[str, DataFrame]:
    """The events of every relation of a catalogue; each value of ``catalogue`` has the arguments of ``relate``. Relations without specs, or of very many references (``very_many``), are passed over."""
    out = {}
    for name, args in catalogue.items():
        if args.get("specs") and not args.get("very_many"):
            out[name] = relation_events(relate(**{k: v for k, v in args.items() if k != "very_many"}), args.get("dst_states", False))
    return out


@dataclass
class Related:
    """A relation after a run: its table, the run's events and mode, and the last events of source and destination that it has seen."""

    table: DataFrame
    events: DataFrame
    mode: str
    last: tuple[int, int]


def update_all(catalogue: dict[str, dict], start: int, at: Column, seen: dict[str, tuple[int, int]] | None = None) -> dict[str, Related]:
    """``update`` of every relation of a catalogue, as ``relate_all`` picks them; ids go on from relation to relation.

    ``seen`` has each relation's ``last`` of the run before, which is to be kept with the
    tables: a run without changes relates nothing. Every relation is checked
    before the first is made.
    """
    chosen = {name: {k: v for k, v in args.items() if k != "very_many"} for name, args in catalogue.items() if args.get("specs") and not args.get("very_many")}
    for args in chosen.values():
        precondition(args["src"], args["specs"])
    out = {}
    for name, args in chosen.items():
        top = lambda df: df.agg(F.coalesce(F.max("_last_event"), F.lit(0)).cast("long")).first()[0]
        last = (top(args["src"]), top(args["dst"]))
        table, events, mode = update(start=start, at=at, last=(seen or {}).get(name), **args)
        start += events.count()
        out[name] = Related(table, events, mode, last)
    return out
