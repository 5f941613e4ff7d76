"""Queries over relations, checks and views, on collections derived from the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.keys import as_text
from tidelog.functions.temporal import islands, latest_state
from tidelog.operators import quality
from tidelog.operators.relate import change_ratio, check_specs, conflicts, empty_relation, marks, match, obsolete_relations, relate, relate_all, relation_events, relation_rows, update, update_all
from tidelog.operators.views import refresh_views, relation_view
from tidelog.plans.upload import table
from tidelog.sources.shared import written
from tidelog.specs import RelationSpec

SPECS = [RelationSpec("A", "name"), RelationSpec("B", "code", none_allowed=True)]
PART = [RelationSpec("P", "code")]
BRAND = [RelationSpec("P", "brand", multiple_allowed=True)]
ONE_BRAND = [RelationSpec("P", "brand")]
INSIDE = [RelationSpec("M", "area", source_attribute="place", method="lies_in", cell=4.0)]
CODE_BY_COLUMN = [RelationSpec("P", "code", source_attribute="nation_code")]

def none():
    return F.lit(None).cast("timestamp")


def _ref(value):
    return F.struct(value.alias("value"), none().alias("begin"))


def customers(spark, d) -> DataFrame:
    """Sources: even customers refer to a nation's name, odd ones to its code; some values are missing, some fit nothing."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    key, code = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    value = F.when(key % 17 == 0, F.lit(None)).when(key % 19 == 0, F.lit("nowhere")).otherwise(F.when(key % 2 == 0, F.col("n_name")).otherwise(code))
    rows = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(key.cast("string").alias("_id"), F.lit("crm").alias("_source"), F.when(key % 2 == 0, "A").otherwise("B").alias("_application"), key.alias("_last_event"), F.when(key % 23 == 0, F.lit("2021-01-01").cast("timestamp")).alias("_date_deleted"), F.when(key % 3 == 0, F.lit("2022-01-01").cast("timestamp")).alias("valid_to"), code.alias("nation_code"), _ref(value).alias("ref"))


def nations(spark, d) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, d, "nation").select(key.cast("string").alias("_id"), F.lit("geo").alias("_source"), (key + 1).cast("long").alias("_last_event"), F.when(key == 24, F.lit("2021-01-01").cast("timestamp")).alias("_date_deleted"), F.col("n_name").alias("name"), key.cast("string").alias("code"))


def order_lines(spark, d) -> DataFrame:
    """Sources with a list of references: the parts of an order; every 10th has no value."""
    value = F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey").cast("string"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(_ref(value)).alias("ref"))
    return lines.select(F.col("l_orderkey").cast("string").alias("_id"), F.lit("shop").alias("_source"), F.lit("P").alias("_application"), F.col("l_orderkey").alias("_last_event"), none().alias("_date_deleted"), "ref")


def parts(spark, d) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, d, "part").select(key.cast("string").alias("_id"), F.lit("store").alias("_source"), key.alias("_last_event"), F.when(key % 7 == 0, F.lit("2021-01-01").cast("timestamp")).alias("_date_deleted"), key.cast("string").alias("code"), F.col("p_brand").alias("brand"))


def suppliers(spark, d) -> DataFrame:
    """Sources that refer to a brand, which many parts share."""
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    rows = table(spark, d, "supplier").join(p, F.col("s_suppkey") == F.col("p_partkey"))
    return rows.select(F.col("s_suppkey").cast("string").alias("_id"), F.lit("erp").alias("_source"), F.lit("P").alias("_application"), F.col("s_suppkey").alias("_last_event"), none().alias("_date_deleted"), _ref(F.col("p_brand")).alias("ref"))


def order_states(spark, d) -> DataFrame:
    """Sources with states: a customer's orders, each valid until the next; orders of one day make states of no length."""
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumns({"seqnr": F.row_number().over(w), "valid_to": F.lead("o_orderdate").over(w)})
    return o.select(F.col("o_custkey").cast("string").alias("_id"), "seqnr", F.lit("crm").alias("_source"), F.lit("P").alias("_application"), F.col("o_orderkey").alias("_last_event"), none().alias("_date_deleted"), F.col("o_orderdate").alias("valid_from"), "valid_to", _ref(F.col("c_nationkey").cast("string")).alias("ref"))


def nation_states(spark, d) -> DataFrame:
    """Destinations with states: each nation by year, the last year open."""
    year = F.explode(F.sequence(F.lit(1994), F.lit(2001))).alias("y")
    n = table(spark, d, "nation").select("n_nationkey", year)
    return n.select(F.col("n_nationkey").cast("string").alias("_id"), (F.col("y") - 1993).alias("seqnr"), F.lit("geo").alias("_source"), F.col("y").cast("long").alias("_last_event"), none().alias("_date_deleted"), F.make_timestamp("y", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("valid_from"), F.when(F.col("y") < 2001, F.make_timestamp(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))).alias("valid_to"), F.col("n_nationkey").cast("string").alias("code"))


def relation(spark, d) -> DataFrame:
    """An existing relation: that of the customers but for every 7th, with some destinations changed and some rows deleted."""
    rows = relation_rows(match(customers(spark, d), nations(spark, d), SPECS), SPECS)
    key = F.col("src_id").cast("long")
    rows = rows.where(key % 7 != 0)
    return rows.withColumns({"dst_id": F.when(key % 29 == 0, "999").otherwise(F.col("dst_id")), "_last_event": key + 5000, "_date_deleted": F.when(key % 31 == 0, F.lit("2021-01-01").cast("timestamp"))})


def matched(spark, d, **kw) -> DataFrame:
    return match(customers(spark, d), nations(spark, d), SPECS, **kw)


SLIM = ["_application", "src_id", "src_source", "value", "dst_id", "row_number"]


def q_match_multi_app(spark, d):
    return matched(spark, d).select(*SLIM)


def q_match_single(spark, d):
    src = customers(spark, d).withColumn("_application", F.lit("P"))
    return match(src, nations(spark, d), CODE_BY_COLUMN).select("src_id", "value", "dst_id")


def q_match_keep_unmatched(spark, d):
    return matched(spark, d, keep_unmatched=True).select(*SLIM)


def q_match_many(spark, d):
    return match(order_lines(spark, d), parts(spark, d), PART, many=True).select("src_id", "value", "dst_id")


def q_match_multiple_allowed(spark, d):
    rows = relation_rows(match(suppliers(spark, d), parts(spark, d), BRAND, crowded=True), BRAND)
    return rows.select("id", "derivation", "src_id", "dst_id", F.col("row_number").cast("long").alias("row_number"))


def state_rows(spark, d):
    return relation_rows(match(order_states(spark, d), nation_states(spark, d), PART, src_states=True, dst_states=True), PART, True, True)


def q_match_states(spark, d):
    return state_rows(spark, d).select("id", "src_id", "src_seqnr", "dst_id", "dst_seqnr", as_text(F.col("valid_from"), "timestamp").alias("valid_from"), as_text(F.col("valid_to"), "timestamp").alias("valid_to"))


def q_match_many_states(spark, d):
    """As ``match_states``, met by stretches of 200 days, of each source's values split over all tasks."""
    rows = match(order_states(spark, d), nation_states(spark, d), PART, src_states=True, dst_states=True, period_days=200, spread=True)
    return relation_rows(rows, PART, True, True).select("id", "src_id", "src_seqnr", "dst_id", "dst_seqnr", as_text(F.col("valid_from"), "timestamp").alias("valid_from"), as_text(F.col("valid_to"), "timestamp").alias("valid_to"))


def q_match_collapsed(spark, d):
    collapsed = order_states(spark, d).where("valid_from = valid_to")
    return match(collapsed, nation_states(spark, d), PART, src_states=True, dst_states=True).select("src_id", "src_seqnr", "dst_id", "dst_seqnr")


def q_match_valid_now(spark, d):
    src = customers(spark, d).withColumn("_application", F.lit("P")).withColumn("ref", _ref(F.col("nation_code")))
    return match(src, nation_states(spark, d), PART, dst_states=True, as_of=F.lit("1999-06-01").cast("timestamp")).select("src_id", "dst_id", "dst_seqnr")


def q_relation_key(spark, d):
    return relation_rows(matched(spark, d), SPECS).select("id", "derivation", "_last_src_event", "_last_dst_event", as_text(F.col("valid_to"), "timestamp").alias("valid_to"))


def q_check_specs(spark, d):
    return check_specs(customers(spark, d), SPECS[:1])


def q_marks(spark, d):
    return marks(customers(spark, d), nations(spark, d), relation(spark, d))


def seen(spark, d) -> int:
    """The last event of the source that the relation has taken in: half of all."""
    return table(spark, d, "customer").agg(F.max("c_custkey")).first()[0] // 2


def q_change_ratio(spark, d):
    return change_ratio(customers(spark, d), nations(spark, d), seen(spark, d), 10)


def _related(spark, d, mode):
    return relate(customers(spark, d), nations(spark, d), relation(spark, d), SPECS, mode, seen(spark, d), 10)


def q_relate_update(spark, d):
    """Two rounds of ``update``: the first on an empty table and the older sources, the second on all. The live relations that result."""
    src, dst, at = customers(spark, d), nations(spark, d), F.lit("2024-01-01").cast("timestamp")
    first = written(update(src.where(F.col("_last_event") <= seen(spark, d)), dst, empty_relation(src, dst, SPECS), SPECS, 0, at)[0], "relation")
    second, _, _ = update(src, dst, first, SPECS, 1_000_000_000, at)
    return second.where("_date_deleted IS NULL").select("id", "src_id", "dst_id", "derivation", "_last_src_event")


def q_update_all(spark, d):
    """Two runs over a catalogue: the second, with the marks of the first, relates nothing again."""
    at = F.lit("2024-01-01").cast("timestamp")
    one = {"src": customers(spark, d), "dst": nations(spark, d), "specs": SPECS}
    first = update_all({"crm_customer_nation": one | {"rel": empty_relation(one["src"], one["dst"], SPECS)}, "crm_none": {"specs": []}}, 0, at)
    done = first["crm_customer_nation"]
    again = update_all({"crm_customer_nation": one | {"rel": written(done.table, "relation")}}, 1_000_000_000, at, {"crm_customer_nation": done.last})["crm_customer_nation"]
    rows = lambda run, r: r.events.agg(F.lit(run).alias("run"), F.lit(r.mode).alias("mode"), F.count("*").alias("events"), F.coalesce(F.max("eventid"), F.lit(0)).alias("top"), F.lit(r.last[0]).cast("long").alias("last_src"), F.lit(r.last[1]).cast("long").alias("last_dst"))
    return rows(1, done).unionByName(rows(2, again))


def q_relate_precondition(spark, d):
    """The applications that keep a relation from being made, for specs that know only one of them."""
    return check_specs(order_lines(spark, d).select("_application").unionByName(customers(spark, d).select("_application")), SPECS)


def places(spark, d) -> DataFrame:
    """Sources with a location; every 50th customer's outline crosses itself."""
    x, y, key = (F.col("c_custkey") * 7 % 1000) / 10, F.col("c_acctbal") / 100, F.col("c_custkey")
    at = F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))
    wkt = F.when(key % 50 == 0, "POLYGON ((0 0, 8 8, 8 0, 0 8, 0 0))").otherwise(at)
    return table(spark, d, "customer").select(key.cast("string").alias("_id"), F.lit("crm").alias("_source"), F.lit("M").alias("_application"), key.alias("_last_event"), none().alias("_date_deleted"), wkt.alias("place"), _ref(F.lit("here")).alias("ref"))


def areas(spark, d) -> DataFrame:
    """Destinations with outlines: rectangles of different widths, and one that is far larger."""
    key = F.col("n_nationkey")
    number = lambda v: v.cast("double").cast("string")
    low, high = number(key * 4 + F.lit(0.25)), number(key * 4 + 1 + key % 3)
    box = lambda a, b, c, e: F.concat(F.lit("POLYGON (("), a, F.lit(" "), b, F.lit(", "), c, F.lit(" "), b, F.lit(", "), c, F.lit(" "), e, F.lit(", "), a, F.lit(" "), e, F.lit(", "), a, F.lit(" "), b, F.lit("))"))
    wkt = F.when(key == 24, box(F.lit("-1000"), F.lit("50"), F.lit("1000"), F.lit("1000"))).otherwise(box(low, F.lit("-5"), high, F.lit("50")))
    return table(spark, d, "nation").select(key.cast("string").alias("_id"), F.lit("geo").alias("_source"), (key + 1).cast("long").alias("_last_event"), none().alias("_date_deleted"), wkt.alias("area"))


def q_relate_spatial(spark, d):
    rows = relation_rows(match(places(spark, d), areas(spark, d), INSIDE), INSIDE)
    return rows.select("id", "derivation", "src_id", "dst_id")


def q_relate_spatial_multi(spark, d):
    """Lines, groups of points and single points in areas of two parts."""
    x, y, key = (F.col("c_custkey") * 7 % 1000) / 10, F.col("c_acctbal") / 100, F.col("c_custkey")
    pair = lambda a: F.concat(a.cast("string"), F.lit(" "), y.cast("string"))
    place = F.when(key % 3 == 1, F.concat(F.lit("LINESTRING ("), pair(x - 1), F.lit(", "), pair(x), F.lit(", "), pair(x + 1), F.lit(")")))
    place = place.when(key % 3 == 2, F.concat(F.lit("MULTIPOINT (("), pair(x), F.lit("), ("), pair(x + 1), F.lit("), ("), pair(x - 1), F.lit("))"))).otherwise(F.concat(F.lit("POINT ("), pair(x), F.lit(")")))
    src = places(spark, d).drop("place").join(table(spark, d, "customer").select(key.cast("string").alias("_id"), place.alias("place")), "_id")
    n, number = F.col("n_nationkey"), lambda v: v.cast("double").cast("string")
    low, high = number(n * 4 + F.lit(0.25)), number(n * 4 + 1 + n % 3)
    box = lambda b, e: F.concat(F.lit("(("), F.concat_ws(", ", *[F.concat(p, F.lit(f" {q}")) for p, q in ((low, b), (high, b), (high, e), (low, e), (low, b))]), F.lit("))"))
    parts = table(spark, d, "nation").select(n.cast("string").alias("_id"), F.lit("geo").alias("_source"), (n + 1).cast("long").alias("_last_event"), none().alias("_date_deleted"), F.concat(F.lit("MULTIPOLYGON ("), box(-5, 20), F.lit(", "), box(30, 50), F.lit(")")).alias("area"))
    return relation_rows(match(src, parts, INSIDE), INSIDE).select("id", "derivation", "src_id", "dst_id")


def q_match_hot(spark, d):
    """Half of all lines refer to one part; such a value's rows are split over all tasks. Lines of one number count once."""
    value = F.when(F.col("l_linenumber") % 2 == 1, F.lit("1")).otherwise(F.col("l_partkey").cast("string"))
    lines = table(spark, d, "lineitem").select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("_id"), F.lit("shop").alias("_source"), F.lit("P").alias("_application"), F.col("l_orderkey").alias("_last_event"), none().alias("_date_deleted"), _ref(value).alias("ref"))
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("_id"), F.lit("erp").alias("_source"), F.col("p_partkey").alias("_last_event"), none().alias("_date_deleted"), F.col("p_partkey").cast("string").alias("code"))
    spec = [RelationSpec("P", "code")]
    rows = relation_rows(match(lines, p, spec, spread=True), spec)
    return rows.groupBy("dst_id").agg(F.count("*").alias("n"), F.min("src_id").alias("least"), F.max("src_id").alias("greatest"))


def q_relate_full(spark, d):
    return _related(spark, d, "full").select("id", "dst_id", "rel_id", "rel_dst_id")


def q_relate_incremental(spark, d):
    return _related(spark, d, "incremental").select("id", "dst_id", "rel_id", "rel_dst_id")


def q_relation_events(spark, d):
    return relation_events(_related(spark, d, "full")).select("event", "tid", "last_event", F.size("modifications").alias("n_changed"))


def q_obsolete_relations(spark, d):
    rows = relation_rows(match(customers(spark, d).where("_last_event % 5 <> 0"), nations(spark, d), SPECS), SPECS)
    return obsolete_relations(relation(spark, d), customers(spark, d), nations(spark, d).where("_last_event > 10"), rows).select("id", "dst_id")


def q_relate_all(spark, d):
    s, n, r = customers(spark, d), nations(spark, d), relation(spark, d)
    out = relate_all({"crm_customer_nation": {"src": s, "dst": n, "rel": r, "specs": SPECS}, "crm_none": {"src": s, "dst": n, "rel": r, "specs": []}, "crm_many": {"src": s, "dst": n, "rel": r, "specs": SPECS, "very_many": True}})
    frames = [e.groupBy("event").agg(F.count("*").alias("n")).select(F.lit(k).alias("relation"), "event", "n") for k, e in out.items()]
    return frames[0]


def _conflicts(spark, d):
    return conflicts(match(suppliers(spark, d), parts(spark, d), ONE_BRAND, crowded=True), ONE_BRAND)


def q_conflicts(spark, d):
    return _conflicts(spark, d).select("src_id", "value", "dst_id", F.col("row_number").cast("long").alias("row_number"))


def _last_conflicts(spark, d):
    return conflicts(match(suppliers(spark, d), parts(spark, d), ONE_BRAND, last=True), ONE_BRAND)


def q_ambiguous(spark, d):
    return quality.ambiguous(_last_conflicts(spark, d), "brand").drop("src_seqnr")


def q_missing_single(spark, d):
    return quality.missing_values(customers(spark, d), "ref", SPECS).drop("src_seqnr")


def q_missing_many(spark, d):
    return quality.missing_values(order_lines(spark, d), "ref", many=True).groupBy("check", "attribute", "src_id", "source").agg(F.count("*").alias("n"))


def q_dangling(spark, d):
    return quality.dangling(customers(spark, d), relation(spark, d), "ref").drop("src_seqnr")


def q_historic_counts(spark, d):
    src = customers(spark, d)
    return quality.historic_counts(quality.dangling(src, relation(spark, d), "ref"), src)


def _holey(spark, d):
    return relation(spark, d).withColumns({"dst_id": F.when(F.col("src_id").cast("long") % 4 != 0, F.col("dst_id")), "value": F.when(F.col("src_id").cast("long") % 9 != 0, F.col("value"))})


def q_very_many_missing(spark, d):
    return quality.very_many_checks(customers(spark, d), _holey(spark, d), "ref", "missing").drop("src_seqnr")


def q_very_many_dangling(spark, d):
    return quality.very_many_checks(customers(spark, d), _holey(spark, d), "ref", "dangling").drop("src_seqnr")


def q_check_relation(spark, d):
    found = quality.check_relation("single", customers(spark, d), relation(spark, d), "ref", _last_conflicts(spark, d), SPECS)
    return found.groupBy("check").agg(F.count("*").alias("n"))


def q_null_audit(spark, d):
    return quality.audit_relation(_holey(spark, d))


def q_unique_violations(spark, d):
    return quality.unique_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_orphan_references(spark, d):
    return quality.orphan_references(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders").where("o_orderkey % 5 <> 0"), "o_orderkey")


def q_current_entity(spark, d):
    return quality.current_entity(customers(spark, d).withColumn("_tid", F.col("_id")), "42").select("_tid", "_application", "nation_code")


def q_relation_view(spark, d):
    return relation_view(relation(spark, d)).select("id", "src_id", "dst_id", as_text(F.col("valid_to"), "timestamp").alias("valid_to"), "value")


def q_refresh_views(spark, d):
    return refresh_views({"states": (state_rows(spark, d).withColumn("_date_deleted", none()), True, True)})["states"].select("id", "src_seqnr", "dst_seqnr")


def q_latest_state(spark, d):
    return latest_state(order_states(spark, d), ["_id"]).select("_id", "seqnr", as_text(F.col("valid_from"), "timestamp").alias("valid_from"))


def q_islands(spark, d):
    """States of an order's year: the states of every 5th number are taken out, which breaks the runs."""
    broken = order_states(spark, d).where("seqnr % 5 <> 0")
    return islands(broken, ["_id"]).select("_id", "seqnr", as_text(F.col("island_from"), "timestamp").alias("island_from"))


QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}

_TS = "'%Y-%m-%dT%H:%M:%S.%f'"
_SRC = """
s AS (SELECT c_custkey AS key, c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS app, c_custkey % 23 = 0 AS deleted, c_nationkey::VARCHAR AS code,
  CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2022-01-01' END AS valid_to,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 'nowhere' WHEN c_custkey % 2 = 0 THEN n_name ELSE c_nationkey::VARCHAR END AS value
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
n AS (SELECT n_nationkey AS key, n_nationkey::VARCHAR AS id, n_name AS name, n_nationkey + 1 AS last FROM nation WHERE n_nationkey <> 24),
m AS (SELECT s.*, n.id AS dst_id, n.last AS dst_last FROM s JOIN n ON s.value = CASE s.app WHEN 'A' THEN n.name ELSE n.id END),
k AS (SELECT *, id || '.crm.' || value AS rid FROM m),
rel AS (SELECT rid, key, id, value, app, valid_to, dst_last, CASE WHEN key % 29 = 0 THEN '999' ELSE dst_id END AS dst_id, key + 5000 AS last, key % 31 = 0 AS gone FROM k WHERE key % 7 <> 0),
half AS (SELECT max(c_custkey) // 2 AS seen FROM customer)
"""
_S = f"WITH {_SRC}"
_STATES = """
WITH o AS (SELECT o_custkey::VARCHAR AS id, o_orderkey, o_orderdate AS f, c_nationkey::VARCHAR AS value,
  row_number() OVER w AS seqnr, lead(o_orderdate) OVER w AS t FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
ns AS (SELECT n_nationkey::VARCHAR AS id, y - 1993 AS seqnr, make_timestamp(y, 1, 1, 0, 0, 0) AS f, CASE WHEN y < 2001 THEN make_timestamp(y + 1, 1, 1, 0, 0, 0) END AS t FROM nation, range(1994, 2002) r(y)),
j AS (SELECT o.id AS src_id, o.seqnr AS src_seqnr, o.value, o.f AS sf, o.t AS st, ns.id AS dst_id, max(ns.seqnr) AS dst_seqnr, arg_max(ns.f, ns.seqnr) AS df, arg_max({'t': ns.t}, ns.seqnr).t AS dt
  FROM o JOIN ns ON ns.id = o.value AND (
    (coalesce(o.f <> o.t, true) AND (o.t IS NULL OR ns.f < o.t) AND (ns.t IS NULL OR coalesce(ns.t >= o.t, false)))
    OR (o.f = o.t AND ns.f <= o.t AND (ns.t IS NULL OR ns.t >= o.t)))
  GROUP BY ALL)
"""
_BRANDS = """
WITH s AS (SELECT s_suppkey::VARCHAR AS id, p_brand AS value FROM supplier JOIN part ON s_suppkey = p_partkey),
p AS (SELECT p_partkey::VARCHAR AS id, p_brand FROM part WHERE p_partkey % 7 <> 0),
m AS (SELECT s.id AS src_id, s.value, p.id AS dst_id, row_number() OVER (PARTITION BY s.id, s.value ORDER BY p.id) AS row_number FROM s JOIN p ON s.value = p.p_brand)
"""
_SLIM = "app AS _application, id AS src_id, 'crm' AS src_source, value, dst_id, 1::INTEGER AS row_number"
_FULL = ", r AS (SELECT * FROM k), u AS (SELECT r.rid AS id, r.dst_id, r.deleted AS sdel, r.valid_to AS vt, rel.rid AS rel_id, rel.dst_id AS rel_dst_id, rel.valid_to AS rvt, rel.last AS rlast, rel.gone AS rgone FROM r LEFT JOIN rel ON rel.rid = r.rid UNION ALL SELECT NULL, NULL, NULL, NULL, rid, dst_id, valid_to, last, gone FROM rel WHERE NOT gone AND rid NOT IN (SELECT rid FROM r))"
_EVENTS = _S + _FULL + """, ev AS (
  SELECT CASE WHEN (id IS NULL OR sdel) AND (rel_id IS NULL OR rgone) THEN NULL WHEN id IS NULL OR sdel THEN 'DELETE' WHEN rel_id IS NULL OR rgone THEN 'ADD' WHEN dst_id IS DISTINCT FROM rel_dst_id THEN 'MODIFY' END AS event,
    coalesce(id, rel_id) AS tid, rlast FROM u)"""
_DANGLING = _S + ", dg AS (SELECT s.* FROM s WHERE NOT deleted AND value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rel WHERE NOT gone AND rel.id = s.id AND rel.value = s.value))"
_HOLEY = _S + ", h AS (SELECT * REPLACE (CASE WHEN key % 4 <> 0 THEN dst_id END AS dst_id, CASE WHEN key % 9 <> 0 THEN value END AS value) FROM rel)"

ORACLE_SQL = {
    "match_multi_app": f"{_S} SELECT {_SLIM} FROM m",
    "match_single": f"{_S} SELECT s.id AS src_id, s.value, n.id AS dst_id FROM s JOIN n ON s.code = n.id",
    "match_keep_unmatched": f"{_S} SELECT {_SLIM} FROM (SELECT s.*, m.dst_id FROM s LEFT JOIN m ON m.id = s.id)",
    "match_many": "SELECT DISTINCT l_orderkey::VARCHAR AS src_id, l_partkey::VARCHAR AS value, p_partkey::VARCHAR AS dst_id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_partkey % 10 <> 0 AND p_partkey % 7 <> 0",
    "match_multiple_allowed": f"{_BRANDS} SELECT src_id || '.erp.' || value || '.' || dst_id AS id, 'brand' AS derivation, src_id, dst_id, row_number FROM m",
    "match_states": f"{_STATES} SELECT src_id || '.' || src_seqnr || '.crm.' || value AS id, src_id, src_seqnr::INTEGER AS src_seqnr, dst_id, dst_seqnr::INTEGER AS dst_seqnr, strftime(greatest(sf, df), {_TS}) AS valid_from, strftime(least(st, dt), {_TS}) AS valid_to FROM j",
    "match_many_states": f"{_STATES} SELECT src_id || '.' || src_seqnr || '.crm.' || value AS id, src_id, src_seqnr::INTEGER AS src_seqnr, dst_id, dst_seqnr::INTEGER AS dst_seqnr, strftime(greatest(sf, df), {_TS}) AS valid_from, strftime(least(st, dt), {_TS}) AS valid_to FROM j",
    "match_collapsed": f"{_STATES} SELECT src_id, src_seqnr::INTEGER AS src_seqnr, dst_id, dst_seqnr::INTEGER AS dst_seqnr FROM j WHERE sf = st",
    "match_valid_now": "SELECT c_custkey::VARCHAR AS src_id, c_nationkey::VARCHAR AS dst_id, 8::INTEGER AS dst_seqnr FROM customer",
    "relation_key": f"{_S} SELECT rid AS id, CASE app WHEN 'A' THEN 'name' ELSE 'code' END AS derivation, key AS _last_src_event, dst_last::BIGINT AS _last_dst_event, strftime(valid_to, {_TS}) AS valid_to FROM k",
    "check_specs": f"{_S} SELECT DISTINCT app AS _application FROM s WHERE app <> 'A'",
    "marks": f"{_S} SELECT (SELECT max(key) FROM rel) AS last_src, (SELECT max(dst_last) FROM rel)::BIGINT AS last_dst, (SELECT max(key) FROM s) AS max_src, (SELECT max(n_nationkey) + 1 FROM nation)::BIGINT AS max_dst",
    "change_ratio": f"{_S}, r AS (SELECT (SELECT count(*) FILTER (key > (SELECT seen FROM half)) / count(*) FROM s) AS src_ratio, (SELECT count(*) FILTER (n_nationkey + 1 > 10) / count(*) FROM nation) AS dst_ratio) SELECT *, src_ratio + dst_ratio >= 1 AS \"full\" FROM r",
    "relate_full": f"{_S}{_FULL} SELECT id, dst_id, rel_id, rel_dst_id FROM u",
    "relate_incremental": f"{_S}, r AS (SELECT * FROM k WHERE key > (SELECT seen FROM half) OR dst_last > 10), g AS (SELECT * FROM rel WHERE NOT gone AND (key > (SELECT seen FROM half) OR dst_id IN (SELECT (n_nationkey)::VARCHAR FROM nation WHERE n_nationkey + 1 > 10)) AND rid NOT IN (SELECT rid FROM r)) SELECT r.rid AS id, r.dst_id, rel.rid AS rel_id, rel.dst_id AS rel_dst_id FROM r LEFT JOIN rel ON rel.rid = r.rid UNION ALL SELECT NULL, NULL, rid, dst_id FROM g",
    "relate_update": f"{_S} SELECT rid AS id, id AS src_id, dst_id, CASE app WHEN 'A' THEN 'name' ELSE 'code' END AS derivation, key AS _last_src_event FROM k WHERE NOT deleted",
    "update_all": f"{_S}, e AS (SELECT count(DISTINCT rid) AS n FROM k WHERE NOT deleted), t AS (SELECT (SELECT max(c_custkey) FROM customer) AS a, (SELECT max(n_nationkey) + 1 FROM nation) AS b) SELECT 1 AS run, 'full' AS mode, n AS events, n AS top, a AS last_src, b::BIGINT AS last_dst FROM e, t UNION ALL SELECT 2, 'incremental', 0, 0, a, b FROM t",
    "relate_precondition": "SELECT 'P' AS _application",
    "relate_spatial": "WITH c AS (SELECT c_custkey, (c_custkey * 7 % 1000) / 10.0::DOUBLE AS x, c_acctbal / 100 AS y FROM customer WHERE c_custkey % 50 <> 0) SELECT c_custkey::VARCHAR || '.crm.here' AS id, 'area' AS derivation, c_custkey::VARCHAR AS src_id, n_nationkey::VARCHAR AS dst_id FROM c JOIN nation ON CASE WHEN n_nationkey = 24 THEN y > 50 ELSE x > 4 * n_nationkey + 0.25 AND x < 4 * n_nationkey + 1 + n_nationkey % 3 AND y > -5 AND y < 50 END",
    "relate_spatial_multi": "WITH c AS (SELECT c_custkey, (c_custkey * 7 % 1000) / 10.0::DOUBLE AS x, c_acctbal / 100 AS y FROM customer) SELECT c_custkey::VARCHAR || '.crm.here' AS id, 'area' AS derivation, c_custkey::VARCHAR AS src_id, n_nationkey::VARCHAR AS dst_id FROM c JOIN nation ON x > 4 * n_nationkey + 0.25 AND x < 4 * n_nationkey + 1 + n_nationkey % 3 AND (y > -5 AND y < 20 OR y > 30 AND y < 50)",
    "match_hot": "WITH r AS (SELECT l_orderkey || '.' || l_linenumber AS src, CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE l_partkey END AS part FROM lineitem) SELECT part::VARCHAR AS dst_id, count(DISTINCT src) AS n, min(src) AS least, max(src) AS greatest FROM r JOIN part ON p_partkey = part GROUP BY part",
    "relation_events": f"{_EVENTS} SELECT event, tid, CASE WHEN event <> 'ADD' THEN rlast END AS last_event, CASE WHEN event = 'MODIFY' THEN 1 END::INTEGER AS n_changed FROM ev WHERE event IS NOT NULL",
    "obsolete_relations": f"{_S} SELECT rid AS id, dst_id FROM rel WHERE NOT gone AND rid NOT IN (SELECT rid FROM k WHERE key % 5 <> 0)",
    "relate_all": f"{_EVENTS} SELECT 'crm_customer_nation' AS relation, event, count(*) AS n FROM ev WHERE event IS NOT NULL GROUP BY event",
    "conflicts": f"{_BRANDS} SELECT * FROM m WHERE row_number > 1",
    "ambiguous": f"{_BRANDS} SELECT 'ambiguous' AS check, 'brand' AS attribute, src_id, value, 'erp' AS source, max(row_number) AS destinations FROM m WHERE row_number > 1 GROUP BY src_id, value".replace("AS check", 'AS "check"'),
    "missing_single": f"{_S} SELECT 'missing' AS \"check\", 'ref' AS attribute, id AS src_id, NULL::VARCHAR AS value, 'crm' AS source FROM s WHERE NOT deleted AND value IS NULL AND app = 'A'",
    "missing_many": "SELECT 'missing' AS \"check\", 'ref' AS attribute, l_orderkey::VARCHAR AS src_id, 'shop' AS source, count(*) AS n FROM lineitem WHERE l_partkey % 10 = 0 GROUP BY l_orderkey",
    "dangling": f"{_DANGLING} SELECT 'dangling' AS \"check\", 'ref' AS attribute, id AS src_id, value, 'crm' AS source FROM dg",
    "historic_counts": f"{_DANGLING} SELECT 'dangling' AS \"check\", count(*) FILTER (valid_to IS NULL) AS reported, count(*) FILTER (valid_to IS NOT NULL) AS historic FROM dg",
    "very_many_missing": f"{_HOLEY} SELECT 'missing' AS \"check\", 'ref' AS attribute, id AS src_id, NULL::VARCHAR AS value, 'crm' AS source FROM s WHERE NOT deleted AND NOT EXISTS (SELECT 1 FROM h WHERE NOT gone AND h.value IS NOT NULL AND h.id = s.id)",
    "very_many_dangling": f"{_HOLEY} SELECT DISTINCT 'dangling' AS \"check\", 'ref' AS attribute, s.id AS src_id, h.value, 'crm' AS source FROM s JOIN h ON h.id = s.id WHERE NOT deleted AND NOT gone AND h.value IS NOT NULL AND h.dst_id IS NULL",
    "check_relation": f"{_S} SELECT 'missing' AS \"check\", count(*) AS n FROM s WHERE NOT deleted AND value IS NULL AND app = 'A' UNION ALL SELECT 'dangling', count(*) FROM s WHERE NOT deleted AND app = 'A' AND value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rel WHERE NOT gone AND rel.id = s.id AND rel.value = s.value) UNION ALL SELECT 'ambiguous', count(DISTINCT src_id) FROM ({_BRANDS} SELECT * FROM m WHERE row_number > 1)",
    "null_audit": f"{_HOLEY} SELECT count(*) AS total, count(*) FILTER (value IS NULL) AS null_values, count(*) FILTER (value IS NULL AND NOT gone) AS live_null_values FROM h",
    "unique_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "orphan_references": "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY l_orderkey",
    "current_entity": f"{_S} SELECT id AS _tid, app AS _application, code AS nation_code FROM s WHERE id = '42' AND NOT deleted",
    "relation_view": f"{_S} SELECT rid AS id, id AS src_id, dst_id, strftime(valid_to, {_TS}) AS valid_to, value FROM rel WHERE NOT gone",
    "refresh_views": f"{_STATES} SELECT src_id || '.' || src_seqnr || '.crm.' || value AS id, src_seqnr::INTEGER AS src_seqnr, dst_seqnr::INTEGER AS dst_seqnr FROM j",
    "latest_state": f"{_STATES} SELECT id AS _id, seqnr::INTEGER AS seqnr, strftime(f, {_TS}) AS valid_from FROM o QUALIFY seqnr = max(seqnr) OVER (PARTITION BY id)",
    "islands": f"{_STATES}, b AS (SELECT *, CASE WHEN lag(t) OVER (PARTITION BY id ORDER BY seqnr) = f THEN 0 ELSE 1 END AS new FROM o WHERE seqnr % 5 <> 0), i AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY seqnr) AS isl FROM b) SELECT id AS _id, seqnr::INTEGER AS seqnr, strftime(min(f) OVER (PARTITION BY id, isl), {_TS}) AS island_from FROM i",
}
