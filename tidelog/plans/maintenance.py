"""Queries over enrichment, geometry and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.spatial import lies_in
from tidelog.operators import evolve
from tidelog.operators.enrich import autoid, enrich, geounion_problems
from tidelog.plans.upload import _D, _IDS, account_log, current_orders, order_log, table
from tidelog.sources import eventlog
from tidelog.sources.shared import shared_path
from tidelog.specs import AutoIdSpec, ColumnChange

CODES = AutoIdSpec("code", "s_suppkey", "9XXXXXX")
MIGRATIONS = [
    evolve.Migration("0.1", "0.2", (("add", "b"),)),
    evolve.Migration("0.2", "0.3", (("delete", "a"), ("split_json", "a"))),
    evolve.Migration("0.3", "0.4", (("rename", "b", "c"),)),
]


def suppliers_with_codes(spark, d) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, d, "supplier").select(key.cast("string").alias("_id"), "s_suppkey", F.when(key % 10 == 1, F.concat(F.lit("9"), F.lpad((key + 500_000).cast("string"), 6, "0"))).alias("code"))


def stored_codes(spark, d) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, d, "supplier").where("s_suppkey % 4 = 0").select("s_suppkey", F.concat(F.lit("9"), F.lpad(key.cast("string"), 6, "0")).alias("code"))


def q_autoid(spark, d):
    return autoid(suppliers_with_codes(spark, d), stored_codes(spark, d), CODES)[0].select("s_suppkey", "code")


def q_autoid_conflicts(spark, d):
    rows = suppliers_with_codes(spark, d).withColumn("code", F.when(F.col("s_suppkey") % 10 == 1, F.concat(F.lit("9"), F.lpad((F.col("s_suppkey") % 50).cast("string"), 6, "0"))))
    return autoid(rows, stored_codes(spark, d), CODES)[1]


def q_enrich_dry_run(spark, d):
    spec = {"name": "autoid", "column": "code", "on": "s_suppkey", "template": "9XXXXXX", "stored": stored_codes(spark, d)}
    return enrich(suppliers_with_codes(spark, d), [spec], dry_run=True)


def q_geounion_points(spark, d):
    c = table(spark, d, "customer")
    points = c.select(F.col("c_custkey").alias("key"), F.concat(F.lit("POINT ("), F.floor("c_acctbal").cast("string"), F.lit(" "), (F.col("c_custkey") % 3).cast("string"), F.lit(")")).alias("geo"))
    of_nation = c.groupBy("c_nationkey").agg(F.collect_list("c_custkey").alias("refs")).select(F.col("c_nationkey").cast("string").alias("_id"), "refs", F.lit(None).cast("string").alias("geometry"))
    spec = {"name": "geounion", "column": "geometry", "on": "refs", "other": points, "key": "key", "geo": "geo"}
    return enrich(of_nation, [spec]).select("_id", "geometry")


def q_geounion_coverage(spark, d):
    """Rows of five unit squares, one per customer, become one polygon each."""
    c, key = table(spark, d, "customer"), F.col("c_custkey")
    x, y = (key % 5).cast("string"), F.floor(key / 5).cast("string")
    x1, y1 = (key % 5 + 1).cast("string"), (F.floor(key / 5) + 1).cast("string")
    square = F.concat(F.lit("POLYGON (("), x, F.lit(" "), y, F.lit(", "), x1, F.lit(" "), y, F.lit(", "), x1, F.lit(" "), y1, F.lit(", "), x, F.lit(" "), y1, F.lit(", "), x, F.lit(" "), y, F.lit("))"))
    squares = c.select(key.alias("key"), square.alias("geo"))
    rows = c.groupBy(F.floor(key / 5).cast("string").alias("_id")).agg(F.collect_list("c_custkey").alias("refs")).withColumn("geometry", F.lit(None).cast("string"))
    spec = {"name": "geounion", "column": "geometry", "on": "refs", "other": squares, "key": "key", "geo": "geo", "kind": "coverage"}
    return enrich(rows, [spec]).select("_id", "geometry")


def _staircase(spark, d):
    """Squares of side 2 on a diagonal, one per customer, of which neighbours overlap; and the rows that refer to five of them each."""
    c, key = table(spark, d, "customer"), F.col("c_custkey")
    text = lambda v: v.cast("long").cast("string")
    x, y = F.floor(key / 5) * 10 + key % 5, key % 5
    corners = [(x, y), (x + 2, y), (x + 2, y + 2), (x, y + 2), (x, y)]
    square = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat(text(a), F.lit(" "), text(b)) for a, b in corners]), F.lit("))"))
    squares = c.select(key.alias("key"), F.when(key % 7 == 0, "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))").otherwise(square).alias("geo"))
    rows = c.groupBy(F.floor(key / 5).cast("string").alias("_id")).agg(F.collect_list("c_custkey").alias("refs")).withColumn("geometry", F.lit(None).cast("string"))
    return rows, {"column": "geometry", "on": "refs", "other": squares, "key": "key", "geo": "geo"}


def q_geounion_overlap(spark, d):
    """Overlapping squares become one staircase; where a square isn't valid the staircase falls apart into several."""
    rows, spec = _staircase(spark, d)
    return enrich(rows, [{"name": "geounion", "kind": "coverage", **spec}]).select("_id", "geometry")


def q_geounion_problems(spark, d):
    rows, spec = _staircase(spark, d)
    return geounion_problems(rows, **spec)


def q_lies_in(spark, d):
    c, n = table(spark, d, "customer"), F.col("n_nationkey")
    point = F.concat(F.lit("POINT ("), ((F.col("c_custkey") * 7 % 1000) / 10).cast("string"), F.lit(" "), (F.col("c_acctbal") / 100).cast("string"), F.lit(")"))
    at = lambda v: v.cast("double").cast("string")
    pair = lambda a, b: F.concat(at(a), F.lit(" "), at(b))
    triangle = [(4 * n, F.lit(-20)), (4 * n + 4, F.lit(-20)), (4 * n + 2, F.lit(100)), (4 * n, F.lit(-20))]
    box = [(4 * n + 0.5, F.lit(0)), (4 * n + 3.5, F.lit(0)), (4 * n + 3.5, F.lit(50)), (4 * n + 0.5, F.lit(50)), (4 * n + 0.5, F.lit(0))]
    wkt = lambda ps: F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[pair(*p) for p in ps]), F.lit("))"))
    areas = table(spark, d, "nation").select(n.cast("string").alias("_id"), F.when(n % 2 == 0, wkt(triangle)).otherwise(wkt(box)).alias("area"))
    return lies_in(c.select(F.col("c_custkey").cast("string").alias("_id"), point.alias("at")), areas, "at", "area", 4.0)


def q_split_json(spark, d):
    return evolve.split_json(table(spark, d, "events"), "props", {"props_k": "k"}, {"props_k": "int"}).select("event_id", "props_k")


def q_merge_json(spark, d):
    return evolve.merge_json(table(spark, d, "events"), "merged", {"user_id": "user", "event_type": "type"}).select("event_id", "merged")


def q_rename_relation(spark, d):
    log, _ = evolve.rename_relation(order_log(spark, d), current_orders(spark, d), "orders", "purchases", ("o_custkey", "customer"))
    return log.groupBy("entity", "action").agg(F.count("*").alias("n"))


def q_column_occurrence(spark, d):
    return evolve.column_occurrence(order_log(spark, d))


def versioned_log(spark, d) -> DataFrame:
    """Events whose columns change at times: a, then a and b, then b, then c; every fourth a MODIFY."""
    e, i = table(spark, d, "events"), F.col("event_id")
    v = F.col("event_type")
    keys = F.when(i < 3000, F.array(F.lit("a"))).when(i < 6000, F.array(F.lit("a"), F.lit("b"))).when(i < 8000, F.array(F.lit("b"))).otherwise(F.array(F.lit("c")))
    entity = F.when(i % 4 != 0, F.map_from_arrays(keys, F.transform(keys, lambda _: v)))
    mods = F.when(i % 4 == 0, F.transform(keys, lambda k: F.struct(k.alias("key"), v.alias("old_value"), v.alias("new_value"))))
    return e.select(i.alias("eventid"), F.when(i % 4 == 0, "MODIFY").otherwise("ADD").alias("action"), F.lit("0.1").alias("version"), F.to_json(F.struct(entity.alias("entity"), mods.alias("modifications"))).alias("contents"))


def q_repair_versions(spark, d):
    return evolve.repair_versions(versioned_log(spark, d), MIGRATIONS).select("eventid", "version")


def q_backfill_ids(spark, d):
    log = order_log(spark, d).withColumns({"source_id": F.col("tid"), "source": F.lit("src_a"), "tid": F.when(F.col("tid").cast("long") % 3 != 0, F.col("tid"))})
    entities = current_orders(spark, d).where("_source = 'src_a'").withColumn("_source_id", F.col("_id"))
    return evolve.backfill_tids(log, entities).select("eventid", "source_id", "tid")


def q_backfill_tid_of_states(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("seqnr")).select(F.col("l_orderkey").alias("id"), F.lit(None).cast("string").alias("_id"), "seqnr")
    return evolve.backfill_ids(rows, True).select("_id", "_tid")


def _changed(spark, d):
    return evolve.change_columns(table(spark, d, "customer"), [ColumnChange("c_custkey", "int", "key"), ColumnChange("c_name", "int"), ColumnChange("c_acctbal", "decimal(12,1)"), ColumnChange("c_mktsegment", "json")])


def q_change_columns(spark, d):
    return _changed(spark, d)[0].select("key", "c_name", F.col("c_acctbal").cast("string").alias("balance"), "c_mktsegment")


def q_change_columns_failed(spark, d):
    return _changed(spark, d)[1]


def q_purge(spark, d):
    return evolve.purge(order_log(spark, d).unionByName(account_log(spark, d)), "web", "accounts").groupBy("catalogue", "entity").agg(F.count("*").alias("n"))


def _log_on_disk(spark, d):
    """Both collections' events in one log, appended in three parts."""
    path = f"{shared_path(spark, 'log')}/log"
    eventlog.append(order_log(spark, d), path)
    for part in range(2):
        eventlog.append(account_log(spark, d).where((F.col("eventid") >= 500) == bool(part)), path)
    return path


def q_purge_files(spark, d):
    path = _log_on_disk(spark, d)
    eventlog.purge_files(spark, path, "web", "accounts")
    return eventlog.read_log(spark, path).groupBy("catalogue", "entity").agg(F.count("*").alias("n"))


def q_rename_files(spark, d):
    path = _log_on_disk(spark, d)
    eventlog.rename_files(spark, path, "shop", "orders", "purchases")
    return eventlog.read_log(spark, path).where("catalogue = 'shop'").groupBy("entity", "action").agg(F.count("*").alias("n"))


def q_tail_of_files(spark, d):
    return eventlog.tail_of_files(spark, _log_on_disk(spark, d), 499, "web").select("eventid", "tid", "action")


QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}

_CODES = """
WITH g AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 10 = 1 THEN '9' || lpad((s_suppkey + 500000)::VARCHAR, 6, '0') END AS given, CASE WHEN s_suppkey % 4 = 0 THEN '9' || lpad(s_suppkey::VARCHAR, 6, '0') END AS stored FROM supplier),
l AS (SELECT max(substr(v, 2)::BIGINT) AS last FROM (SELECT given AS v FROM g UNION ALL SELECT stored FROM g)),
i AS (SELECT k, (SELECT last FROM l) + row_number() OVER (ORDER BY k) AS no FROM g WHERE given IS NULL AND stored IS NULL),
r AS (SELECT g.k AS s_suppkey, g.given, coalesce(given, stored, '9' || lpad(no::VARCHAR, 6, '0')) AS code FROM g LEFT JOIN i ON i.k = g.k)
"""
ORACLE_SQL = {
    "autoid": f"{_CODES} SELECT s_suppkey, code FROM r",
    "autoid_conflicts": "WITH g AS (SELECT s_suppkey AS k, '9' || lpad((s_suppkey % 50)::VARCHAR, 6, '0') AS v FROM supplier WHERE s_suppkey % 10 = 1) SELECT 'given to several keys' AS problem, min(k)::VARCHAR AS key, v AS value FROM g GROUP BY v HAVING count(*) > 1",
    "enrich_dry_run": f"{_CODES} SELECT s_suppkey::VARCHAR AS _id, 'code' AS \"column\", given AS value, code AS proposed FROM r WHERE given IS NULL",
    "geounion_points": "WITH p AS (SELECT DISTINCT c_nationkey, floor(c_acctbal) AS x, c_custkey % 3 AS y FROM customer) SELECT c_nationkey::VARCHAR AS _id, 'MULTIPOINT (' || string_agg('(' || x::DECIMAL(18,3)::VARCHAR || ' ' || y::DECIMAL(18,3)::VARCHAR || ')', ', ' ORDER BY x, y) || ')' AS geometry FROM p GROUP BY c_nationkey",
    "geounion_coverage": "WITH g AS (SELECT c_custkey // 5 AS y, min(c_custkey % 5) AS a, max(c_custkey % 5) + 1 AS b FROM customer GROUP BY 1), p AS (SELECT y, 0 AS part, x AS x, y + 1 AS py, x AS o FROM g, range(0, 7) r(x) WHERE x BETWEEN a AND b UNION ALL SELECT y, 1, x, y, -x FROM g, range(0, 7) r(x) WHERE x BETWEEN a AND b) SELECT p.y::BIGINT::VARCHAR AS _id, 'POLYGON ((' || any_value(g.a)::DECIMAL(18,3)::VARCHAR || ' ' || p.y::DECIMAL(18,3)::VARCHAR || ', ' || string_agg(x::DECIMAL(18,3)::VARCHAR || ' ' || py::DECIMAL(18,3)::VARCHAR, ', ' ORDER BY part, o) || '))' AS geometry FROM p JOIN g ON g.y = p.y GROUP BY p.y",
    "geounion_overlap": """
      WITH c AS (SELECT c_custkey // 5 AS g, c_custkey % 5 AS i FROM customer WHERE c_custkey % 7 <> 0),
      s AS (SELECT g, i, i - row_number() OVER (PARTITION BY g ORDER BY i) AS run FROM c),
      r AS (SELECT g, min(i) AS a, max(i) AS b FROM s GROUP BY g, run),
      p AS (
        SELECT g, a, a AS x, a AS y, 0 AS part, 0 AS o FROM r
        UNION ALL SELECT g, a, i, i + 2, 1, 2 * i FROM r, range(0, 5) t(i) WHERE i BETWEEN a AND b
        UNION ALL SELECT g, a, i + 1, i + 2, 1, 2 * i + 1 FROM r, range(0, 5) t(i) WHERE i BETWEEN a AND b - 1
        UNION ALL SELECT g, a, b + 2, b + 2, 2, 0 FROM r
        UNION ALL SELECT g, a, i + 2, i, 3, -2 * i FROM r, range(0, 5) t(i) WHERE i BETWEEN a AND b
        UNION ALL SELECT g, a, i + 1, i, 3, 1 - 2 * i FROM r, range(0, 5) t(i) WHERE i BETWEEN a + 1 AND b
        UNION ALL SELECT g, a, a, a, 4, 0 FROM r),
      ring AS (SELECT g, a, '((' || string_agg((10 * g + x)::DECIMAL(18,3)::VARCHAR || ' ' || y::DECIMAL(18,3)::VARCHAR, ', ' ORDER BY part, o) || '))' AS t FROM p GROUP BY g, a),
      u AS (SELECT g, CASE WHEN count(*) = 1 THEN 'POLYGON ' || min(t) ELSE 'MULTIPOLYGON (' || string_agg(t, ', ' ORDER BY a) || ')' END AS geometry FROM ring GROUP BY g)
      SELECT k.g::BIGINT::VARCHAR AS _id, geometry FROM (SELECT DISTINCT c_custkey // 5 AS g FROM customer) k LEFT JOIN u USING (g)""",
    "geounion_problems": "SELECT (c_custkey // 5)::BIGINT::VARCHAR AS _id, 'not a valid area' AS problem, count(DISTINCT 1) AS n FROM customer WHERE c_custkey % 7 = 0 GROUP BY 1",
    "lies_in": "WITH c AS (SELECT c_custkey::VARCHAR AS src_id, (c_custkey * 7 % 1000) / 10.0::DOUBLE AS x, c_acctbal / 100 AS y FROM customer) SELECT src_id, n_nationkey::VARCHAR AS dst_id FROM c JOIN nation ON CASE WHEN n_nationkey % 2 = 1 THEN x > 4 * n_nationkey + 0.5 AND x < 4 * n_nationkey + 3.5 AND y > 0 AND y < 50 ELSE y > -20 AND 2 * (y + 20) < 120 * (x - 4 * n_nationkey) AND 2 * (y + 20) < 120 * (4 * n_nationkey + 4 - x) END",
    "split_json": "SELECT event_id, (props->>'$.k')::INTEGER AS props_k FROM events",
    "merge_json": "SELECT event_id, '{\"user\":' || user_id || ',\"type\":\"' || event_type || '\"}' AS merged FROM events",
    "rename_relation": f"{_D} SELECT 'purchases' AS entity, type AS action, count(*) AS n FROM dd GROUP BY type",
    "column_occurrence": f"{_IDS}, a AS (SELECT min(eventid) FILTER (event = 'ADD') AS f, max(eventid) FILTER (event = 'ADD') AS l, min(eventid) FILTER (event IN ('ADD', 'MODIFY')) AS fp, max(eventid) FILTER (event IN ('ADD', 'MODIFY')) AS lp FROM ids) SELECT k AS key, CASE WHEN k = 'o_totalprice' THEN fp ELSE f END AS first_id, CASE WHEN k = 'o_totalprice' THEN lp ELSE l END AS last_id FROM a, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) u(k)",
    "repair_versions": "WITH b AS (SELECT min(event_id) FILTER (event_id >= 3000) AS b2, max(event_id) FILTER (event_id < 6000) + 1 AS b3, least(max(event_id) FILTER (event_id < 8000) + 1, min(event_id) FILTER (event_id >= 8000)) AS b4 FROM events) SELECT event_id AS eventid, CASE WHEN event_id >= b4 THEN '0.4' WHEN event_id >= b3 THEN '0.3' WHEN event_id >= b2 THEN '0.2' ELSE '0.1' END AS version FROM events, b",
    "backfill_ids": f"{_IDS} SELECT eventid, tid AS source_id, CASE WHEN tid::BIGINT % 3 <> 0 THEN tid ELSE (SELECT any_value(c.tid) FROM c WHERE c.tid = ids.tid AND c.source = 'src_a') END AS tid FROM ids",
    "backfill_tid_of_states": "SELECT l_orderkey::VARCHAR AS _id, l_orderkey || '.' || max(l_linenumber) AS _tid FROM lineitem GROUP BY l_orderkey",
    "change_columns": "SELECT c_custkey::INTEGER AS key, try_cast(c_name AS INTEGER) AS c_name, c_acctbal::DECIMAL(12,1)::VARCHAR AS balance, '{\"value\":\"' || c_mktsegment || '\"}' AS c_mktsegment FROM customer",
    "change_columns_failed": "SELECT 'c_custkey' AS \"column\", 0::BIGINT AS failed UNION ALL SELECT 'c_name', count(*) FROM customer UNION ALL SELECT 'c_acctbal', 0 UNION ALL SELECT 'c_mktsegment', 0",
    "purge": f"{_D} SELECT 'shop' AS catalogue, 'orders' AS entity, count(*) AS n FROM dd",
    "purge_files": f"{_D} SELECT 'shop' AS catalogue, 'orders' AS entity, count(*) AS n FROM dd",
    "rename_files": f"{_D} SELECT 'purchases' AS entity, type AS action, count(*) AS n FROM dd GROUP BY type",
    "tail_of_files": "SELECT event_id AS eventid, user_id::VARCHAR AS tid, CASE event_id % 6 WHEN 0 THEN 'ADD' WHEN 4 THEN 'DELETE' WHEN 5 THEN 'CONFIRM' ELSE 'MODIFY' END AS action FROM events WHERE event_id > 499",
}
