"""Facts and properties of relations, periods, geometry, enrichment and evolution."""

import datetime as dt
import random
import subprocess
import sys
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import spatial
from tidelog.functions.ranges import in_ranges, number_in_order, running_sum
from tidelog.functions.temporal import validity_match, with_periods
from tidelog.operators import evolve
from tidelog.operators.enrich import autoid
from tidelog.operators.quality import ambiguous, checked_applications, current_entity
from tidelog.operators.relate import change_ratio, conflicts, empty_relation, match, relate, relation_events, relation_rows, update, update_all
from tidelog.operators.views import find_views
from tidelog.plans import relations as plan
from tidelog.sources.shared import written
from tidelog.specs import AutoIdSpec, RelationSpec

SF = "/root/testdata/sf0.001"


def row(**kw):
    base = dict.fromkeys(["id", "src_id", "src_deleted", "dst_id", "dst_seqnr", "_expiration_date", "valid_from", "valid_to", "rel_id", "rel_dst_id", "rel_dst_seqnr", "rel__expiration_date", "rel_valid_from", "rel_valid_to", "rel__last_event", "rel__date_deleted"])
    return base | kw


def test_relation_event_decisions(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [
        row(id="new", src_id="1", dst_id="d"), row(id="deleted", src_id="1", dst_id="d", rel_id="deleted", rel_dst_id="d", rel__date_deleted=t),
        row(id="gone", src_id="1", src_deleted=t, dst_id="d", rel_id="gone", rel_dst_id="d"), row(rel_id="obsolete", rel_dst_id="d"),
        row(id="changed", src_id="1", dst_id="d", rel_id="changed", rel_dst_id="e"), row(id="same", src_id="1", dst_id="d", rel_id="same", rel_dst_id="d"),
    ]
    schema = "id string, src_id string, src_deleted timestamp, dst_id string, dst_seqnr int, _expiration_date timestamp, valid_from timestamp, valid_to timestamp, rel_id string, rel_dst_id string, rel_dst_seqnr int, rel__expiration_date timestamp, rel_valid_from timestamp, rel_valid_to timestamp, rel__last_event long, rel__date_deleted timestamp"
    out = {r["tid"]: r["event"] for r in relation_events(spark.createDataFrame(rows, schema)).collect()}
    assert out == {"new": "ADD", "deleted": "ADD", "gone": "DELETE", "obsolete": "DELETE", "changed": "MODIFY"}


@pytest.mark.parametrize(("total", "changed", "full"), [((100, 100), (50, 0), False), ((100, 100), (100, 0), True), ((100, 100), (50, 50), True), ((0, 100), (0, 0), True), ((100, 0), (0, 0), True)])
def test_full_run_threshold(spark, total, changed, full):
    side = lambda n, c: spark.range(n).select((F.col("id") < c).cast("long").alias("_last_event"))
    assert change_ratio(side(total[0], changed[0]), side(total[1], changed[1]), 0, 0).first()["full"] is full


def test_incremental_equals_full_without_conflicts(spark):
    src, dst = plan.customers(spark, SF), plan.nations(spark, SF)
    rel = relation_rows(match(src.where("_last_event <= 80"), dst.where("_last_event <= 10"), plan.SPECS), plan.SPECS).withColumns({"_last_event": F.lit(1).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")})
    after = {}
    for mode in ("full", "incremental"):
        out = relate(src, dst, rel, plan.SPECS, mode, 80, 10).where("id IS NOT NULL")
        kept = rel.select("id", "dst_id").join(out.select("id"), "id", "left_anti")
        after[mode] = sorted(map(tuple, out.select("id", "dst_id").union(kept).collect()))
    assert after["full"] == after["incremental"]


def test_update_chooses_its_mode_and_refuses_unknown_applications(spark):
    src, dst, at = plan.customers(spark, SF), plan.nations(spark, SF), F.lit("2024-01-01").cast("timestamp")
    with pytest.raises(ValueError, match="no relation spec for B"):
        update(src, dst, empty_relation(src, dst, plan.SPECS), plan.SPECS[:1], 0, at)
    rel, modes, events = empty_relation(src, dst, plan.SPECS), [], []
    for known, start in ((0.9, 0), (1.0, 1000), (1.0, 2000)):
        rel, new, mode = update(src.where(F.col("_last_event") <= known * 150), dst, rel, plan.SPECS, start, at)
        rel = written(rel, "test-relation")
        modes.append(mode), events.append(new.count())
    assert modes == ["full", "incremental", "incremental"] and events[0] > events[1] > 0 and events[2] == 0
    gone = src.where("_last_event <= 20").withColumns({"_date_deleted": at, "_last_event": F.col("_last_event") + 1000})
    rel, new, mode = update(gone.unionByName(src.where("_last_event > 20")), dst, rel, plan.SPECS, 3000, at)
    assert mode == "incremental" and {r["event"] for r in new.collect()} == {"DELETE"}
    ended = rel.where("_date_deleted IS NOT NULL AND _last_event > 3000").count()
    assert ended == new.count() > 5


def test_relation_by_location_in_rounds(spark):
    src, dst, at = plan.places(spark, SF), plan.areas(spark, SF), F.lit("2024-01-01").cast("timestamp")
    half = src.where("_last_event <= 100")
    first = written(update(half, dst, empty_relation(src, dst, plan.INSIDE), plan.INSIDE, 0, at)[0], "test-relation")
    second, _, mode = update(src, dst, first, plan.INSIDE, 1000, at)
    want = relation_rows(match(src, dst, plan.INSIDE), plan.INSIDE)
    pairs = lambda df: sorted((r["src_id"], r["dst_id"]) for r in df.collect())
    assert mode == "incremental" and pairs(second) == pairs(want)
    unmatched = match(src, dst, plan.INSIDE, keep_unmatched=True)
    assert unmatched.count() == src.count() and unmatched.where("dst_id IS NULL AND src_id = '50'").count() == 1


def test_large_areas_cover_few_cells(spark):
    box = lambda a, b: f"POLYGON (({a} {a}, {b} {a}, {b} {b}, {a} {b}, {a} {a}))"
    dst = spark.createDataFrame([("s", box(0, 0.5)), ("m", box(-3, 90)), ("l", box(-1e6, 1e6)), ("bad", "POLYGON ((0 0, 1 1))")], "_id string, g string")
    areas = spatial.area_edges(dst, F.col("g"))
    grid = spatial.gridded(areas, 1.0)
    assert grid.columns == ["_area", "_level", "_cx", "_cy"]  # edges stay with their area
    cells = {r["_id"]: r["count"] for r in grid.join(areas, "_area").groupBy("_id").count().collect()}
    assert set(cells) == {"s", "m", "l"} and max(cells.values()) <= 36
    src = spark.createDataFrame([("p", "POINT (0.25 0.25)"), ("q", "POINT (80 80)"), ("r", "POINT (-999999 5)"), ("z", "POINT (3e6 0)")], "_id string, g string")
    found = {tuple(r) for r in spatial.lies_in(src, dst, "g", "g", 1.0).collect()}
    assert found == {("p", "s"), ("p", "m"), ("p", "l"), ("q", "m"), ("q", "l"), ("r", "l")}


def test_keys_that_begin_alike_are_spread(spark):
    keys = spark.range(5000).select(F.concat(F.lit("urn:object:catalogue:"), F.lpad((F.col("id") * 7919 % 5000).cast("string"), 6, "0")).alias("k"))
    sizes = [r["count"] for r in in_ranges(keys, "k", 64).groupBy("_part").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 3 * 5000 / 64
    rank = {r["k"]: r["_rn"] for r in number_in_order(keys, "k").collect()}
    assert [rank[k] for k in sorted(rank)] == list(range(1, 5001))
    assert running_sum(keys.where("false"), "k", F.lit(1), "n").count() == 0


def test_numbering_is_the_first_thing_in_a_session(tmp_path):
    """A string key as the first frame of a fresh session; many ranges cost no more than few."""
    code = """
import time
from pyspark.sql import SparkSession, functions as F
from tidelog.functions.ranges import number_in_order
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
keys = spark.createDataFrame([(c,) for c in "dbca"], "k string")
assert sorted(map(tuple, number_in_order(keys, "k").collect())) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def test_views_are_found():
    names = {"a_b": ("shop", "orders", "customer"), "a_c": ("shop", "orders", "part"), "d": ("web", "pages", "host")}
    assert find_views(names, relation="d") == ["mv_d"] and find_views(names, "shop:orders", "part") == ["mv_a_c"] and len(find_views(names, "shop:orders")) == 2
    for bad in ({"relation": "x"}, {"attribute": "part"}, {"collection": "shop:none"}):
        with pytest.raises(ValueError, match="."):
            find_views(names, **bad)


times = st.one_of(st.none(), st.integers(0, 6))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), times, st.integers(0, 6), times), min_size=1, max_size=40))
def test_validity_against_plain_python(spark, periods):
    day = lambda x: None if x is None else dt.datetime(2020, 1, 1 + x)
    df = spark.createDataFrame([((day(a), day(b)), (day(c), day(d)), i) for i, (a, b, c, d) in enumerate(periods)], "src struct<valid_from timestamp, valid_to timestamp>, dst struct<valid_from timestamp, valid_to timestamp>, i int")
    got = {r["i"]: r["m"] for r in df.select("i", validity_match("src", "dst", True, True).alias("m")).collect()}
    for i, (sb, se, db, de) in enumerate(periods):
        ends = de is None or (se is not None and de >= se)
        regular = sb != se and (se is None or db < se) and ends
        collapsed = sb == se and db <= se and ends
        assert got[i] == (regular or collapsed)


@pytest.mark.parametrize("days", [1, 3, 1000])
def test_states_met_by_stretches_fit_as_all_with_all(spark, days):
    rng = random.Random(days)
    day = lambda x: None if x is None else dt.datetime(2020, 1, 1) + dt.timedelta(hours=x)
    times = lambda: rng.choice([None, *range(0, 240, 7)])
    src = spark.createDataFrame([(str(i), day(times()), day(times()), (rng.choice("ab"), None)) for i in range(120)], "_id string, valid_from timestamp, valid_to timestamp, ref struct<value:string,begin:timestamp>")
    dst = spark.createDataFrame([(rng.choice("ab"), i, day(times()), day(times())) for i in range(120)], "_id string, seqnr int, valid_from timestamp, valid_to timestamp")
    src = src.withColumns({"seqnr": F.lit(1), "_source": F.lit("s"), "_application": F.lit("A"), "_last_event": F.lit(1).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")})
    dst = dst.withColumns({"_source": F.lit("s"), "_last_event": F.lit(1).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")})
    spec = [RelationSpec("A", "_id")]
    rows = lambda **more: sorted(map(str, match(src, dst, spec, src_states=True, dst_states=True, keep_unmatched=True, **more).select("src_id", "value", "dst_id", "dst_seqnr").collect()))
    assert rows() == rows(period_days=days) == rows(period_days=days, spread=True)


def test_many_states_of_one_key_meet_few(spark):
    """10,000 states of one key on both sides: each source meets a stretch of states."""
    begin = lambda i: F.timestamp_micros(i * F.lit(86_400_000_000))
    states = spark.range(10_000).select(F.lit("k").alias("key"), F.col("id").cast("int").alias("seqnr"), begin(F.col("id")).alias("valid_from"), begin(F.col("id") + 1).alias("valid_to"))
    s, d = with_periods(states, states, 20)
    assert d.count() < 2 * 10_000 and s.alias("src").join(d.alias("dst"), ["key", "_period"]).count() < 30 * 10_000


def test_unknown_applications_end_a_run(spark):
    src = spark.createDataFrame([("1", "X", ("v", None))], "_id string, _application string, ref struct<value:string,begin:timestamp>").withColumns({"_source": F.lit("s"), "_last_event": F.lit(1).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")})
    dst = spark.createDataFrame([("v",)], "_id string").withColumns({"_source": F.lit("s"), "_last_event": F.lit(1).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")})
    spec = [RelationSpec("A", "_id")]
    rel = empty_relation(src, dst, spec)
    with pytest.raises(Exception, match="no relation spec for X"):
        relate(src, dst, rel, spec).collect()
    with pytest.raises(ValueError, match="no relation spec for X"):
        update_all({"r": {"src": src, "dst": dst, "rel": rel, "specs": spec}}, 0, F.current_timestamp())


def test_ids_of_other_sources_are_not_used(spark):
    rows = spark.createDataFrame([("a", None), ("b", None)], "k string, code string")
    stored = spark.createDataFrame([("a", "C005", "s"), ("b", "C009", "t")], "k string, code string, _source string")
    spec = AutoIdSpec("code", "k", "CXXX")
    assert {r.k: r.code for r in autoid(rows, stored, spec, "s")[0].collect()} == {"a": "C005", "b": "C006"}
    assert {r.k: r.code for r in autoid(rows, stored, spec)[0].collect()} == {"a": "C005", "b": "C009"}


def test_geometry(spark):
    wkt = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    points = {(3.0, 3.0): True, (1.5, 1.5): False, (0.0, 2.0): False, (4.0, 4.0): False, (5.0, 1.0): False, (0.5, 1.0): True, (1.0, 1.5): False}
    df = spark.createDataFrame([(wkt, x, y) for x, y in points], "w string, x double, y double")
    got = {(r["x"], r["y"]): r["c"] for r in df.select("x", "y", spatial.contains(spatial.edges(spatial.rings(F.col("w"))), F.col("x"), F.col("y")).alias("c")).collect()}
    assert got == points
    valid = {wkt: True, "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))": False, "POLYGON ((0 0, 1 0, 0 0))": False, "POLYGON ((0 0, 1 0, 1 1, 0 1))": False, "POINT (1 2)": False, "": False}
    got = {r["w"]: r["v"] for r in spark.createDataFrame([(w,) for w in valid], "w string").select("w", spatial.is_valid(spatial.rings(F.col("w"))).alias("v")).collect()}
    assert got == valid
    src = spark.createDataFrame([("u", "POLYGON ((0 0, 9 0, 9 9, 8 9, 8 1, 1 1, 1 9, 0 9, 0 0))"), ("p", "POINT (3 3)"), ("n", None)], "_id string, g string")
    dst = spark.createDataFrame([("a", wkt), ("b", "POLYGON ((7 0, 20 0, 20 20, 7 20, 7 0))"), ("bad", "POLYGON ((0 0, 9 9, 9 0, 0 9, 0 0))")], "_id string, g string")
    found = {tuple(r) for r in spatial.lies_in(src, dst, "g", "g", 5.0).collect()}
    assert ("p", "a") in found and all(d != "bad" for _, d in found) and len([s for s, _ in found if s == "u"]) <= 1


def test_overlaps_are_reported(spark):
    square = "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"
    df = spark.createDataFrame([("x", square), ("x", square), ("x", square), ("y", square)], "k string, g string")
    assert [r["k"] for r in spatial.overlaps(df, "k", "g").collect()] == ["x"]


def ids(spark, rows, stored, template):
    out, problems = autoid(spark.createDataFrame(rows, "k string, v string"), spark.createDataFrame(stored, "k string, v string"), AutoIdSpec("v", "k", template))
    return {r["k"]: r["v"] for r in out.collect()}, [r["problem"] for r in problems.collect()]


def test_issued_ids(spark):
    rows = [(str(i), None) for i in range(10)]
    got, problems = ids(spark, rows, [], "0123X")
    assert sorted(got.values()) == [f"0123{i}" for i in range(10)] and not problems
    assert ids(spark, [*rows, ("x", None)], [], "0123X")[1] == ["beyond the template"]
    got, problems = ids(spark, [("0", None), ("1", None), ("2", None)], [("0", "01232"), ("9", "01234")], "0123X")
    assert got == {"0": "01232", "1": "01235", "2": "01236"} and not problems
    assert ids(spark, [("a", None)], [("b", "ABC"), ("c", "1"), ("d", "0024")], "00XX")[0] == {"a": "0025"}
    assert ids(spark, [("a", "0001"), ("b", "0001")], [("c", "1"), ("c", "2")], "00XX")[1] == ["given to several keys", "several stored values"]
    keys = spark.createDataFrame([(f"key{i % 7}{i}",) for i in range(300)], "k string")
    rank = {r["k"]: r["_rn"] for r in number_in_order(keys, "k").collect()}
    assert [rank[k] for k in sorted(rank)] == list(range(1, 301))


def test_policies_and_uniqueness(spark):
    spec = lambda app, none: RelationSpec(app, "x", none_allowed=none)
    assert checked_applications([spec("a", False), spec("b", False)]) is None
    assert checked_applications([spec("a", True), spec("b", True)]) == []
    assert checked_applications([spec("a", True), spec("b", False), spec("c", False)]) == ["b", "c"]
    state = spark.createDataFrame([("a", None), ("a", None)], "_tid string, _date_deleted timestamp")
    with pytest.raises(Exception, match="several rows"):
        current_entity(state, "a").collect()


def test_json_and_versions(spark):
    df = spark.createDataFrame([(1, 5, "open"), (2, None, None)], "i int, status_code int, status_text string")
    mapping = {"status_code": "code", "status_text": "text"}
    back = evolve.split_json(evolve.merge_json(df, "status", mapping), "status", mapping, {"status_code": "int", "status_text": "string"})
    assert sorted(map(tuple, back.select(df.columns).collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError, match="unknown kind"):
        evolve.version_boundaries(spark.createDataFrame([], "key string, first_id long, last_id long"), [evolve.Migration("1", "2", (("twist", "a"),))])
    log = spark.createDataFrame([(i, "ADD", "0.1", '{"entity":{"a":"1"' + (',"b":"2"' if i >= 23 else "") + "}}") for i in range(20, 31)], "eventid long, action string, version string, contents string")
    out = {r["eventid"]: r["version"] for r in evolve.repair_versions(log, [evolve.Migration("0.1", "0.2", (("add", "b"),)), evolve.Migration("0.2", "0.3", (("add", "never"),))]).collect()}
    assert out == {i: "0.2" if i >= 23 else "0.1" for i in range(20, 31)}


def test_conflicts_count_destinations_not_states(spark):
    assert plan._conflicts(spark, SF).count() > 0
    states = match(plan.order_states(spark, SF), plan.nation_states(spark, SF), plan.PART, src_states=True, dst_states=True)
    assert states.where("row_number > 1").count() == 0


def test_no_nested_loops(spark):
    for name, query in plan.QUERIES.items():
        if name in ("marks", "change_ratio"):
            continue
        text = query(spark, SF)._jdf.queryExecution().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def crowd(spark):
    """2000 references and 2000 destinations of one value, one with several states, and some of others."""
    blank = {"_source": F.lit("s"), "_application": F.lit("A"), "_last_event": F.lit(1).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")}
    value = F.when(F.col("id") < 2000, "v").when(F.col("id") < 2010, F.lit("w")).when(F.col("id") < 2020, F.col("id").cast("string"))
    rows = spark.range(2030).select(F.col("id").cast("string").alias("_id"), value.alias("name"))
    src = rows.select("_id", F.col("name").alias("same"), F.struct(F.col("name").alias("value"), F.lit(None).cast("timestamp").alias("begin")).alias("ref")).withColumns(blank)
    dst = rows.where("_id <> '2015'").withColumns(blank | {"seqnr": F.lit(1)})
    return src, dst.unionByName(dst.where("_id = '2005'").withColumn("seqnr", F.lit(2)))


@pytest.mark.parametrize("unmatched", [False, True])
def test_numbered_by_value_as_by_reference(spark, unmatched):
    src, dst = crowd(spark)
    src = src.where("_id > 1990")
    rows = lambda spec, **kw: sorted(map(str, match(src, dst, [spec], keep_unmatched=unmatched, **kw).select("*", "_dst.*").drop("_src", "_dst").collect()))
    by_value, by_reference = RelationSpec("A", "name"), RelationSpec("A", "name", source_attribute="same")
    assert rows(by_value) == rows(by_reference) == rows(by_value, spread=True)
    assert rows(by_value, last=True) == rows(by_reference, last=True) and len(rows(by_value, last=True)) == (39 if unmatched else 28)


def test_ambiguous_references_are_not_expanded(spark):
    """4,000,000 pairs: counting them takes no row each, and listing them neither groups nor sorts them."""
    src, dst = crowd(spark)
    spec = [RelationSpec("A", "name")]
    started = time.time()
    found = {r.src_id: r.destinations for r in ambiguous(conflicts(match(src, dst, spec, last=True), spec), "name").collect()}
    assert time.time() - started < 30 and len(found) == 2010 and found["7"] == 2000 and found["2005"] == 10
    plan_ = conflicts(match(src, dst, spec), spec)._jdf.queryExecution().optimizedPlan().toString()
    assert not {"Aggregate", "Window", "Sort"} & set(plan_.split("Join ")[0].replace("+-", " ").split())
    assert conflicts(match(src, dst, spec), spec).count() == 2000 * 1999 + 10 * 9


@pytest.mark.parametrize("unmatched", [False, True])
@pytest.mark.parametrize("block", [(1024, 16_384), (3, 100), (1, 1999)])
def test_crowded_values_meet_in_blocks(spark, unmatched, block, monkeypatch):
    """References without a value, of values with one block and with many on either side: the same rows as without blocks."""
    monkeypatch.setattr("tidelog.operators.relate.BLOCK", block)
    src, dst = crowd(spark)
    src = src.where("_id > 1990")
    spec = [RelationSpec("A", "name")]
    rows = lambda **kw: sorted(map(str, match(src, dst, spec, keep_unmatched=unmatched, **kw).select("*", "_dst.*").drop("_src", "_dst").collect()))
    assert rows(crowded=True) == rows() and len(rows()) > 10_000


def test_pairs_of_crowded_values_are_made_by_many_tasks(spark):
    """Brands' parts and suppliers are few bytes and very many pairs: they don't all come from one task."""
    for query in (plan.q_conflicts, plan.q_match_multiple_allowed):
        tasks = query(spark, SF).groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) > 1
