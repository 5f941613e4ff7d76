"""Facts and properties of comparison, log and fold."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.keys import populate
from tidelog.operators.apply import applied_range, apply_all, apply_confirms, confirmed_tids, empty_state, first_state, fold, judged, marks
from tidelog.operators.diff import diff, initial_load, pack_confirms, split_confirms, to_events
from tidelog.plans.upload import ACCOUNTS
from tidelog.sources import eventlog
from tidelog.specs import CollectionSpec
from tidelog.streaming.apply_stream import apply_batch, latest, touched_state, write_part

COLL = CollectionSpec("c", "things", "0.1", "id", {"id": "string", "a": "int", "b": "string"})


def snapshot(spark, rows):
    return populate(spark.createDataFrame(rows, "id string, a int, b string"), COLL, "app", "src")


def log_of(spark, events, start):
    return eventlog.log_rows(eventlog.assign_ids(events, start), "c", "things", "src", "app", "2024-01-01")


def upload(spark, state, rows):
    compared = diff(snapshot(spark, rows), state, "src")
    events = to_events(compared, COLL)
    top = state.agg(F.coalesce(F.max("_last_event"), F.lit(0))).first()[0]
    return events, fold(state, log_of(spark, events, top), COLL)


def live(state):
    return sorted((r["id"], r["a"], r["b"]) for r in state.where("_date_deleted IS NULL").collect())


def test_applying_the_difference_gives_the_snapshot(spark):
    rng, state = random.Random(5), empty_state(COLL, spark)
    for _ in range(3):
        rows = [(str(i), rng.choice([None, 1, 2]), rng.choice([None, "", "x|y", "\\N", "~"])) for i in rng.sample(range(12), 8)]
        events, folded = upload(spark, state, rows)
        assert folded.violations.count() == folded.orphans.count() == 0
        state = spark.createDataFrame(folded.state.collect(), folded.state.schema)
        assert live(state) == sorted(rows, key=lambda r: r[0])
    again = to_events(diff(snapshot(spark, rows), state, "src"), COLL)
    assert {r["event"] for r in again.collect()} == {"CONFIRM"}


def test_hash_tells_null_and_separators_apart(spark):
    rows = snapshot(spark, [("1", 1, None), ("1", 1, ""), ("1", 1, "\\N"), ("1", 1, "|"), ("1", None, "1")])
    assert rows.select("_hash").distinct().count() == 5


def test_modes_and_source_filter(spark):
    state = snapshot(spark, [("1", 1, "a"), ("2", 1, "a")]).withColumns({"_last_event": F.lit(7).cast("long"), "_date_deleted": F.lit(None).cast("timestamp")})
    new = snapshot(spark, [("1", 2, "a")])
    kinds = lambda mode, src="src": sorted(r["type"] for r in diff(new, state, src, mode).collect())
    assert kinds("full") == kinds("delete") == ["DELETE", "MODIFY"]
    assert kinds("update") == ["MODIFY"]
    assert kinds("full", "other") == []
    with pytest.raises(ValueError, match="mode"):
        diff(new, state, "src", "sometimes")
    assert {r["type"] for r in initial_load(new).collect()} == {"ADD"}


def test_packing_confirms(spark):
    confirms = lambda n: spark.createDataFrame([("CONFIRM", str(i), i) for i in range(n)], "event string, tid string, last_event long")
    packed = lambda n, most: sorted((r["event"], 1 if r["confirms"] is None else len(r["confirms"])) for r in pack_confirms(confirms(n), most, 1).collect())
    assert packed(1, 2) == [("CONFIRM", 1)]
    assert packed(2, 2) == [("BULKCONFIRM", 2)]
    assert packed(3, 2) == [("BULKCONFIRM", 2), ("CONFIRM", 1)]
    assert confirmed_tids(pack_confirms(confirms(25), 10, 4)).count() == 25
    with pytest.raises(Exception, match="unexpected event"):
        confirmed_tids(spark.createDataFrame([("ADD", "1", None)], "event string, tid string, confirms array<struct<tid string, last_event long>>")).collect()


def test_ids_are_dense_and_above_the_start(spark):
    events = spark.createDataFrame([("ADD", str(i)) for i in range(500)], "event string, tid string")
    assert sorted(r["eventid"] for r in eventlog.assign_ids(events, 40).collect()) == list(range(41, 541))


def test_status_and_validity(spark):
    mark = lambda s, e: eventlog.model_status(spark.createDataFrame([(x,) for x in s], "_last_event long"), spark.createDataFrame([(x,) for x in e], "eventid long")).first()["status"]
    assert mark([], []) == "up to date"
    assert mark([], [10]) == "out of date"
    assert mark([10], []) == mark([10], [5]) == "corrupted"
    state = spark.createDataFrame([("t", 100)], "_tid string, _last_event long")
    events = spark.createDataFrame([("MODIFY", "t", 100), ("MODIFY", "t", 50), ("MODIFY", "u", 1), ("ADD", "v", None)], "event string, tid string, last_event long")
    assert [r["valid"] for r in eventlog.validate_events(events, state).orderBy("event", "tid", "last_event").collect()] == [True, False, True, False]


def test_update_statistics(spark):
    members = [("a", 1), ("b", 1), ("c", 1)]
    rows = [("ADD", True, None), ("MODIFY", True, None), ("DELETE", True, None), ("CONFIRM", True, None), ("BULKCONFIRM", True, members), ("ADD", False, None)]
    stats = {r["action"]: (r["stored"], r["skipped"], r["share"]) for r in eventlog.update_stats(spark.createDataFrame(rows, "event string, valid boolean, confirms array<struct<tid string, last_event long>>")).collect()}
    assert stats["CONFIRM"] == (4, 0, round(4 / 7, 6))
    assert stats["ADD"][:2] == (1, 1)


def account_events(spark, actions):
    body = {"ADD": '{"entity":{"value":"1.00","k":"x"}}', "MODIFY": '{"modifications":[{"key":"k","old_value":"x","new_value":null}]}', "DELETE": "{}", "CONFIRM": "{}"}
    return spark.createDataFrame([(i + 1, a, t, body[a]) for i, (a, t) in enumerate(actions)], "eventid long, action string, tid string, contents string").withColumns({"timestamp": F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(eventid AS INT))"), "version": F.lit("0.1"), "application": F.lit("site"), "source": F.lit("site")})


def test_bulk_confirms_leave_the_gate_open(spark, tmp_path):
    """A bulk confirm at the log's head marks no row: the mark beside the state says that it is applied."""
    events = account_events(spark, [("ADD", "1"), ("CONFIRM", "1")]).withColumns({"catalogue": F.lit("web"), "entity": F.lit("accounts")})
    bulk = events.where("eventid = 1").withColumns({"eventid": F.lit(3).cast("long"), "action": F.lit("BULKCONFIRM"), "tid": F.lit(None).cast("string"), "contents": F.lit('{"confirms":[{"tid":"1","last_event":2},{"tid":"9","last_event":1}]}')})
    log = events.unionByName(bulk)
    results, summary = apply_all(log, {"accounts": (ACCOUNTS, empty_state(ACCOUNTS, spark))})
    assert summary.first().asDict() == {"before": 0, "after": 3, "add": 1, "modify": 0, "delete": 0, "confirm": 3}
    state = results["accounts"].state
    assert eventlog.model_status(state, log).first()["status"] == "out of date"
    eventlog.write_marks(marks(spark, results), f"{tmp_path}/marks")
    mark = {r["collection"]: r["applied"] for r in eventlog.read_marks(spark, f"{tmp_path}/marks").collect()}
    assert mark == {"accounts": 3} and eventlog.model_status(state, log, 3).first()["status"] == "up to date"
    again, summary = apply_all(log, {"accounts": (ACCOUNTS, state)}, mark)
    assert again == {"accounts": None} and summary.first()["confirm"] == 0
    with pytest.raises(ValueError, match="ahead"):
        apply_all(log, {"accounts": (ACCOUNTS, state)}, {"accounts": 4})
    plain = spark.createDataFrame([(0, 1, "CONFIRM"), (0, 2, "ADD")], "before long, eventid long, action string")
    assert applied_range(plain).first()["confirm"] == 1


def test_a_tail_opens_few_files_and_a_purge_touches_its_own(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    row = lambda n, entity: spark.range(n * 100, n * 100 + 100, 1, 1).select(F.col("id").alias("eventid"), *[F.lit(v).cast(t).alias(c) for c, t, v in (("timestamp", "timestamp", "2024-01-01"), ("version", "string", "1"), ("action", "string", "ADD"), ("source_id", "string", None), ("contents", "string", "{}"), ("application", "string", "a"), ("tid", "string", "t"), ("catalogue", "string", "c"), ("entity", "string", entity), ("source", "string", "s"))])
    for n in range(20):
        eventlog.append(row(n, "even" if n % 2 == 0 else "odd"), path)
    assert eventlog.index_files(spark, path).agg(F.sum("events"), F.count("*")).first()[:] == (2000, 20)
    end = eventlog.tail_of_files(spark, path, 1899)
    assert len(end.inputFiles()) == 1 and end.count() == 100
    eventlog.append(row(20, "even"), path)
    end = eventlog.tail_of_files(spark, path, 1950, entity="even")
    assert len(end.inputFiles()) == 2 and end.count() == 100
    assert eventlog.tail_of_files(spark, path, 10_000).count() == 0
    stamp = lambda entity: {p: p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet") if f"entity={entity}/" in str(p)}
    odd = stamp("odd")
    eventlog.rename_files(spark, path, "c", "even", "paired")
    assert stamp("odd") == odd and not stamp("even") and eventlog.read_log(spark, path).where("entity = 'paired'").count() == 1100
    with pytest.raises(ValueError, match="events of its own"):
        eventlog.rename_files(spark, path, "c", "odd", "paired")
    assert eventlog.purge_files(spark, path, "c", "paired") and not eventlog.purge_files(spark, path, "c", "none")
    assert stamp("odd") == odd and eventlog.read_log(spark, path).count() == 1000
    assert eventlog.index_files(spark, path).count() == 10 and eventlog.tail_of_files(spark, path, -1).count() == 1000


def test_fold_sequences(spark):
    actions = [("ADD", "1"), ("DELETE", "1"), ("ADD", "1"), ("MODIFY", "1"), ("MODIFY", "2"), ("ADD", "3"), ("ADD", "3"), ("DELETE", "3"), ("MODIFY", "3")]
    out = fold(empty_state(ACCOUNTS, spark), account_events(spark, actions), ACCOUNTS)
    rows = {r["_tid"]: r for r in out.state.collect()}
    assert rows["1"]["k"] is None and rows["1"]["_date_deleted"] is None and rows["1"]["_last_event"] == 4 and rows["1"]["_date_created"].day == 4
    assert rows["3"]["_date_deleted"].day == 9 and set(rows) == {"1", "3"}
    assert [(r["eventid"], r["standing"]) for r in out.violations.orderBy("eventid").collect()] == [(7, "ADD"), (9, "DELETE")]
    assert [r["eventid"] for r in out.orphans.collect()] == [5]


def test_events_without_an_object(spark):
    """Events without a tid are orphans; bulk confirms are left to their own step, which stamps after the fold."""
    at = "2024-03-01"
    events = account_events(spark, [("ADD", "1"), ("CONFIRM", "1"), ("ADD", "2"), ("MODIFY", None)]).withColumns({"catalogue": F.lit("web"), "entity": F.lit("accounts")})
    bulk = spark.createDataFrame([(5, "BULKCONFIRM", None, '{"confirms":[{"tid":"1","last_event":2},{"tid":"2","last_event":3}]}')], "eventid long, action string, tid string, contents string")
    bulk = bulk.withColumns({"timestamp": F.lit(at).cast("timestamp")} | {c: F.lit(v) for c, v in {"version": "0.1", "application": "site", "source": "site", "catalogue": "web", "entity": "accounts"}.items()})
    log = events.unionByName(bulk)
    assert [r["eventid"] for r in fold(empty_state(ACCOUNTS, spark), log, ACCOUNTS).orphans.collect()] == [4]
    done, _ = apply_all(log, {"accounts": (ACCOUNTS, empty_state(ACCOUNTS, spark))})
    confirmed = {r["_tid"]: r["_date_confirmed"] for r in done["accounts"].state.collect()}
    assert confirmed["1"].isoformat()[:10] == at and confirmed["2"] is None


def test_a_first_load_needs_no_fold(spark):
    events = to_events(initial_load(snapshot(spark, [("1", 1, "a"), ("2", None, None)])).withColumn("current", F.col("new")), COLL)
    log = log_of(spark, events, 0)
    state = first_state(log, COLL)
    assert state.schema.simpleString() == empty_state(COLL, spark).schema.simpleString()
    assert sorted(map(str, state.collect())) == sorted(map(str, fold(empty_state(COLL, spark), log, COLL).state.select(state.columns).collect()))
    with pytest.raises(Exception, match="ADDs only"):
        first_state(log.withColumn("action", F.lit("DELETE")), COLL).collect()


def test_storing_under_the_gate(spark, tmp_path):
    path, keys = f"file://{tmp_path}/log", ("c", "things", "src", "app", "2024-01-01")
    state, empty = empty_state(COLL, spark), spark.createDataFrame([], eventlog.SCHEMA)
    events = to_events(initial_load(snapshot(spark, [("1", 1, "a"), ("2", 2, "b")])).withColumn("current", F.col("new")), COLL)
    assert [(r["action"], r["stored"]) for r in eventlog.store(empty, events, state, path, *keys).collect()] == [("ADD", 2)]
    log = eventlog.read_log(spark, path)
    with pytest.raises(ValueError, match="out of date"):
        eventlog.store(log, events, state, path, *keys)
    now = spark.createDataFrame(first_state(log, COLL).collect(), state.schema)
    again = eventlog.store(log, events, now, path, *keys).collect()
    assert [(r["stored"], r["skipped"]) for r in again] == [(0, 2)] and eventlog.read_log(spark, path).count() == 2


def plain_fold(actions):
    """Standing, violations and orphans one event after another."""
    standing, k, last, bad, lost = {}, {}, {}, [], []
    for i, (action, tid) in enumerate(actions, 1):
        now = standing.get(tid)
        if now is None and action != "ADD":
            lost.append(i)
        elif (now == "live") if action == "ADD" else (now == "deleted"):
            bad.append(i)
        else:
            standing[tid] = {"ADD": "live", "DELETE": "deleted"}.get(action, now)
            k[tid] = {"ADD": "x", "MODIFY": None}.get(action, k.get(tid))
            last[tid] = i
    return {t: (standing[t], k[t], last[t]) for t in standing}, bad, lost


@pytest.mark.parametrize("pieces", [1, 3, 16])
def test_a_busy_object_is_folded_in_stretches(spark, pieces):
    rng = random.Random(8)
    actions = [(rng.choice(["MODIFY", "ADD", "DELETE", "CONFIRM"]), "hot" if rng.random() < 0.9 else str(rng.randrange(9))) for _ in range(600)]
    actions = [("MODIFY", "hot"), ("DELETE", "hot")] * 40 + actions  # orphans over several stretches
    events = account_events(spark, actions)
    out = fold(empty_state(ACCOUNTS, spark), events, ACCOUNTS, pieces)
    want, bad, lost = plain_fold(actions)
    assert {r["_tid"]: ("deleted" if r["_date_deleted"] else "live", r["k"], r["_last_event"]) for r in out.state.collect()} == want
    assert sorted(r["eventid"] for r in out.violations.collect()) == bad and sorted(r["eventid"] for r in out.orphans.collect()) == lost


def test_a_busy_object_spreads(spark):
    """Nine tenths of the log are one object's: no task of its windows gets more than twice the mean."""
    log = spark.range(1, 40_001).select(F.col("id").alias("eventid"), F.when(F.col("id") == 1, "ADD").otherwise("CONFIRM").alias("action"), F.when(F.col("id") % 10 != 0, "hot").otherwise((F.col("id") % 977).cast("string")).alias("tid"), F.lit("{}").alias("contents"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = judged(empty_state(ACCOUNTS, spark), log, pieces=64).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2 * 40_000 / len(parts)


def test_fold_does_not_depend_on_batches(spark):
    rng = random.Random(3)
    actions = [(rng.choice(["ADD", "MODIFY", "DELETE", "CONFIRM"]), str(rng.randrange(6))) for _ in range(120)]
    events = account_events(spark, actions)
    at_once = fold(empty_state(ACCOUNTS, spark), events, ACCOUNTS).state
    first = fold(empty_state(ACCOUNTS, spark), events.where("eventid <= 50"), ACCOUNTS).state
    first = spark.createDataFrame(first.collect(), first.schema)
    in_two = fold(first, events, ACCOUNTS).state  # the first 50 are passed over
    assert sorted(map(str, at_once.collect())) == sorted(map(str, in_two.collect()))


def test_confirms_leave_unconfirmed_rows(spark):
    state = spark.createDataFrame([("a", 1, "2020-01-01"), ("b", 2, None), ("c", 3, "2020-01-01")], "_tid string, _last_event long, d string").withColumn("_date_confirmed", F.to_timestamp("d"))
    confirms = spark.createDataFrame([("CONFIRM", "a", None), ("BULKCONFIRM", None, [("b", 2)])], "event string, tid string, confirms array<struct<tid string, last_event long>>")
    out = {r["_tid"]: r["_date_confirmed"] for r in apply_confirms(state, confirms, F.lit("2024-01-01").cast("timestamp")).collect()}
    assert out["a"].year == 2024 and out["b"] is None and out["c"].year == 2020


def test_log_on_disk_is_pruned(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    eventlog.append(log_of(spark, to_events(initial_load(snapshot(spark, [("1", 1, "a"), ("2", 2, "b")])).withColumn("current", F.col("new")), COLL), 0), path)
    log = eventlog.read_log(spark, path)
    assert eventlog.tail(log, 1, source="src").count() == 1
    assert not eventlog.has_any(log, entity="nothing") and eventlog.has_any(log, entity="things")
    assert "PartitionFilters: [isnotnull(source" in eventlog.tail(log, 0, source="src")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_snapshots_and_event_files(spark, tmp_path):
    from tidelog.sources import state

    path = f"file://{tmp_path}"
    spark.createDataFrame([("1", 1, "a"), ("2", None, None)], "id string, a int, b string").write.json(f"{path}/json")
    snap = state.read_snapshot(spark, f"{path}/json", COLL, "json")
    assert snap.schema.simpleString() == "struct<id:string,a:int,b:string>" and snap.count() == 2
    events = spark.createDataFrame([("ADD", "1"), ("CONFIRM", "2"), ("BULKCONFIRM", None)], "event string, tid string")
    state.write_events(events, f"{path}/events")
    changes, confirms = state.read_events(spark, f"{path}/events")
    assert (changes.count(), confirms.count()) == (1, 2)


def test_stream_parts_equal_one_fold(spark, tmp_path):
    """Deltas and merged bases give the state of one fold; a batch seen again and a part not named as complete change nothing."""
    rng, state, logs = random.Random(11), empty_state(COLL, spark), []
    for _ in range(5):
        rows = [(str(i), rng.choice([None, 1, 2]), rng.choice([None, "x"])) for i in rng.sample(range(9), 6)]
        top = state.agg(F.coalesce(F.max("_last_event"), F.lit(0))).first()[0]
        logs.append(log_of(spark, upload(spark, state, rows)[0], top))
        logs[-1].write.parquet(f"{tmp_path}/log{len(logs)}")
        logs[-1] = spark.read.schema(logs[-1].schema).parquet(f"{tmp_path}/log{len(logs)}")
        state = fold(state, logs[-1], COLL).state
        state.write.parquet(f"{tmp_path}/state{len(logs)}")
        state = spark.read.schema(state.schema).parquet(f"{tmp_path}/state{len(logs)}")
    path = f"{tmp_path}/stream"
    for epoch, log in enumerate(logs):
        apply_batch(log, path, COLL, epoch, deltas_per_base=2)
        apply_batch(log, path, COLL, epoch, deltas_per_base=2)
    fold(state, logs[0], COLL).state.limit(1).write.parquet(f"{path}/delta=9")
    found, version = latest(spark, path, COLL)
    rows = lambda df: sorted(str([r[c] for c in sorted(df.columns)]) for r in df.collect())
    assert version == 4 and rows(found) == rows(state)
    # What came before the newest base but one is gone; a part not named as complete is passed over.
    assert sorted(p.name for p in (tmp_path / "stream").iterdir()) == ["base=1", "base=3", "delta=2", "delta=3", "delta=4", "delta=9", "versions"]


def test_a_batch_opens_the_buckets_it_touches(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("a"), F.lit("x").alias("b"))
    log = log_of(spark, to_events(initial_load(populate(rows, COLL, "app", "src")).withColumn("current", F.col("new")), COLL), 0)
    path = f"{tmp_path}/s"
    write_part(first_state(log, COLL), path, "base", -1, buckets=128)
    named = [str(i) for i in range(0, 20_000, 2000)]
    change = log.where(F.col("tid").isin(named)).withColumns({"eventid": F.col("eventid") + 100_000, "action": F.lit("CONFIRM")})
    buckets = {r[0] for r in change.select(F.pmod(F.xxhash64("tid"), F.lit(128))).collect()}
    folders = list((tmp_path / "s" / "base=-1").glob("_bucket=*"))
    assert len(buckets) <= 10 and len(folders) == 128
    for folder in folders:
        if int(folder.name.partition("=")[2]) not in buckets:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not to be opened")
    for epoch in range(2):
        assert touched_state(change, path, COLL).count() == 10
        apply_batch(change.withColumn("eventid", F.col("eventid") + epoch), path, COLL, epoch)
    assert latest(spark, path, COLL, sorted(buckets))[0].where("_last_event > 100000").count() == 10
    with pytest.raises(Exception, match="."):
        latest(spark, path, COLL)[0].collect()


def test_stream_stamps_bulk_confirms(spark, tmp_path):
    rows = [(str(i), i, "x") for i in range(4)]
    _, folded = upload(spark, empty_state(COLL, spark), rows)
    base = folded.state.withColumn("_date_confirmed", F.lit("2020-01-01").cast("timestamp"))
    write_part(base, f"{tmp_path}/s", "base", -1)
    packed = pack_confirms(split_confirms(to_events(diff(snapshot(spark, rows[:3]), base, "src", "update"), COLL))[1], most=50, buckets=1)
    more = {"eventid": F.lit(100).cast("long"), "version": F.lit("0.1"), "hash": F.lit(None).cast("string"), "entity": F.lit(None).cast("map<string,string>"), "modifications": F.lit(None).cast("array<struct<key:string,old_value:string,new_value:string>>")}
    apply_batch(eventlog.log_rows(packed.withColumns(more), "c", "things", "src", "app", "2024-01-01"), f"{tmp_path}/s", COLL, 0)
    found, _ = latest(spark, f"{tmp_path}/s", COLL)
    assert sorted((r["_tid"], r["_date_confirmed"].year) for r in found.collect()) == [("0", 2024), ("1", 2024), ("2", 2024), ("3", 2020)]


def test_a_bucket_may_be_one_pack(spark):
    """More confirms to a bucket than a pack usually has: the store cycle's SQL knows buckets only."""
    rows = spark.range(25_000).select(F.lit("CONFIRM").alias("event"), F.col("id").cast("string").alias("tid"), F.col("id").alias("last_event"))
    assert sorted(len(r["confirms"]) for r in pack_confirms(rows, None, 2).collect()) == sorted([r["count"] for r in rows.groupBy(F.pmod(F.conv(F.substring(F.md5("tid"), 1, 8), 16, 10).cast("long"), F.lit(2))).count().collect()])
    assert pack_confirms(rows, buckets=2).count() == 4

def test_a_large_pack_is_one_event_in_many_rows(spark, tmp_path):
    """As in the store cycle: a pack has all confirms of its bucket, one id, and no row with more than ``part`` members."""
    made = lambda n: spark.range(n).select(F.lit("CONFIRM").alias("event"), F.col("id").cast("string").alias("tid"), F.col("id").alias("last_event"), F.lit("0.1").alias("version"), F.lit(None).cast("string").alias("hash"), F.lit(None).cast("map<string,string>").alias("entity"), F.lit(None).cast("array<struct<key:string,old_value:string,new_value:string>>").alias("modifications"))
    packed = pack_confirms(made(10_001), None, 4, part=100).withColumns({c: F.lit(None).cast(t) for c, t in (("hash", "string"), ("entity", "map<string,string>"), ("modifications", "array<struct<key:string,old_value:string,new_value:string>>"))} | {"version": F.lit("0.1")})
    whole = pack_confirms(made(10_001), None, 4)
    members = lambda df: sorted((r["pack"], m["tid"], m["last_event"]) for r in df.collect() for m in r["confirms"])
    assert members(packed) == members(whole) and whole.count() == 4
    sizes = [len(r["confirms"]) for r in packed.collect()]
    assert max(sizes) == 100 and len(sizes) < 10_001 / 100 + 5
    assert [(r["event"], r["tid"], r["pack"]) for r in pack_confirms(made(1), None, 1, part=100).collect()] == [("CONFIRM", "0", None)]
    assert sorted((r["event"], len(r["confirms"])) for r in pack_confirms(made(101), None, 1, part=100).collect()) == [("BULKCONFIRM", 1), ("BULKCONFIRM", 100)]
    assert sorted((r["pack"], len(r["confirms"])) for r in pack_confirms(made(25), 10, 1, part=4).collect()) == [(0, 2), (0, 4), (0, 4), (1, 2), (1, 4), (1, 4), (2, 1), (2, 4)]
    others = made(3).withColumns({"event": F.lit("ADD"), "tid": F.concat(F.lit("n"), "tid"), "last_event": F.lit(None).cast("long"), "confirms": F.lit(None).cast("array<struct<tid:string,last_event:long>>"), "pack": F.lit(None).cast("long")})
    log = log_of(spark, packed.unionByName(others), 40)
    assert {r["eventid"]: r["n"] for r in log.groupBy("eventid").agg(F.count_distinct("action").alias("n")).collect()} == dict.fromkeys(range(41, 48), 1)
    assert {r["eventid"] for r in log.where("action = 'BULKCONFIRM'").collect()} == {44, 45, 46, 47}
    _, summary = apply_all(log, {"things": (COLL, empty_state(COLL, spark))})
    assert (summary.first()["after"], summary.first()["add"], summary.first()["confirm"]) == (47, 3, 10_001)
    valid = eventlog.validate_events(packed.unionByName(made(3).withColumns({"confirms": F.lit(None).cast("array<struct<tid:string,last_event:long>>"), "pack": F.lit(None).cast("long")})), spark.range(20_000).select(F.col("id").cast("string").alias("_tid"), (F.col("id") * 2).alias("_last_event")))
    assert sorted((r["tid"], r["valid"]) for r in valid.where("tid IS NOT NULL").collect()) == [("0", True), ("1", False), ("2", False)] and valid.where("tid IS NULL AND valid").count() == len(sizes)
