"""WARC archives, mixing, sharding and the pipeline."""

import collections
import io
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from tidelog.llm import mixing, sharding, warc

PAGES = "page_id long, url string, html string, payload string, first string, key string"


def pages(spark):
    big, other = "x" * 1500, "\u00e9" * 600
    rows = [(1, "http://a/", big), (5, "http://b/", big), (3, None, big), (2, "u", "small"), (4, "u", "small"), (6, "u\nv w", None), (7, "u", ""), (8, "u", other), (9, "u", other), (None, "u", other), (10, "u", "z" * 300_000), (11, "same", big + "!"), (11, "same", big + "!")]
    return spark.createDataFrame([(*r, "p", "f", "k") for r in rows], PAGES)


def test_warc_round_trip(spark):
    rows = warc.round_trip(pages(spark)).collect()
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows)
    want = [(1, 1500, "revisit", 5), (5, 1500, "response", None), (3, 1500, "revisit", 5), (2, 5, "response", None), (4, 5, "response", None), (6, 0, "response", None), (7, 0, "response", None), (8, 1200, "revisit", 9), (9, 1200, "response", None), (None, 1200, "revisit", 9), (10, 300_000, "response", None), (11, 1501, "response", None), (11, 1501, "response", None)]
    assert got == collections.Counter(want)
    assert warc.round_trip(pages(spark).where("false")).count() == 0


def test_small_pages_and_hot_payloads_are_dealt_evenly(spark):
    small = spark.range(4000).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "'short' AS html")
    hot = spark.range(4000, 6000).selectExpr("id AS page_id", "'u' AS url", "repeat('y', 1200) AS html")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = warc.plan_records(small.unionByName(hot)).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("first").alias("revisits")).collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == 4 and sum(r["n"] for r in rows) == 6000 and sum(r["revisits"] for r in rows) == 1999
    assert max(r["n"] for r in rows) < 2 * 6000 / 4 and max(r["revisits"] for r in rows) < 2 * 1999 / 4


@pytest.mark.parametrize("dictionary", ["trained", "raw", "compressed", "none"])
def test_archives_with_dictionaries(spark, tmp_path, dictionary):
    docs = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    trained = warc.train_dictionary(docs)
    assert trained[:4] == b"\x37\xa4\x30\xec"
    content = {"trained": trained, "raw": b"<html><head><title>" * 40, "none": b"", "compressed": trained}[dictionary]
    path = f"file://{tmp_path}/{dictionary}"
    manifest = warc.write_archives(warc.plan_records(docs), path, content, archive_bytes=20_000)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == docs.count()
    if dictionary == "compressed":
        for r in manifest.collect():
            name = r["path"].removeprefix("file://")
            data = open(name, "rb").read()
            small = zstandard.compress(content)
            open(name, "wb").write(warc.DICTIONARY_MAGIC + len(small).to_bytes(4, "little") + small + data[8 + len(content) :])
    back = warc.read_warc(spark, path)
    want = {r["page_id"]: r["html"] for r in docs.collect()}
    rows = back.where("record_type = 'response'").collect()
    assert back.count() == len(want) and all(bytes(r["payload"]).decode() == want[r["page_id"]] for r in rows)


def test_one_frame_per_record_and_validation():
    record = warc.make_record(7, "http://x/", b"abc", None, "2024-01-01T00:00:00Z")
    frames = zstandard.compress(record) + zstandard.compress(record)
    assert list(warc.read_frames(io.BytesIO(frames), 11)) == [record, record]
    assert warc.parse_record(record)["payload_digest"] == "a9993e364706816aba3e25717850c26c9cd0d89d"
    broken = {
        "version": record.replace(b"WARC/1.1", b"WARC/9"), "length": re.sub(rb"(?m)^Content-Length: (\d+)\r\n\r\nHTTP", b"Content-Length: 9\r\n\r\nHTTP", record), "cut": record[:-3], "payload": record.replace(b"abc", b"abd"),
        "header": record.replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""), "twice": record.replace(b"WARC-Type: response", b"WARC-Type: response\r\nwarc-type: response"), "type": record.replace(b"WARC-Type: response", b"WARC-Type: metadata"),
    }
    for raw in broken.values():
        with pytest.raises(ValueError):
            warc.parse_record(raw)
    for bad in (frames[:-4], warc.DICTIONARY_MAGIC + (99).to_bytes(4, "little") + b"short"):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.read_frames(io.BytesIO(bad)))


def test_invalid_archives_become_rows_where_asked(spark, tmp_path):
    good = zstandard.compress(warc.make_record(1, None, b"x", None, "2024-01-01T00:00:00Z"))
    (tmp_path / "a.warc.zst").write_bytes(good + zstandard.compress(b"nonsense") + good + b"junk")
    rows = warc.read_warc(spark, f"file://{tmp_path}", strict=False).collect()
    assert [r["error"] is None for r in rows] == [True, False, True, False]
    with pytest.raises(Exception, match="no WARC"):
        warc.read_warc(spark, f"file://{tmp_path}").collect()


def test_mix_of_odd_documents(odd_docs, no_docs):
    rows = mixing.mix(odd_docs, block_words=1000).collect()
    assert len(rows) == odd_docs.count() and mixing.mix(no_docs).count() == 0
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 1.5 * total) <= 4
    assert {r["doc_id"]: r["size"] for r in rows if r["doc_id"]} | {6: 2} == {1: 12, 2: 12, 3: 0, 4: 0, 5: 0, 6: 2, 7: 2, 8: 60_000, 9: 59_990, 10: 4, 11: 3}
    again = mixing.mix(odd_docs, block_words=1000).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert set(mixing.mixed_documents(odd_docs).columns) == set(odd_docs.columns)


def test_mixed_sequence_is_even_and_in_order(spark):
    source = F.element_at(F.array(*map(F.lit, "abcc")), (F.col("id") % 4 + 1).cast("int"))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), source.alias("source"), F.expr("repeat('w ', 5 + cast(id % 7 AS int))").alias("text"))
    sequence = mixing.mixed_sequence(docs, block_words=64)
    files = sequence.groupBy(F.input_file_name().alias("f")).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).orderBy("f").collect()
    assert all(x["hi"] <= y["lo"] for x, y in zip(files, files[1:], strict=False))
    rows = sorted(sequence.collect(), key=lambda r: r["slot"])
    taken, passes = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        taken[r["doc_id"]] += r["words"]
        if r["first"] == 0:
            passes[r["doc_id"]].append(r["slot"])
    want = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, block_words=64).collect()}
    assert taken == {d: n for d, n in want.items() if n}
    totals, seen = collections.Counter(), collections.Counter()
    for r in rows:
        totals[r["source"]] += r["words"]
    for r in rows:
        seen[r["source"]] += r["words"]
        assert all(abs(seen[s] - totals[s] * sum(seen.values()) / sum(totals.values())) < 10 * 64 for s in totals)
    used, slots = collections.Counter(), []
    for r in mixing.mixed_documents(docs, block_words=64).collect():
        slots.append(passes[r["doc_id"]][used[r["doc_id"]]])
        used[r["doc_id"]] += 1
    assert slots == sorted(slots) and used == {d: k for d, n in want.items() if (k := int(n / (5 + d % 7) + 0.5))}


def test_the_points_decide_where_documents_stand(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    slots = lambda: {r["doc_id"]: (r["taken"], r["first_slot"]) for r in mixing.mix(docs).collect()}
    ours = slots()
    assert ours == slots()
    monkeypatch.setattr(mixing, "_reversed_bits", lambda x, bits: x)
    plain = slots()
    assert ours != plain and {d: t for d, (t, _) in ours.items()} == {d: t for d, (t, _) in plain.items()}
    assert all((s is None) == (t == 0) for t, s in ours.values())


def test_rows_without_ids_have_copies_of_their_own(spark):
    docs = spark.range(900).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("source"))
    docs = docs.withColumns({c: F.lit(c) for c in ("doc", "row", "slot", "start", "_copies", "_share", "_at")})
    out = mixing.mixed_documents(docs, block_words=16)
    copies = collections.Counter(r["text"] for r in out.collect())
    taken = mixing.mix(docs, block_words=16).agg(F.sum("taken")).first()[0]
    assert out.columns == docs.columns and set(copies.values()) <= {1, 2} and abs(2 * sum(copies.values()) - taken) < 0.1 * taken


def test_targets_are_shared_again(spark):
    sizes = spark.createDataFrame([(1, "a", 10), (2, "b", 1000), (3, "c", 5), (4, None, 400), (5, "z", 0)], "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    share, cap, weight = {}, {"a": 20, "b": 2000, "c": 10, None: 800, "z": 0}, {"a": 5, "b": 2, "c": 1, "z": 5, None: 2}
    open_, left = set(cap), 1.5 * 1415
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap[s]}
        if not over:
            break
        left -= sum(cap[s] for s in over)
        open_ -= over
    want = {s: share.get(s, float(cap[s])) for s in cap}
    assert got == pytest.approx(want)


def test_schedule_is_even(spark):
    plan = spark.createDataFrame([(0, 500), (1, 200), (2, 100), (3, 1)], "idx int, slots long")
    rows = mixing.schedule(plan, chunk=64).collect()
    assert collections.Counter(r["idx"] for r in rows) == {0: 500, 1: 200, 2: 100, 3: 1}
    assert len({r["slot"] for r in rows}) == 801
    for idx, n in ((0, 500), (1, 200), (2, 100)):
        own = sorted((r["rank"], r["slot"]) for r in rows if r["idx"] == idx)
        assert [k for k, _ in own] == list(range(n)) and [s for _, s in own] == sorted(s for _, s in own)
        assert all(abs(s / 1024 * n * 1024 / 801 - k) < 25 for k, s in own)  # never far from its share


def test_table_is_filled_in_turns():
    names = [f"s{i}" for i in range(10)]
    table = sharding.fill_table(names, 1009)
    counts = collections.Counter(table.tolist())
    assert set(counts) == set(range(10)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill_table(names[:9], 1009)
    assert sum(a == b for a, b in zip(table, fewer, strict=True)) > 0.75 * 1009
    assert (sharding.fill_table(["one"], 7) == 0).all()
    for bad in ([], ["x"] * 20):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 13)
    with pytest.raises(ValueError, match="prime"):
        sharding.fill_table(names, 1000)


def test_placement_against_the_table(spark, odd_docs, no_docs, tmp_path):
    table = sharding.fill_table([f"shard-{k:05d}" for k in range(64)])
    rows = sharding.place(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(table[r["slot"]] == r["shard"] for r in rows)
    keyed = spark.range(5000).select(F.pmod(F.xxhash64(F.col("id")), F.lit(65537)).alias("s"), "id").collect()
    placed = {r["doc_id"]: r["shard"] for r in sharding.place(spark.range(5000).withColumnRenamed("id", "doc_id")).collect()}
    assert all(placed[r["id"]] == table[r["s"]] for r in keyed)
    assert len({r["shard"] for r in rows if r["doc_id"] == 6}) == 1 and len({r["shard"] for r in rows if r["doc_id"] is None}) == 2
    assert sharding.place(no_docs).count() == 0
    with pytest.raises(ValueError, match="other names"):
        sharding.place(odd_docs, slot="h")
    sharding.write_shards(odd_docs, f"file://{tmp_path}/out", 8, 2)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == odd_docs.count()


def test_whole_documents_are_sharded(spark, odd_docs, tmp_path):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sharding.op10(spark, str(tmp_path)).collect()
    want = sharding.place(docs).select("doc_id", "slot", "shard").collect()
    assert sorted(map(str, rows)) == sorted(map(str, want))
    assert len({r["slot"] for r in rows if r["doc_id"] is None}) == 2  # by all columns, not in one pile
    path = f"{tmp_path}/shards"
    assert sorted(map(str, sharding.sharded(docs, path).select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    docs.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert sharding.op10(spark, f"{tmp_path}/none").count() == 0


def test_writers_follow_the_bytes(spark, tmp_path):
    """A shard's files grow with its bytes, not with a fixed number."""
    docs = spark.range(0, 40_000, 1, 16).select(F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("text"))
    files = {}
    for size in ("64k", "64m"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        try:
            sharding.write_shards(docs, str(tmp_path / size), 2)
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        files[size] = len(list((tmp_path / size).rglob("part-*.parquet")))
        assert spark.read.parquet(str(tmp_path / size)).count() == 40_000
    assert files["64m"] <= 4 < 8 < files["64k"]
