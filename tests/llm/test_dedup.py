"""Exact and near duplicates, components, containment."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidelog.llm import decontam, exact_dedup, near_dedup
from tidelog.llm.common import hot_join
from tidelog.llm.graph import components
from tidelog.llm.words import shingles_of, word_blocks


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_word_hashes_follow_the_words():
    texts = ["The the THE  x", None, "", "\tend\n", "a b c d e", "\u00c9cole \u00e9cole", "a" * 3000]
    hashes = []
    for _, _, w in word_blocks(pa.array(texts)):
        hashes += [w.hashes[a:b].tolist() for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)]
    assert [len(h) for h in hashes] == [len(words(t)) for t in texts]
    assert len(set(hashes[0][:3])) == 1 and hashes[5][0] != hashes[5][1]
    every = {x for t in texts for x in words(t)}
    assert len({x for h in hashes for x in h}) == len(every)


def test_shingles_against_plain_python():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(200)]
    for k in (1, 4, 5):
        ours, seen = [], {}
        for _, _, w in word_blocks(pa.array(texts), 64):
            s, at = shingles_of(w, k)
            ours += [set(s[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
        for t, mine in zip(texts, ours, strict=True):
            theirs = shingle_set(t, k)
            assert len(mine) == len(theirs)
            for other, its in seen.items():
                assert len(mine & its) == len(theirs & shingle_set(other, k))
            if len(seen) < 20:
                seen[t] = mine


def test_directory_doubles_where_it_must():
    depth, slots, sizes = exact_dedup.build_directory({0: 10, 1: 10, 200: 5}, 8, 10)
    assert depth == 8 and len(slots) == 256 and sum(sizes) == 25 and max(sizes) <= 10
    assert slots == sorted(slots) and slots[0] != slots[1]
    assert exact_dedup.build_directory({}, 8, 10)[0] == 0
    assert exact_dedup.build_directory({3: 99}, 2, 10)[2] == [0, 0, 99]


def test_colliding_hashes_are_told_apart_by_bytes():
    rows = [(1, 7, "x", 2, 5, 50), (2, 7, "y", 1, 4, 40), (3, 7, "x", 1, 9, 60), (4, 8, "x", 1, 1, 10)]
    names = ["gid", "h", "norm", "n", "best_cp", "best_id"]
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
    out = {r["gid"]: r for b in exact_dedup._own(table.to_batches()) for r in b.to_pylist()}
    assert {g: (r["keep_gid"], r["keep_id"], r["group_size"]) for g, r in out.items()} == {1: (3, 60, 3), 2: (2, 40, 1), 3: (3, 60, 3), 4: (4, 10, 1)}


def test_exact_groups_of_odd_documents(odd_docs, no_docs):
    rows = exact_dedup.exact_groups(odd_docs, capacity=2, flush_bytes=200).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == odd_docs.count()
    assert by[3]["keep_id"] == by[4]["keep_id"] == by[5]["keep_id"] == 5 and by[5]["group_size"] == 3
    assert sum(r["kept"] for r in rows if r["doc_id"] == 6) == 1 and by[6]["group_size"] == 3 and by[7]["group_size"] == 1
    assert by[1]["keep_id"] == 1 and by[8]["kept"] and by[9]["kept"]
    assert exact_dedup.exact_groups(no_docs).count() == 0
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in rows)


def test_components_against_plain_python(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(500, i) for i in range(501, 560)] + [(9, 9), (None, 3)]
    root = {x: x for p in pairs for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if x in got} and all(x in got for x in root if find(x) != x)
    few = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(16), hold=8).collect()}
    assert few == got  # whatever a task works out at once
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_star(spark):
    """A third of all links meet in one node, the largest of its component at that, and lead on to others."""
    pairs = [(9_000, i) for i in range(600)] + [(10_000 + i, 10_001 + i) for i in range(0, 2400, 2)] + [(20_000, i) for i in range(0, 600, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(8), hold=1).collect()}
    assert len(got) == 602 + 2400 and all(c == (0 if x < 10_000 or x == 20_000 else x - x % 2) for x, c in got.items())


def near_brute(texts, k, percent):
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in texts}


def mutated(rng, count, words_each, share):
    base = [f"w{rng.randrange(400)}" for _ in range(words_each)]
    out = []
    for _ in range(count):
        t = list(base)
        for _ in range(int(share * words_each)):
            t[rng.randrange(words_each)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_near_groups_against_brute_force(spark):
    rng = random.Random(4)
    texts = [t for share in (0.01, 0.02, 0.03, 0.05) for _ in range(4) for t in mutated(rng, 12, 150, share)]
    texts += mutated(rng, 90, 120, 0.015) + ["a b c d", "a b c d", "a b c", "A B c", "", None]
    rows = dict(enumerate(texts))
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want = near_brute(rows, 5, 80)
    for options in ({}, {"cap": 4, "block_shingles": 900, "block_sets": 10}):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(df, **options).collect()}
        assert got == want


def test_near_groups_of_odd_documents(odd_docs, no_docs):
    rows = near_dedup.near_groups(odd_docs, k=4).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == odd_docs.count()
    assert all(by[i]["n_shingles"] == 0 and by[i]["component_id"] == i for i in (3, 4, 5))
    assert by[2]["component_id"] == 1 and by[7]["component_id"] == 6 and by[9]["component_id"] == 8 and not by[9]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert near_dedup.near_groups(no_docs).count() == 0
    kept = near_dedup.drop_near_duplicates(odd_docs, k=4)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {1, 3, 4, 5, 6, 8, 10, 11, None}
    assert kept.count() == 10  # the repeated row once, both rows without id


def test_repeated_ids_link_their_classes(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(3, text("a")), (5, text("a")), (5, text("b")), (9, text("b")), (9, text("c")), (7, text("d")), (7, ""), (7, None)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).where("n_shingles > 0").collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True), (9, 3, False), (9, 3, False)]
    many = [(1, text(f"x{i}")) for i in range(300)] + [(2, text("x7")), (0, text("x299"))]
    assert {r.component_id for r in near_dedup.near_groups(spark.createDataFrame(many, "doc_id long, text string")).collect()} == {0}


def test_small_large_and_mixed_clusters_agree_with_brute_force(spark):
    """One crowded cluster that must be compared block against block, with members on both sides of the bound."""
    rng = random.Random(14)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(160):
        t = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            t[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(t[: rng.choice([60, 60, 52, 45])]))
    rows = dict(enumerate(texts + texts[:10]))
    want = near_brute(rows, 5, 80)
    assert 3 < len({c for _, c in want.values()}) < 150
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(df, block_sets=8).collect()} == want


def test_the_plan_of_block_pairs_stays_small(spark):
    """Each join with sums of its own rows reads written rows: the driver holds and explains no plan that repeats them over and over."""
    large = spark.range(400).select(F.col("id").alias("node"), (F.col("id") % 40 + 20).alias("n"), (F.col("id") % 2).alias("label"), (F.col("id") % 10).alias("component"))
    pairs = near_dedup._block_pairs(large, 400, 1 << 20, 8)
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") <= 2
    assert {r.node for r in pairs.select("node").distinct().collect()} == set(range(400))


def test_recall_of_links_just_over_the_bound_in_a_crowded_region(spark):
    """Pairs of 80 to 85 % among texts that nearly all share most shingles, at a cap that makes every region crowded."""
    rng = random.Random(15)
    base = [f"w{i}" for i in range(200)]
    rows = {}
    for i in range(300):
        t = list(base)
        for _ in range(rng.choice([2, 2, 3])):
            t[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows[i] = " ".join(t)
    sets = {i: shingle_set(t, 5) for i, t in rows.items()}
    pairs = [(a, b) for a in rows for b in range(a) if 0.8 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 0.85]
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df, cap=2, block_sets=16).collect()}
    assert len(pairs) > 20 and all(got[a] == got[b] for a, b in pairs)


def test_links_do_not_pass_over_very_many_small_sets():
    sets = [np.unique(np.array([1, 2, 3 + i // 2], np.uint64)) for i in range(6000)]  # all share two items, pairs are equal
    links = near_dedup.similar_links(list(range(6000)), list(range(6000)), [0] * 6000, sets, 80)
    assert sorted(links) == [(i, i + 1) for i in range(0, 6000, 2)]
    known = near_dedup.similar_links(list(range(6000)), [i // 2 for i in range(6000)], [0] * 6000, sets, 80)
    assert known == []


def forest(rows, cap, hold, size):
    class Context:
        @staticmethod
        def partitionId():  # noqa: N802
            return 0

    near_dedup.TaskContext, before = type("T", (), {"get": staticmethod(lambda: Context)}), near_dedup.TaskContext
    try:
        out = [r for b in near_dedup._neighbours(cap, hold)(rows.to_batches(max_chunksize=size)) for r in b.to_pylist() if r["part"] is None]
        return sorted((r["a"], r["b"]) for r in out)
    finally:
        near_dedup.TaskContext = before


def test_neighbours_across_batches_and_regions():
    sig = np.sort(np.array([1 << 48, 1 << 48, (1 << 48) + 1, 5 << 48], np.int64))
    table = pa.table({"tree": np.zeros(4, np.int64), "k1": sig, "k2": np.zeros(4, np.int64), "node": np.arange(4)})
    for size in (1, 2, 4):
        assert forest(table, 64, 1 << 20, size) == [(0, 1), (1, 2)]


def test_links_are_the_same_whatever_is_held():
    rng = np.random.default_rng(3)
    n = 4000
    k1 = rng.integers(0, 3, n) << 48 | rng.integers(0, 3, n) << 32 | rng.choice([1, 1, 1, 2], n) << 16 | rng.integers(0, 40, n)
    k2 = rng.integers(0, 2, n) << 48 | rng.integers(0, 9, n)
    order = np.lexsort((np.arange(n), k2, k1))
    table = pa.table({"tree": np.zeros(n, np.int64), "k1": k1[order], "k2": k2[order], "node": np.arange(n)})
    for cap in (4, 16):
        want = forest(table, cap, 1 << 20, 5000)
        assert 0 < len(want) < n - 1
        for hold, size in ((cap + 1, 7), (30, 50), (100, 1000), (100, 13)):
            assert forest(table, cap, hold, size) == want


def test_hot_keys_join_as_others(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id")
    right = left.where("k IS NOT NULL AND k <> 9").groupBy("k").agg(F.count("*").alias("n_left"), F.max("id").alias("top"))
    want = sorted(map(str, left.join(right, "k", "left").select("k", "id", "top").collect()))
    for most in (1, 20, 10_000):
        assert sorted(map(str, hot_join(left, right, "k", 3000, most=most).collect())) == want


def test_containment_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: f"v{rng.randrange(3000)}"
    items = {i: " ".join(word() for _ in range(n)) for i, n in enumerate([1, 4, 5, 7, 11, 13, 20, 35, 60, 130, 300])} | {90: None, 91: ""}
    docs = {}
    for i in range(60):
        w = [word() for _ in range(rng.choice([3, 50, 400, 3000]))]
        for item in rng.sample(list(range(11)), 2):
            own = items[item].split()
            part = own if rng.random() < 0.5 else own[: max(1, int(len(own) * rng.choice([0.5, 0.85, 0.95])))]
            if rng.random() < 0.4:  # in two far pieces
                half = len(part) // 2
                w = part[: half + 4] + w + part[half:]
            else:
                at = rng.randrange(len(w) + 1)
                w[at:at] = part
        docs[i] = " ".join(w)
    docs |= {100: items[0], 101: items[1], 102: None, 103: "", 104: items[5].upper()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if (s := shingle_set(x, 5)) and len(s & shingle_set(t, 5)) >= 0.8 * len(s)}
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for blocks in ({}, {"block_items": 3}):
        got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, b, **blocks).collect()}
        assert got == want
        left = decontam.decontaminate(d, b, **blocks)
        assert {r["doc_id"] for r in left.collect()} == set(docs) - {x for x, _ in want}


def test_a_phrase_of_all_items_and_documents_makes_no_pairs():
    """2,000 documents and 8,192 items share a phrase; a task's memory and the pairs found don't grow with the product."""
    phrase = "once upon a midnight dreary "
    items = [phrase + " ".join(f"i{i}x{j}" for j in range(2 + i % 12)) for i in range(8192)]
    index = decontam.ItemIndex.build(list(range(8192)), items, 5, 0.8)
    docs = [phrase + " ".join(f"d{i}x{j}" for j in range(30)) for i in range(2000)] + ["filler " * 9 + items[77] + " filler" * 9, items[8191]]
    tracemalloc.start()
    found = list(index.matches(pa.array(docs), 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(d, i) for d, i, _ in found] == [(2000, 77), (2001, 8191)] and peak < 400e6


def test_containment_of_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two", "x"), (None, "brown fox jumps over the lazy", "x"), (3, None, "x"), (3, "no id here at all", "x")], "item_id long, text string, doc_id string")
    rows = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(odd_docs, items).collect()}
    assert rows == {(6, 1), (7, 1), (None, 1), (1, None), (2, None), (None, 3)}
    assert decontam.contaminated(no_docs, items).count() == decontam.contaminated(odd_docs, items.where("false")).count() == 0
    left = decontam.decontaminate(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 7
