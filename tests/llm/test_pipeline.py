"""Each stage of the corpus pipeline against a plain computation on its own input."""

import collections

import pytest
from pyspark.sql import functions as F
from test_dedup import near_brute, shingle_set

import corpus_pipeline
from tidelog.llm import language_id, mixing, sharding

SF = "/root/testdata/sf0.001"
CLASHING = ["_lang_pred", "_Lang_Score", "_letters", "_kept", "_copies", "_copy", "_share", "_slot", "slot", "SHARD", "doc", "row", "start", "_key", "_hot", "_sha_own"]


def rows_of(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark, odd_docs):
    """Input and output of each stage, for documents of the table, copies of them, odd ones, and clashing columns."""
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(plain)
    copies = docs.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 100_000).withColumn("text", F.concat("text", F.lit(" coda")))
    odd = odd_docs.select(plain).where("doc_id IS NULL OR doc_id NOT IN (8, 9)").withColumn("doc_id", F.col("doc_id") + 200_000)
    docs = docs.unionByName(copies).unionByName(docs.where("doc_id < 5")).unionByName(odd)
    docs = docs.withColumns({c: F.lit(7) for c in CLASHING})
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stage_table(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs, after
        docs = after
    return out


def test_stages_and_columns(stages):
    assert list(stages) == ["language", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(after.columns == before.columns for name, (before, after) in stages.items() if name != "sharding")
    assert all(after.count() > 100 for _, after in stages.values())


def test_language_stage(stages):
    before, after = stages["language"]
    tagger = language_id.train_tagger(before)
    bounds = language_id.score_bounds(before, tagger)
    want = collections.Counter()
    for r in language_id.label_languages(before.select("doc_id", "text", "lang"), tagger, "guess", "p").collect():
        if any(c.isalpha() for c in r["text"] or "") and r["p"] >= bounds.get(r["guess"], 0):
            want[r["doc_id"], r["text"]] += 1
    assert rows_of(after) == want
    gone = rows_of(before) - want
    assert {t for _, t in gone} >= {None, "", "1234 5678 !!"} and sum(gone.values()) < 0.1 * sum(want.values())


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    texts = {}
    for d, t in rows_of(before):
        if d is not None:
            assert texts.setdefault(d, t) == t
    brute = near_brute(texts, 5, 80)
    want = collections.Counter({(d, t): 1 for d, t in texts.items() if brute[d][1] == d})
    want.update({k: n for k, n in rows_of(before).items() if k[0] is None})
    assert rows_of(after) == want and sum(want.values()) < len(texts)


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    items = [s for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (s := shingle_set(r["text"], 5))]
    clean = lambda t: not any(len(s & own) >= 0.8 * len(s) for own in [shingle_set(t, 5)] for s in items)
    assert rows_of(after) == collections.Counter({k: n for k, n in rows_of(before).items() if clean(k[1])})


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    size = lambda t: len((t or "").split())
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(before).collect() if r["doc_id"] is not None}
    got = {k: n for k, n in rows_of(after).items() if k[0] is not None}
    want = {(d, t): n for d, t in rows_of(before) if d is not None and size(t) and (n := int(taken[d] / size(t) + 0.5))}
    assert got == want and max(got.values()) == 2


def test_sharding_stage(stages):
    before, after = stages["sharding"]
    table = sharding.fill_table([f"shard-{k:05d}" for k in range(64)])
    slot, shard = (c for c in after.columns if c not in before.columns)
    assert rows_of(before) == rows_of(after) and all(table[r[slot]] == r[shard] for r in after.collect())


def test_run_is_the_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage_table(stage(spark, docs, SF), f"test-{name}")
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


def test_an_empty_table_passes_through(spark, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage_table(stage(spark, docs, SF), f"none-{name}")
    assert docs.count() == 0 and docs.columns[:5] == no_docs.columns[:5]
