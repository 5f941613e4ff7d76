"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm.collocations import bitmap, collocations, counted_phrases, covered, locally_frequent, scored

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, support=10, longest=3, percent=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= support}
    dropped = {(lang, w[i : i + k]) for (lang, w), a in candidates.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * a >= percent * f[lang, w[i : i + k]]}
    out = {}
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, left, right, n[lang], score))
    return sorted((lang, i + 1, x[2].decode(), *x[3:]) for lang, found in out.items() for i, x in enumerate(sorted(found)[:top]))


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


ROWS = [(i, "Alpha beta gamma, alpha\tbeta  GAMMA delta; beta gamma! x x x x x\nalpha beta", "en") for i in range(9)] + [(i % 3, "été à la été à la ÉTÉ à la.", None) for i in range(6)] + [(None, "alpha beta", "en"), (4, None, "en"), (5, "", None), (6, " \t .,;\n", "de"), (7, "été à la", "und")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(1) for c in ("n", "hash", "shard", "width", "phrase", "part", "w")})


@pytest.mark.parametrize("longest, percent, top", [(3, 50, 2000), (3, 100, 2), (5, 50, 2000), (2, 50, 1), (4, 101, None)])
def test_collocations_equal_a_plain_count(docs, longest, percent, top):
    want = plain([(t, lang) for _, t, lang in ROWS], longest=longest, percent=percent, top=top)
    assert want and found(collocations(docs, longest=longest, percent=percent, top=top)) == want


@pytest.mark.parametrize("shards, bits", [(1, 27), (3, 6), (10, 20), (16, 8)])
def test_shards_and_the_size_of_the_bitmap_do_not_change_results(docs, shards, bits):
    assert found(collocations(docs, shards=shards, bits=bits)) == plain([(t, lang) for _, t, lang in ROWS])


def test_small_blocks_cut_only_between_pieces(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60")
    whole = {(r.lang, r.phrase, r.f) for r in counted_phrases(docs, locally_frequent(docs)).collect()}
    cut = {(r.lang, r.phrase, r.f) for r in counted_phrases(docs, locally_frequent(docs, block_bytes=64, hold=50), block_bytes=64).collect()}
    assert len(whole) > 100 and whole == cut


def test_every_frequent_phrase_is_frequent_in_some_shard(docs):
    frequent = locally_frequent(docs, shards=4)
    assert frequent.agg(F.min("n")).first()[0] >= 3
    all_ = counted_phrases(docs, locally_frequent(docs, support=1), bits=10)
    assert {(r.lang, r.phrase, r.f) for r in counted_phrases(docs, frequent).collect()} == {(r.lang, r.phrase, r.f) for r in all_.collect()}
    bits = bitmap(frequent, 12)
    assert len(bits) == 512 and 0 < sum(bin(b).count("1") for b in bits.tolist()) <= frequent.select("hash").distinct().count()


def test_scores_beyond_64_bits_are_exact(spark):
    big = 3_000_000_019
    rows = [("en", "a", 1, big * 7), ("en", "b", 1, big * 11), ("en", "a b", 2, big), ("en", "b a", 2, big), ("en", "a b a", 3, big - 1)]
    got = {r.phrase: (r.l, r.r, r.score) for r in scored(spark.createDataFrame(rows, "lang string, phrase string, width long, f long")).collect()}
    assert got["a b"] == (big * 7, big * 11, 10**6 * big * big // (big * 7 * big * 11))
    cuts = [(10**6 * (big - 1) ** 2 // (x * y), k, x, y) for k, x, y in ((1, big * 7, big), (2, big, big * 7))]
    assert got["a b a"] == (min(cuts)[2], min(cuts)[3], min(cuts)[0]) == (big * 7, big, cuts[0][0])
    assert {r.phrase for r in covered(spark.createDataFrame(rows, "lang string, phrase string, width long, f long")).collect()} == {"a b", "b a"}


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    assert found(collocations(odd_docs, support=2)) == plain(rows, support=2)
    assert collocations(no_docs).collect() == []
