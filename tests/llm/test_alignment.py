"""Cross-tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import random
from collections import Counter

import pytest

from tidelog.llm.alignment import TOKENIZERS, Lexicon, Tokenizers, aligned, alignment, encode_block, token_overlaps

SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    read = lambda name: open(f"{TOKENIZERS}/{name}", "rb").read()  # noqa: SIM115
    return Tokenizers(read("byte_bpe_50k.json"), read("piece_bpe_32k.model"))


def plain(rows, t):
    """The contract's columns from whole-text encodings, one token after another."""
    out, links = [], Counter()
    for doc_id, text in rows:
        a = t.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = t.b.encode(text) if text else []
        if text and not b"".join(t.a_bytes[i] for i in a) == b"".join(t.b_bytes[i] for i in b) == (" " + text).encode():
            a = b = []
        ends = []
        for ids, table in ((a, t.a_bytes), (b, t.b_bytes)):
            at, own = 0, []
            for i in ids:
                at += len(table[i])
                own.append(at)
            ends.append(own)
        pairs = [(x, y) for x, e in zip(a, ends[0], strict=True) for y, f in zip(b, ends[1], strict=True) if e == f] if len(a) < 200 else [(a[ends[0].index(e)], b[ends[1].index(e)]) for e in sorted(set(ends[0]) & set(ends[1]))]
        links.update(pairs)
        groups, la, lb = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            ia, ib = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, a[la:ia])) + "|" + ",".join(map(str, b[lb:ib])))
            la, lb = ia, ib
        out.append([doc_id, len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    best = Counter()
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    return [(d, na, nb, g, len(p), sum(links[x] == best[x[1]] for x in p), sum(links[x] for x in p), sha) for d, na, nb, g, p, sha in out]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


TEXTS = [
    "The quick brown fox.", " leading and  double   spaces ", "tabs\tand\nnew lines\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "café ÄÖÜ ß naïve", "日本語 текст ελληνικά 😀👍🏽", "a▁b", "▁", "x" * 3000, "don't we'll 'tis 123 4567",
    "\x00 \x1c \x85     nul", "é combining", " ", "\n", "a", None, "", "The quick brown fox.", "1 2  3\t 4", "　 wide", "zero​width ﻿ bom",
]


def test_columns_equal_a_plain_alignment(spark, tokenizers):
    rows = [(i % 17, t) for i, t in enumerate(TEXTS)] + [(None, "no id here")]
    assert found(alignment(spark.createDataFrame(rows, SCHEMA))) == sorted(plain(rows, tokenizers), key=str)


def test_rare_and_frequent_pairs_are_counted_alike(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(alignment(docs, most=40)) == found(alignment(docs, most=1)) == found(alignment(docs)) == sorted(plain(rows, tokenizers), key=str)


def test_documents_equal_a_plain_alignment(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 3000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) > 100 and found(alignment(docs)) == sorted(plain(rows, tokenizers), key=str)


def test_stretches_encode_as_whole_texts(tokenizers):
    """Both the cut at spaces and the encoding by ranks."""
    rng, latin = random.Random(5), [chr(i) for i in range(0x250)]
    texts = ["".join(rng.choice(latin if rng.random() < 0.3 else " abc'st.,\n\t12<|>▁") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    lexicon = Lexicon(tokenizers)
    a, b = encode_block(texts, lexicon)
    for i, text in enumerate(texts):
        ids_a, ids_b = tokenizers.a.encode(" " + text, add_special_tokens=False).ids, tokenizers.b.encode(text)
        whole = b"".join(tokenizers.b_bytes[x] for x in ids_b) == (" " + text).encode()
        assert a.id[a.doc == i].tolist() == (ids_a if whole else [])
        assert b.id[b.doc == i].tolist() == (ids_b if whole else [])


def test_a_full_lexicon_starts_anew(tokenizers):
    small, large = Lexicon(tokenizers, most=5), Lexicon(tokenizers)
    for block in (TEXTS[:5], TEXTS[5:12], TEXTS[:5]):
        for x, y in zip(encode_block(block, small), encode_block(block, large), strict=True):
            assert x.id.tolist() == y.id.tolist() and x.end.tolist() == y.end.tolist()


def test_overlaps_are_all_pairs_that_share_a_byte(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t and len(t) < 100]
    got = sorted((r.doc_id, r.a_at, r.b_at, r.start, r.end, r.together) for r in token_overlaps(spark.createDataFrame(rows, SCHEMA)).collect())
    want = []
    for doc_id, text in rows:
        a, b = encode_block([text], Lexicon(tokenizers))
        for i, (s, e) in enumerate(zip(a.start.tolist(), a.end.tolist(), strict=True)):
            want += [(doc_id, i, j, max(s, x), min(e, y), e == y) for j, (x, y) in enumerate(zip(b.start.tolist(), b.end.tolist(), strict=True)) if x < e and s < y]
    assert got == sorted(want)


def test_odd_documents(odd_docs, no_docs, tokenizers):
    rows = [(r.doc_id, r.text) for r in odd_docs.where("n_chars IS NULL OR length(text) < 5000").collect()]
    got = found(alignment(odd_docs))
    assert len(got) == odd_docs.count() and sorted(g[0] or -1 for g in got) == sorted(r.doc_id or -1 for r in odd_docs.collect())
    assert [g for g in got if not g[1]] == [p for p in sorted(plain(rows, tokenizers), key=str) if not p[1]]
    assert alignment(no_docs).collect() == [] and aligned(no_docs).collect() == [] and token_overlaps(no_docs).collect() == []
