"""Licence scans against plain searches, and on edited notices."""

import csv
import re

import pytest

from tidelog.llm.licences import PHRASES, TEMPLATES, licences, spans

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NOTICES = [r for r in csv.DictReader(TEMPLATES.open(newline=""))]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w, places = words(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    "MIT License mit-license (MIT) License? mit licensed", "GNU General Public License, general public license; gnu GENERAL public  LICENSE", "cc by cc-by CC BY-NC 4.0 by cc", "é apache license Ünïcode apache\nlicense 42",
    "gnu general public gnu general public license public license", None, "", " .,", "mit", "cc cc by by", "İ mit license K",
]


def test_base_columns_equal_a_plain_search(spark):
    rows = [(i % 7, t) for i, t in enumerate(TEXTS)] + [(None, "mit license")]
    got = sorted((tuple(r[c] for c in COLUMNS[:6]) for r in licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(d, *base(t)) for d, t in rows], key=str)


def test_labels_keep_the_base_ones_and_scores_are_shares(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for r in licences(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score == 0) == (r.labels == "") and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


@pytest.fixture(scope="module")
def edited(spark):
    """Every template in the midst of other words: whole, with a word put in, left out and replaced, and only its first third."""
    filler = " ".join(f"filler{i}" for i in range(30))
    rows = []
    for i, r in enumerate(NOTICES):
        w = r["text"].split()
        mid = len(w) // 2
        for j, text in enumerate((w, [*w[:mid], "extra", *w[mid:]], w[:mid] + w[mid + 1 :], [*w[:mid], "other", *w[mid + 1 :]], w[: len(w) // 3])):
            rows.append((10 * i + j, f"{filler} {' '.join(text).upper()} {filler}"))
    return {r.doc_id: r for r in licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_notices_are_found_whole_and_edited(edited):
    for i, r in enumerate(NOTICES):
        assert r["label"] in edited[10 * i].labels.split(",") and edited[10 * i].score == 1, r
        own = set(edited[10 * i].labels.split(",")) - set(PHRASES.values())
        assert own <= {r["label"]}, (r, own)  # and not its relatives
        if len(words(r["text"])) > 24:
            assert all(r["label"] in edited[10 * i + j].labels.split(",") and edited[10 * i + j].score >= 0.8 for j in (1, 2, 3)), r
            assert r["label"] not in edited[10 * i + 4].labels.split(",") or r["label"] in edited[10 * i + 4].base_labels, r


def test_spans_say_where(spark):
    notice = next(r["text"] for r in NOTICES if r["label"] == "isc")
    text = f"one two {notice} three {notice} four"
    n = len(words(notice))
    got = sorted((r.first, r.last, r.label, r.share) for r in spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).where("template >= 0").collect())
    assert got == [(2, 1 + n, "isc", 1.0), (3 + n, 2 + 2 * n, "isc", 1.0)]


def test_odd_documents(odd_docs, no_docs):
    got = licences(odd_docs).collect()
    assert sorted(((r.doc_id, r.n_words) for r in got), key=str) == sorted(((r.doc_id, len(words(r.text))) for r in odd_docs.collect()), key=str)
    assert licences(no_docs).collect() == []


def test_no_python_runs_on_executors(spark):
    plan = licences(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|ExistingRDD|Pandas", plan)
