"""Licence scans by diagonal voting.

All rolling word k-grams of a text meet those of the templates in a join. A shared
gram votes for the diagonal text position minus template position; neighbouring
diagonals of a template, as edits leave them, are merged to a span, which counts where
enough of the template's words are found in it. Everything here is DataFrame and SQL
functions; no Python runs on the executors.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.llm.common import lower_ascii, read_table

#: Phrases and the labels that they stand for wherever they occur.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Statements and notices of licences: ``label, text``.
TEMPLATES = Path(__file__).with_name("licence_templates.csv")

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_MOST = 4  # words of a gram


def words(text: Column) -> Column:
    """The lower-cased words of a text: runs of letters, digits and whatever isn't ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAPS), "")


def _gram(k: Column) -> Column:
    """The gram of ``k`` words that begins at a row's position, as text; null where the words end before."""
    of = lambda n: F.when(F.col(f"g.w{n - 1}").isNotNull(), F.concat_ws(" ", *[f"g.w{i}" for i in range(n)]))
    return F.when(k == 0, F.lit("")).when(k == 2, of(2)).otherwise(of(_MOST))


def _grams(df: DataFrame, kinds: tuple[int, ...]) -> DataFrame:
    """Rows of ``df`` (with ``words``) by position: ``pos``, the words ``g.w0`` and following, gram size ``k`` and the gram's ``hash``.

    Size 0 stands for the text itself: one row each, also for a text without words.
    """
    ahead = {f"w{i}": F.slice("words", i + 1, F.size("words")) for i in range(1, _MOST)}
    carried = [c for c in df.columns if c != "words"]
    by_position = df.withColumn("w0", F.col("words")).withColumns(ahead).select(*carried, F.posexplode_outer(F.arrays_zip(*[f"w{i}" for i in range(_MOST)])).alias("pos", "g"))

    def hashed(k: int) -> Column:
        if k == 0:
            return F.when(F.coalesce("pos", F.lit(0)) == 0, F.lit(0).cast("long"))
        return F.when(F.col(f"g.w{k - 1}").isNotNull(), F.xxhash64(*[f"g.w{i}" for i in range(k)]))

    each = F.array(*[F.struct(F.lit(k).alias("k"), hashed(k).alias("hash")) for k in kinds])
    return by_position.withColumn("e", F.explode(each)).select(*carried, "pos", "g", "e.k", "e.hash").where("hash IS NOT NULL")


def template_grams(spark: SparkSession, path: Path = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """``template, label, phrase (whether it is one), length, at, k, hash, gram``: positions of the grams of all templates.

    Phrases go by grams of two words, templates by four; a template of fewer than four
    words can't be found. One more row, without template, stands for texts themselves.
    """
    with path.open(newline="") as f:
        known = [(label, text, True) for text, label in phrases.items()] + [(r["label"], r["text"], False) for r in csv.DictReader(f)]
    quoted = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"({i}, {quoted(label)}, {str(phrase).lower()}, {quoted(text)})" for i, (label, text, phrase) in enumerate(known))
    table = spark.sql(f"SELECT * FROM VALUES {rows} AS t(template, label, phrase, text)").withColumn("words", words(F.col("text"))).withColumn("length", F.size("words")).drop("text")
    grams = _grams(table, (2, _MOST)).where(F.col("k") == F.when(F.col("phrase"), 2).otherwise(_MOST))
    grams = grams.select("template", "label", "phrase", "length", F.col("pos").alias("at"), "k", "hash", _gram(F.col("k")).alias("gram"))
    return grams.unionByName(spark.sql("SELECT -1 AS template, cast(null AS string) AS label, false AS phrase, 0 AS length, 0 AS at, 0 AS k, 0L AS hash, '' AS gram"))


def spans(docs: DataFrame, templates: DataFrame | None = None, least: float = 0.8, slack: int = 8) -> DataFrame:
    """Verified spans: ``row, doc_id, n_words, template, label, phrase, first, last`` (words of the text, from 0) and ``share`` of the template's words found in them.

    A phrase's span is exact. A template's diagonals that differ by ``slack`` at most (a
    quarter of its length if that is less) are merged; a span counts with ``least`` of
    the words. Of templates' spans that share words of the text the one with the
    most words found stays. Each row of ``docs`` also has one row without template.
    """
    templates = template_grams(docs.sparkSession) if templates is None else templates
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text").cast("string")).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    side = F.broadcast(templates.toDF(*[f"t_{c}" for c in templates.columns]))  # grows with the table of templates only
    grams = _grams(texts, (0, 2, _MOST))
    same = F.coalesce(_gram(F.col("k")) == F.col("t_gram"), F.lit(False))  # no key of the join: texts are made and compared only where hashes meet
    hits = grams.join(side, (grams["hash"] == side["t_hash"]) & same)
    hits = hits.select("row", "doc_id", "n_words", *[F.col(f"t_{c}").alias(c) for c in ("template", "label", "phrase", "length", "k")], (F.col("pos") - F.col("t_at")).alias("diagonal"), F.col("t_at").alias("at")).repartition("row")
    text = ["row", "doc_id", "n_words", "template", "label", "phrase", "length"]
    covered = lambda: F.sequence(F.col("at"), F.col("at") + F.col("k") - 1)
    by_diagonal = hits.groupBy(*text, "diagonal").agg(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("k") > 0, covered())))).alias("found"))
    near = F.when(F.col("phrase"), 0).otherwise(F.least(F.lit(slack), F.floor(F.col("length") / 4)))
    by_template = W.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_template)
    merged = by_diagonal.withColumn("new", F.when(gap <= near, 0).otherwise(1)).withColumn("span", F.sum("new").over(by_template.rowsBetween(W.unboundedPreceding, 0)))
    found = merged.groupBy(*text, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n_found"), F.min(F.col("diagonal") + F.array_min("found")).cast("long").alias("first"), F.max(F.col("diagonal") + F.array_max("found")).cast("long").alias("last"),
    )
    found = found.withColumn("share", F.col("n_found") / F.greatest(F.lit(1), F.col("length"))).where((F.col("template") < 0) | F.when(F.col("phrase"), F.col("share") == 1).otherwise(F.col("share") >= least))
    # Islands of templates' spans that share words; phrases and texts themselves are islands of their own.
    alone = F.when(F.col("phrase") | (F.col("template") < 0), F.concat_ws(",", "template", "first")).otherwise("")
    found = found.withColumn("alone", alone)
    in_text = W.partitionBy("row", "alone").orderBy("first", "last", "template")
    reach = F.max("last").over(in_text.rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", F.when(F.col("first") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(in_text.rowsBetween(W.unboundedPreceding, 0)))
    best = W.partitionBy("row", "alone", "island").orderBy(F.col("n_found").desc(), F.col("share").desc(), "template", "first")
    return found.withColumn("place", F.row_number().over(best)).where("place = 1").select("row", "doc_id", "n_words", "template", "label", "phrase", "first", "last", "share")


def licences(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of the fixed phrases, ``first_word`` and ``last_word`` are
    the least and greatest word they start at (null without). ``labels`` adds those of
    templates found; ``score`` is the greatest share found of a phrase or template, 0
    without. Null and empty texts have no words and empty labels. Repeated rows and ids
    are judged by row; an empty table gives no rows; other columns are ignored. A
    text is exploded to a row for each position in its task; only shared grams are shuffled.
    """
    found = spans(docs, **options)
    base = F.col("phrase")
    joined = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"), F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.lit(True)).alias("labels"), F.max("share").alias("score"),
    ).drop("row")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``licences`` of all documents by the fixed phrases and the library's templates."""
    return licences(read_table(spark, sf_dir, "documents"))


def _sql() -> str:
    with TEMPLATES.open(newline="") as f:
        known = [(label, text, True) for text, label in PHRASES.items()] + [(r["label"], r["text"], False) for r in csv.DictReader(f)]
    values = ", ".join("({}, '{}', {}, '{}')".format(i, label, phrase, text.replace("'", "''")) for i, (label, text, phrase) in enumerate(known))
    return rf"""
WITH known(template, label, phrase, text) AS (VALUES {values}),
low AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
docs AS (SELECT row, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
temps AS (SELECT template, label, phrase, CASE WHEN phrase THEN 2 ELSE 4 END AS k, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM known),
tgrams AS (SELECT template, label, phrase, k, len(w) AS length, i - 1 AS place, array_to_string(w[i:i + k - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM temps)),
grams AS (SELECT row, k, i - 1 AS pos, array_to_string(w[i:i + k - 1], ' ') AS gram FROM (SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (VALUES (2), (4)) AS s(k))),
votes AS (SELECT row, template, label, phrase, length, pos - place AS diagonal, unnest(range(place, place + grams.k)) AS found FROM grams JOIN tgrams ON grams.k = tgrams.k AND grams.gram = tgrams.gram),
diagonals AS (SELECT row, template, label, phrase, length, diagonal, min(found) AS lo, max(found) AS hi FROM votes GROUP BY ALL),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) <= CASE WHEN phrase THEN 0 ELSE least(8, length // 4) END THEN 0 ELSE 1 END AS new FROM diagonals),
merged AS (SELECT *, sum(new) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM marked),
found AS (SELECT row, template, span, count(DISTINCT found) AS n FROM merged JOIN votes USING (row, template, diagonal) GROUP BY ALL),
ends AS (SELECT row, template, label, phrase, length, span, min(diagonal + lo) AS first, max(diagonal + hi) AS last FROM merged GROUP BY ALL),
verified AS (SELECT *, n / length AS share FROM ends JOIN found USING (row, template, span) WHERE CASE WHEN phrase THEN n = length ELSE n / length >= 0.8 END),
reach AS (SELECT *, CASE WHEN first <= max(last) OVER (PARTITION BY row ORDER BY first, last, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS starts FROM verified WHERE NOT phrase),
islands AS (SELECT *, sum(starts) OVER (PARTITION BY row ORDER BY first, last, template ROWS UNBOUNDED PRECEDING) AS island FROM reach),
best AS (SELECT row, label, phrase, first, share FROM islands QUALIFY row_number() OVER (PARTITION BY row, island ORDER BY n DESC, share DESC, template, first) = 1 UNION ALL SELECT row, label, phrase, first, share FROM verified WHERE phrase)
SELECT doc_id, len(any_value(w))::BIGINT AS n_words, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0)::DOUBLE AS score
FROM docs LEFT JOIN best USING (row) GROUP BY row, doc_id"""


OP12_SQL = _sql()
