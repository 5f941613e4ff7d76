"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Everything here is DataFrame and SQL functions; no Python runs on the executors.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import lower_ascii

#: Fixed values: (action, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: The small labelled table: unwanted (1) and wanted (0) urls under reserved top-level names.
TABLE = Path(__file__).with_name("labelled_urls.csv")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))), F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host`` + ``path`` text, and its action; null where none fits."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text, action = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text), F.when(fits, F.lit(act)).otherwise(action)
    return text, action


def grams(host: Column, path: Column, dims: int, widths: tuple[int, ...] = (3, 4)) -> Column:
    """Buckets 1 to ``dims`` of the character n-grams of ``^host path$``; repeats stay."""
    text = F.concat(F.lit("^"), host, F.lit(" "), path, F.lit("$"))
    one = lambda n: F.transform(F.sequence(F.lit(1), F.char_length(text) - n + 1), lambda i: (F.pmod(F.xxhash64(F.substring(text, i, F.lit(n))), F.lit(dims)) + 1).cast("int"))
    return F.concat(*[F.when(F.char_length(text) >= n, one(n)).otherwise(F.array().cast("array<int>")) for n in widths])


def train(labelled: DataFrame, dims: int = 2048, rounds: int = 200, rate: float = 6.0, decay: float = 1e-3, most_rows: int = 2_000) -> list[float]:
    """Weights of the ``dims`` buckets, then the bias, by gradient descent inside one SQL expression.

    ``labelled`` (``url``, ``label`` 0/1) is a small table: its rows, at most
    ``most_rows`` that a hash picks, are gathered into one row of feature lists and
    posting lists, over which ``aggregate`` runs the rounds. Null labels are left out;
    without rows all weights are 0.
    """
    labelled = labelled.where("label IS NOT NULL").orderBy(F.xxhash64("url"), "url", "label").limit(most_rows)
    host, path = url_parts(labelled["url"])
    rows = labelled.select(F.col("label").cast("double").alias("y"), grams(host, path, dims).alias("f"), F.coalesce("url", F.lit("")).alias("u"))
    examples = rows.agg(F.array_sort(F.collect_list(F.struct("u", "y", "f"))).alias("ex"))
    flat = examples.select(F.posexplode("ex").alias("i", "e")).select("i", F.explode("e.f").alias("d"), F.size("e.f").alias("n"))
    lists = flat.groupBy("d").agg(F.collect_list(F.struct("i", (1 / F.sqrt("n")).alias("c"))).alias("p"))
    lists = lists.agg(F.map_from_entries(F.collect_list(F.struct("d", "p"))).alias("lists"))
    spark = labelled.sparkSession
    sql = f"""
      SELECT aggregate(sequence(1, {rounds}), array_repeat(0D, {dims + 1}), (w, r) -> aggregate(
        array(transform(ex, e -> e.y - 1 / (1 + exp(-(element_at(w, {dims + 1}) + aggregate(e.f, 0D, (s, f) -> s + element_at(w, f)) / sqrt(greatest(1, size(e.f)))))))),
        w, (v, err) -> transform(v, (x, k) -> x * (1 - {decay}) + {rate} / greatest(1, size(ex)) * IF(k = {dims}, aggregate(err, 0D, (s, g) -> s + g),
          aggregate(coalesce(lists[k + 1], array()), 0D, (s, p) -> s + p.c * err[p.i]))))) AS w
      FROM (SELECT (SELECT ex FROM {{examples}}) AS ex, (SELECT lists FROM {{lists}}) AS lists)"""
    return spark.sql(sql, examples=examples, lists=lists).first()["w"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table that comes with the library: ``url, label``."""
    with TABLE.open(newline="") as f:
        values = ", ".join(f"('{r['url']}', {int(r['label'])})" for r in csv.DictReader(f))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, dims: int = 2048, threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block`` for every row of ``pages`` (needs ``page_id``, ``url``).

    The longest rule that fits decides; else the model does: block above
    ``threshold``. ``p_block`` is the model's probability, null where a rule decides. A
    null url or one without ``://`` has empty host and path, fits no rule and is left
    to the model. Without labelled rows nothing is known and the model blocks nothing.
    Repeated rows are judged alike, an empty table gives no rows, other columns are
    ignored. The weights (``dims`` + 1 numbers) are a literal of the plan.
    """
    weights = train(labelled if labelled is not None else labelled_urls(pages.sparkSession), dims)
    host, path = url_parts(pages["url"])
    rows = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    rule, action = matched_rule(F.col("host"), F.col("path"), rules)
    w = F.lit(weights)
    f = grams(F.col("host"), F.col("path"), dims)
    z = F.aggregate("f", F.lit(0.0), lambda s, k: s + F.element_at(w, k)) / F.sqrt(F.greatest(F.lit(1), F.size("f"))) + F.lit(weights[dims])
    rows = rows.select("*", rule.alias("rule"), action.alias("action")).withColumn("f", F.when(F.col("action").isNull(), f))
    rows = rows.withColumn("p_block", F.when(F.col("action").isNull(), 1 / (1 + F.exp(-z))))
    verdict = F.coalesce("action", F.when(F.col("p_block") > threshold, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``judge_urls`` of all pages by the fixed rules and the library's labelled table."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
