"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.llm.common import batch, lean, shuffle_width, stage_table
from tidelog.llm.words import word_blocks

_SIZED = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("row", pa.int64()), ("size", pa.int64())])


def _sizes(batches):
    for b in batches:
        counts = [w.counts for _, _, w in word_blocks(b.column("text"))]
        yield batch(_SIZED, doc_id=b.column("doc_id"), source=b.column("source"), row=b.column("row"), size=np.concatenate(counts) if counts else [])


def _row(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), docs["source"].cast("string"), docs["text"])


def word_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, row, size``: the number of words of each whole text, 0 for null; ``row`` tells rows of one id apart."""
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), _row(docs).alias("row"), docs["text"])
    return chosen.mapInArrow(lean(_sizes), "doc_id long, source string, row long, size long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: ``source, idx, source_size, target``.

    Sources by code point, a null source last, get ``weights`` in turn and share
    ``share`` times all words by weight. A target stops at ``most`` times its
    source's words; the excess is shared again by weight until none is above.
    With the sources ordered by cap per weight this is closed-form: the first
    source whose cap is not reached fixes the words per unit of weight.
    """
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "idx")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("idx", F.row_number().over(by_source) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("idx", F.lit(len(weights))) + 1)
    sources = sources.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(by_cap.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy())
    sources = sources.withColumn("level", (F.lit(share) * total - before) / after)
    level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "idx", "level"))).over(W.partitionBy())
    sources = sources.withColumn("level", level["level"])
    return sources.select("source", "idx", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap").cast("double"))).alias("target"))


def _reversed_bits(x: Column, bits: int) -> Column:
    """The van der Corput point of ``x`` in base 2, times ``2**bits``."""
    return F.conv(F.reverse(F.lpad(F.bin(x), bits, "0")), 2, 10).cast("long") if bits else x


def schedule(plan: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """Slots ``idx, slot, rank`` of each source.

    ``plan`` has ``idx`` and ``slots`` (how many draws a source needs). Slot
    ``i`` of ``2**bits`` is the van der Corput point of ``i`` mapped through the
    cumulative slots of the sources. Reversing bits is its own inverse, so each
    source lists its own slots from its interval of points: nothing is searched,
    and no source's slots meet in one row. Every source gets ``slots`` at least;
    ranks count its slots in schedule order from 0.
    """
    total = plan.agg(F.sum("slots")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(total))) if total else 0
    n = 1 << bits
    ends = F.sum("slots").over(W.orderBy("idx"))
    at = lambda c: F.ceil(F.lit(n).cast("decimal(19,0)") * c.cast("decimal(19,0)") / F.lit(max(total, 1)).cast("decimal(19,0)")).cast("long")
    spans = plan.withColumn("end", ends).withColumn("lo", at(F.col("end") - F.col("slots"))).withColumn("hi", at(F.col("end"))).where("hi > lo")
    starts = spans.select("idx", "slots", "hi", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(chunk).cast("long"))).alias("at")).repartition("idx", "at")
    points = starts.select("idx", "slots", F.explode(F.sequence("at", F.least(F.col("at") + chunk, "hi") - 1)).alias("x"))
    slots = points.select("idx", "slots", _reversed_bits(F.col("x"), bits).alias("slot")).withColumn("part", F.shiftright("slot", max(0, bits - 12)))
    parts = slots.groupBy("idx", "part").agg(F.count("*").alias("n"))
    before = parts.select("idx", "part", (F.sum("n").over(W.partitionBy("idx").orderBy("part")) - F.col("n")).alias("before"))
    ranked = slots.withColumn("rank", F.row_number().over(W.partitionBy("idx", "part").orderBy("slot")) - 1)
    return ranked.join(before, ["idx", "part"]).select("idx", "slots", "slot", (F.col("rank") + F.col("before")).alias("rank")).where("rank < slots").drop("slots")


def _positions(sizes: DataFrame, seed: str) -> DataFrame:
    """Each document's first word in its source's shuffled stream, by sums over key ranges and windows inside them."""
    rows = sizes.where("size > 0").withColumn("key", F.md5(F.concat(F.lit(seed), F.coalesce("doc_id", "row").cast("string"))))
    n = sizes.count()
    rows = rows.withColumn("part", F.substring("key", 1, max(2, math.ceil(math.log(max(n, 1) / 1e4 + 1, 16)))))
    parts = rows.groupBy("idx", "part").agg(F.sum("size").alias("n"))
    before = parts.select("idx", "part", (F.sum("n").over(W.partitionBy("idx").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("size").over(W.partitionBy("idx", "part").orderBy("key", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    return rows.withColumn("inside", inside).join(before, ["idx", "part"]).withColumn("start", F.col("inside") + F.col("before"))


def _mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, block_words: int = 1 << 16, seed: str = "mix:") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written sequence, the documents with words at their places in the streams (``idx, start``), and those without words."""
    sizes = stage_table(word_sizes(docs), "mix-sizes")
    sources = stage_table(source_targets(sizes, weights, share, most), "mix-sources")
    size, quota = F.col("source_size"), F.floor("target").cast("long")
    plan = sources.where("source_size > 0").withColumn("quota", quota).withColumn("blocks", F.greatest(F.lit(8), F.ceil(size / block_words)))
    plan = plan.withColumn("block", F.ceil(size / F.col("blocks")).cast("long")).withColumn("blocks", F.ceil(size / F.col("block")).cast("long"))
    plan = plan.withColumn("slots", F.expr("quota div source_size * blocks + ceil(quota % source_size / block)").cast("long"))

    slots = schedule(plan.select("idx", "slots")).join(plan.select("idx", "source", "quota", "block", "blocks", "source_size"), "idx")
    slots = slots.withColumn("at", F.pmod("rank", "blocks")).withColumn("length", F.least("block", size - F.col("at") * F.col("block")))
    slots = slots.withColumn("take", F.least("length", F.expr("quota - (rank div blocks * source_size + at * block)")))
    slots = slots.select("idx", "source", "at", "slot", "take", F.expr("rank div blocks").alias("pass"))

    indexed = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(sizes["doc_id"], "row", "size", "idx", "source_size", "target")
    placed = stage_table(_positions(indexed, seed).join(plan.select("idx", "block"), "idx").select("doc_id", "row", "size", "idx", "source_size", "target", "start", "block"), "mix-placed")
    pieces = placed.select("doc_id", "row", "size", "idx", "start", "block", F.explode(F.expr("sequence(start div block, (start + size - 1) div block)")).alias("at"))
    a = F.greatest(F.lit(0), F.col("start") - F.col("at") * F.col("block"))
    b = F.least("block", F.col("start") + F.col("size") - F.col("at") * F.col("block"))
    spans = pieces.withColumn("a", a).withColumn("b", b).join(slots, ["idx", "at"]).withColumn("words", F.least("b", "take") - F.col("a")).where("words > 0")
    spans = spans.select("slot", "source", F.col("at").alias("block"), "doc_id", (F.col("at") * F.col("block") + F.col("a") - F.col("start")).alias("first"), "words", "idx", "start", "pass", "row", "a")
    ordered = spans.repartitionByRange(shuffle_width(docs.sparkSession), "slot", "a").sortWithinPartitions("slot", "a").drop("a")
    return stage_table(ordered, "mix-sequence"), placed, indexed.where("size = 0")


def mixed_sequence(docs: DataFrame, **options) -> DataFrame:
    """The mixed sequence: ``slot, source, block, doc_id, first, words``, written in order of the slots.

    Each row is a run of words that a slot draws from one document: ``words`` words
    from its word ``first`` on (0 is a document's first). The rows of a slot stand in
    the order of the block's stream. Options are those of ``mix``.
    """
    return _mixed(docs, **options)[0].select("slot", "source", "block", "doc_id", "first", "words")


def mix(docs: DataFrame, **options) -> DataFrame:
    """How many words the mix takes from each document, added up over the mixed sequence.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored.
    Returns one row per input row: ``doc_id, size, source_size, target, taken, first_slot``,
    the last being the slot in which the mix first takes a word of it, else null.
    Options: ``weights``, ``share`` and ``most`` of ``source_targets``, ``block_words``, ``seed``.

    Each source's documents, shuffled by a hash of their id, form one stream of
    words that is cut into equal blocks of at most ``block_words`` (at least
    eight blocks a source). The schedule gives each source its slots; the slot
    of rank ``k`` draws block ``k`` of the stream, starting over after the last
    one, and the last slot is cut off where the target is reached. Joining
    slots and blocks gives the words taken; targets are rounded down to whole words.

    Null text has size 0 and nothing is taken from it; a null source is a source
    of its own, last in order. Rows with a null ``doc_id`` shuffle by all they hold. Repeated
    rows are separate rows. An empty table gives an empty result. A document
    longer than a block lies in several blocks.
    """
    sequence, placed, empty = _mixed(docs, **options)
    taken = sequence.groupBy("idx", "start").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    columns = ["doc_id", "size", "source_size", "target", "taken", "first_slot"]
    found = placed.join(taken, ["idx", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    return found.select(*columns).unionByName(empty.withColumns({"taken": F.lit(0).cast("long"), "first_slot": F.lit(None).cast("long")}).select(*columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in its order: each as often as the words taken from it come to whole copies, rounded.

    A copy stands at the slot where that pass over the source's stream reaches the
    document's first word, the copies of a slot in the order of the stream. Rows
    without words are not in the mix; equal rows share their copies evenly. Columns
    may have any names.
    """
    sequence, placed, _ = _mixed(docs, **options)
    words = placed.groupBy("row").agg(F.sum("size").alias("size"), F.min("start").alias("start"))
    passes = sequence.groupBy("row", "start", "pass").agg(F.sum("words").alias("words"), F.min(F.when(F.col("first") == 0, F.col("slot"))).alias("slot"))
    starts = passes.groupBy("row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list("slot")).alias("slots"))  # a few passes
    copies = words.join(starts, "row").select("row", "start", F.slice("slots", F.lit(1), F.round(F.col("taken") / F.col("size")).cast("int")).alias("slots"))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), _row(docs).alias("row"))
    ordered = whole.join(copies, "row").select("doc", "start", F.explode("slots").alias("slot"))
    return ordered.repartitionByRange(shuffle_width(docs.sparkSession), "slot", "start").sortWithinPartitions("slot", "start").select("doc.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mix`` of all documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx FROM s0),
s2 AS (SELECT *, CASE idx % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s1),
s3 AS (
  SELECT *, cap::DOUBLE / weight AS reach,
    (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM s2),
s4 AS (SELECT level FROM s3 WHERE level <= reach ORDER BY reach, idx LIMIT 1),
s AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(weight * (SELECT level FROM s4), cap::DOUBLE)) AS target
  FROM s3),
p AS (
  SELECT d.doc_id, d.size, d.source, s.source_size, s.target, floor(s.target)::BIGINT AS quota,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id), d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::BIGINT - d.size AS start
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
b0 AS (
  SELECT source, source_size, floor(target)::BIGINT AS quota, ceil(source_size / greatest(8, ceil(source_size / 65536)))::BIGINT AS block
  FROM s WHERE source_size > 0),
b1 AS (SELECT *, ((quota // source_size) * ceil(source_size / block) + ceil((quota % source_size) / block))::BIGINT AS slots FROM b0),
b2 AS (
  SELECT *, (sum(slots) OVER (ORDER BY source NULLS LAST))::BIGINT AS ends, (sum(slots) OVER ())::BIGINT AS total,
    CASE WHEN sum(slots) OVER () > 0 THEN ceil(log2(sum(slots) OVER ()))::BIGINT ELSE 0 END AS bits
  FROM b1),
x AS (
  SELECT source, slots, bits, unnest(range(((1 << bits) * (ends - slots) + total - 1) // total, ((1 << bits) * ends + total - 1) // total)) AS x
  FROM b2),
v AS (
  SELECT source, slots, coalesce(list_sum(list_transform(range(bits), lambda k: ((x >> k) & 1) << (bits - 1 - k))), 0)::BIGINT AS slot FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank FROM v)
SELECT p.doc_id, p.size, p.source_size, p.target,
  CASE WHEN p.size = 0 THEN 0
       ELSE p.size * (p.quota // p.source_size) + greatest(0, least(p.start + p.size, p.quota % p.source_size) - p.start) END::BIGINT AS taken,
  CASE WHEN p.size > 0 AND p.start < p.quota THEN r.slot END AS first_slot
FROM p LEFT JOIN b1 ON p.source IS NOT DISTINCT FROM b1.source
LEFT JOIN r ON p.source IS NOT DISTINCT FROM r.source AND r.rank = p.start // b1.block AND r.rank < r.slots
"""
