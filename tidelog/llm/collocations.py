"""Phrase collocations by SON partitioning.

The corpus is dealt into a few shards. Each is mined completely, at the support
lowered in proportion: a phrase that occurs ``support`` times in all occurs at least
``support / shards`` times in one of them. The phrases found are united in a bitmap of
fixed size, and a second pass counts exactly, over all documents, the phrases that
the bitmap lets through; what it lets through by chance is dropped by its count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.llm.common import batch, hot_join, lean, read_table, slices, small_batches, stage_table, text_bytes
from tidelog.llm.words import mix, words_of

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = [np.uint64(x | 1) for x in (0x9FB21C651E98DF25, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _blocks(column: pa.Array, most: int):
    """``(flat, bounds, first)``: bytes of about ``most`` at once, cut between texts or pieces, where the texts in them begin, and the number of the first."""
    flat, bounds = text_bytes(column)
    cuts = np.union1d(bounds, np.flatnonzero(_BREAK[flat]) + 1)
    at = 0
    while at < len(flat):
        end = int(cuts[min(max(np.searchsorted(cuts, at + most, side="right") - 1, np.searchsorted(cuts, at, side="right")), len(cuts) - 1)])
        first = int(np.searchsorted(bounds, at, side="right")) - 1
        inside = bounds[first + 1 : np.searchsorted(bounds, end)]
        yield flat[at:end], np.concatenate([[at], inside, [end]]) - at, first
        at = end


class Grams:
    """The words of a block and the hashes of its phrases of 1 to ``longest`` words within pieces."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray, lang: np.ndarray, longest: int):
        gap = _GAP[flat]
        edge = np.zeros(len(flat) + 1, bool)
        edge[bounds] = True
        before, after = np.append(True, gap[:-1]), np.append(gap[1:], True)
        self.start = np.flatnonzero(~gap & (before | edge[:-1]))
        self.end = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.text = np.searchsorted(bounds, self.start, side="right") - 1
        piece = np.cumsum(_BREAK[flat])[self.start] + self.text
        words = words_of(flat, bounds, _GAP).hashes
        n = len(words)
        total = mix(lang.view(np.uint64))[self.text]
        self.at, self.hash, self.width = [], [], []
        for k in range(1, min(longest, n) + 1):
            total = total[: n - k + 1] + words[k - 1 :] * _ODD[(k - 1) % len(_ODD)] * np.uint64(2 * k - 1)
            at = np.flatnonzero(piece[: n - k + 1] == piece[k - 1 :])
            self.at.append(at)
            self.hash.append(mix(total[at] + np.uint64(k)))
            self.width.append(np.full(len(at), k))
        joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.at, self.hash, self.width = joined(self.at, np.int64), joined(self.hash, np.uint64), joined(self.width, np.int64)
        self.flat = flat

    def phrases(self, chosen: np.ndarray) -> pa.Array:
        """The chosen phrases as strings, lower-cased and with single spaces."""
        size = self.end - self.start + 1
        place = np.cumsum(size) - size
        spread = np.repeat(self.start - place, size) + np.arange(size.sum())
        line = _LOWER[self.flat[np.minimum(spread, len(self.flat) - 1)]]
        line[place + size - 1] = 0x20
        first, last = self.at[chosen], self.at[chosen] + self.width[chosen] - 1
        length = place[last] + size[last] - 1 - place[first]
        offsets = np.concatenate([[0], np.cumsum(length)])
        data = line[np.repeat(place[first] - offsets[:-1], length) + np.arange(offsets[-1])]
        return pa.LargeStringArray.from_buffers(len(chosen), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def _inputs(docs: DataFrame, shards: int) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))
    return docs.select(F.col("text").cast("string").alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), shard.alias("shard")).where("text IS NOT NULL")


_MINED = pa.schema([("key", pa.int64()), ("n", pa.int64())])
_SHARD_BITS = 6  # the low bits of a mined phrase's key are its shard, the others those of its hash


def _mine(longest: int, block_bytes: int, hold: int):
    shards = np.uint64((1 << _SHARD_BITS) - 1)

    def counted(held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return batch(_MINED, key=keys.view(np.int64), n=counts)

    def run(batches):
        held, size = [], 0
        for x in slices(batches, 4 << 20):
            lang, shard = x.column("lang_hash").to_numpy(), x.column("shard").to_numpy().astype(np.uint64)
            for flat, bounds, first in _blocks(x.column("text"), block_bytes):
                grams = Grams(flat, bounds, lang[first : first + len(bounds) - 1], longest)
                held.append(grams.hash & ~shards | shard[first + grams.text[grams.at]])
                size += len(grams.hash)
                if size >= hold:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    return run


def locally_frequent(docs: DataFrame, support: int = 10, shards: int = 4, longest: int = 3, block_bytes: int = 1 << 20, hold: int = 3_000_000) -> DataFrame:
    """``shard, hash, n``: the phrases (as 58 bits of a hash with their language) that a shard holds ``support / shards`` times or more.

    Shards are large, each mined by all tasks together: a task counts about ``hold``
    phrases at once, then counts are added up by shard and phrase. Equal documents lie
    in different shards as their ids do; the shares needn't be equal for the result.
    """
    small_batches(docs.sparkSession)
    if not 0 < shards <= 1 << _SHARD_BITS:
        raise ValueError(f"1 to {1 << _SHARD_BITS} shards")
    mined = _inputs(docs, shards).mapInArrow(lean(_mine(longest, block_bytes, hold)), "key long, n long")
    # Tasks have counted already: adding up before the shuffle would fill memory with phrases that occur once.
    found = mined.repartition("key").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") * shards >= support)
    return found.select(F.col("key").bitwiseAND(F.lit((1 << _SHARD_BITS) - 1)).alias("shard"), F.shiftright("key", _SHARD_BITS).alias("hash"), "n")


def bitmap(hashes: DataFrame, bits: int = 27) -> np.ndarray:
    """The lower ``bits`` of all values of ``hash`` as a bitmap of ``2**bits`` bits: ``2**(bits - 6)`` rows reach the driver at most, whatever the data."""
    at = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = hashes.select(F.shiftright(at, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    table = words.toArrow()
    out = np.zeros(1 << max(0, bits - 6), np.int64)
    out[table.column("word").to_numpy()] = table.column("bit").to_numpy()
    return out.view(np.uint8)


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("width", pa.int64()), ("n", pa.int64())])


def _count(filter_, bits: int, longest: int, block_bytes: int):
    def run(batches):
        allowed = filter_.value
        for x in slices(batches, 4 << 20):
            lang_hash, lang = x.column("lang_hash").to_numpy(), x.column("lang")
            words = np.zeros(x.num_rows, np.int64)
            for flat, bounds, first in _blocks(x.column("text"), block_bytes):
                grams = Grams(flat, bounds, lang_hash[first : first + len(bounds) - 1], longest)
                words[first : first + len(bounds) - 1] += np.bincount(grams.text, minlength=len(bounds) - 1)
                low = grams.hash >> np.uint64(_SHARD_BITS) & np.uint64((1 << bits) - 1)
                kept = np.flatnonzero(allowed[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
                _, one, times = np.unique(grams.hash[kept], return_index=True, return_counts=True)
                one = kept[one]
                yield batch(_COUNTED, lang=lang.take(pa.array(first + grams.text[grams.at[one]])), phrase=grams.phrases(one), width=grams.width[one], n=times)
            yield batch(_COUNTED, lang=lang, phrase=pa.nulls(x.num_rows, pa.string()), width=np.zeros(x.num_rows, np.int64), n=words)

    return run


def counted_phrases(docs: DataFrame, frequent: DataFrame, support: int = 10, longest: int = 3, bits: int = 27, block_bytes: int = 1 << 20) -> DataFrame:
    """``lang, phrase, width, f``: exact counts, over all documents, of the phrases of 1 to ``longest`` words that occur ``support`` times or more; and with ``width`` 0 and no phrase each language's words.

    Within a block phrases are told apart by 64-bit hashes, between blocks by themselves.
    """
    small_batches(docs.sparkSession)
    filter_ = docs.sparkSession.sparkContext.broadcast(bitmap(frequent, bits))
    rows = _inputs(docs, 1).mapInArrow(lean(_count(filter_, bits, longest, block_bytes)), "lang string, phrase string, width long, n long")
    return rows.groupBy("lang", "phrase", "width").agg(F.sum("n").alias("f")).where(f"f >= {support} OR width = 0")


def _key(phrase: Column) -> Column:
    return F.concat(phrase, F.lit("\n"), F.col("lang"))  # no phrase has a line end in it


def _run(words: Column, first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, width, a, l, r, score`` of the phrases of two words or more, each at its lowest-scoring cut, ties to the first.

    The parts of a frequent phrase are frequent, so their counts are all there. A part
    that very many phrases begin or end with is joined by broadcast (``hot_join``).
    """
    known = phrases.where("width > 0").select(_key(F.col("phrase")).alias("part"), "f")
    longer = phrases.where("width > 1").withColumn("w", F.split("phrase", " "))
    side = lambda name, text: F.struct(F.lit(name).alias("side"), _key(text).alias("part"))
    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), (F.col("width") - 1).cast("int"))))
    sides = F.array(side("l", _run(F.col("w"), 1, F.col("cut"))), side("r", _run(F.col("w"), F.col("cut") + 1, F.col("width").cast("int") - F.col("cut"))))
    wanted = cuts.select("lang", "phrase", "width", F.col("f").alias("a"), "cut", F.explode(sides).alias("s")).select("lang", "phrase", "width", "a", "cut", "s.*")
    uses = wanted.groupBy("part").agg(F.count("*").alias("n_left"))
    total = phrases.agg(F.coalesce(F.sum(F.when(F.col("width") > 1, 2 * (F.col("width") - 1))), F.lit(0))).first()[0]
    found = hot_join(wanted, known.join(uses, "part"), "part", total)
    of = lambda name: F.max(F.when(F.col("side") == name, F.col("f"))).alias(name)
    each = found.groupBy("lang", "phrase", "width", "a", "cut").agg(of("l"), of("r"))
    exact = lambda c: f"cast({c} as decimal(38, 0))"
    score = F.expr(f"{exact(1000000)} * {exact('a')} * {exact('a')} div ({exact('l')} * {exact('r')})")
    lowest = each.withColumn("score", score).groupBy("lang", "phrase", "width", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return lowest.select("lang", "phrase", "width", "a", "low.l", "low.r", "low.score")


def covered(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """``lang, phrase`` that lie within a longer phrase with ``percent`` of their count or more; ``phrases`` has all with their ``f``."""
    longer = phrases.where("width > 2").withColumn("w", F.split("phrase", " "))
    sizes = F.sequence(F.lit(2), (F.col("width") - 1).cast("int"))
    inner = F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.col("width").cast("int") - n + 1), lambda i: _run(F.col("w"), i, n))))
    most = longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return phrases.where("width > 1").join(most, ["lang", "phrase"]).where(F.col("most") * 100 >= F.col("f") * percent).select("lang", "phrase")


def collocations(docs: DataFrame, support: int = 10, shards: int = 4, longest: int = 3, percent: int = 50, top: int | None = 2000, bits: int = 27) -> DataFrame:
    """The collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Needs ``doc_id``, ``text`` and ``lang``; other columns are ignored. A null ``lang``
    is ``und``, a null or empty text has no words; repeated rows count as often as
    they occur; an empty table gives no rows. Ties in score and count are ranked
    by the phrase's bytes. ``top`` is how many a language reports (None: all, unranked
    beyond a window over a language's phrases).

    Nothing but the bitmap and single figures reaches the driver. A language's best
    are picked within 64 parts first, so that a language that holds most of the corpus
    isn't ranked by one task.
    """
    frequent = stage_table(locally_frequent(docs, support, shards, longest).select("hash"), "collocations-local")
    phrases = stage_table(counted_phrases(docs, frequent, support, longest, bits), "collocations-phrases")
    rows = scored(phrases).join(covered(phrases, percent), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:
        parts = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        rows = parts.withColumn("_best", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_best") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    words = phrases.where("width = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collocations`` of all documents."""
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS piece, lang, w FROM (
    SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
  ) WHERE len(w) > 0
),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) AS t(k))
),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
cut AS (
  SELECT lang, k, phrase, f AS a, c, array_to_string(string_split(phrase, ' ')[:c], ' ') AS first, array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS rest
  FROM f, (VALUES (1), (2)) AS t(c) WHERE c < k
),
scored AS (
  SELECT cut.lang, cut.k, cut.phrase, a, c, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f * r.f) AS score
  FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = first JOIN f AS r ON r.lang = cut.lang AND r.phrase = rest
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_ AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase, max(f) AS most FROM f, (VALUES (1), (2)) AS t(i) WHERE k = 3 GROUP BY ALL
),
kept AS (SELECT * FROM lowest WHERE NOT EXISTS (SELECT 1 FROM inner_ WHERE inner_.lang = lowest.lang AND inner_.phrase = lowest.phrase AND 100 * most >= 50 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
