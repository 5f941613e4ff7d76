"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import batch, lean, small_batches, stage_table
from tidelog.llm.words import shingles_of, word_blocks

#: Hash orders; one value of each is compared (bands of one row).
ORDERS = 64
#: Items with fewer shingles than this are searched with windows of one shingle.
SMALLEST = 8
#: Table entries that are looked at together.
TOGETHER = 1 << 20
_ODD = np.random.default_rng(11).integers(0, 2**31, ORDERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PAIR = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_shingles", pa.int64()), ("shared", pa.int64()), ("containment", pa.float64())])
_HIT = pa.schema([("row", pa.int64())])


def _codes(values: np.ndarray, bits: int) -> np.ndarray:
    """Table positions of hash values, apart for each order (first axis)."""
    own = (values * np.uint32(2654435761) >> np.uint32(32 - bits)).astype(np.int64)
    return own + (np.arange(len(values), dtype=np.int64) << bits)[:, None]


def _narrow(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)


def _spread(low: np.ndarray, high: np.ndarray):
    """The numbers of all ranges ``low`` to ``high - 1``, about ``TOGETHER`` at a time."""
    width = high - low
    ends = np.cumsum(width)
    first = 0
    while first < len(low):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - width[first] + TOGETHER, "right")))
        own = width[first:last]
        yield np.repeat(low[first:last] - np.cumsum(own) + own, own) + np.arange(own.sum())
        first = last


@dataclass
class Partition:
    """Items of ``2**c`` to ``2**(c+1) - 1`` shingles: the least value of each under every hash order."""

    keys: np.ndarray
    items: np.ndarray
    table: np.ndarray
    bits: int


@dataclass
class ItemIndex:
    """A bounded block of benchmark items, partitioned by size, and which items hold each shingle."""

    ids: list[int]
    sizes: np.ndarray
    shingles: np.ndarray
    start: np.ndarray
    owners: np.ndarray
    least: np.ndarray
    partitions: dict[int, Partition] = field(default_factory=dict)
    small: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def build(cls, ids: list[int], texts: list[str | None], k: int, least: float) -> ItemIndex:
        sets = []
        for _, _, words in word_blocks(pa.array(texts, pa.string())):
            shingles, at = shingles_of(words, k)
            sets += [np.unique(shingles[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        sizes = np.array([len(s) for s in sets], np.int64)
        flat, owner = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        known, start, often = np.unique(flat[order], return_index=True, return_counts=True)
        needed = np.ceil(least * sizes - 1e-9).astype(np.int64)
        index = cls(ids, sizes, known, np.append(start, len(flat)), owner[order], needed)
        groups, small = {}, []
        for i, s in enumerate(sets):
            if len(s) >= SMALLEST:
                groups.setdefault(int(math.log2(len(s))), []).append(i)
            elif len(s):
                # What holds enough of an item holds one of its rarest ``size - needed + 1`` shingles.
                rare = s[np.argsort(often[np.searchsorted(known, s)], kind="stable")]
                small += [(x, i) for x in rare[: len(s) - max(1, int(needed[i])) + 1]]
        for c, members in groups.items():
            flat, starts = np.concatenate([_narrow(sets[i]) for i in members]), np.concatenate([[0], np.cumsum(sizes[members])[:-1]])
            values = np.stack([np.minimum.reduceat(flat * a, starts) for a in _ODD])
            bits = min(18, max(10, len(members).bit_length() + 3))
            table = np.zeros(ORDERS << bits, bool)
            table[_codes(values, bits).ravel()] = True
            keys = (np.arange(ORDERS, dtype=np.uint64)[:, None] << np.uint64(32) | values).ravel()
            order = np.argsort(keys, kind="stable")
            index.partitions[c] = Partition(keys[order], np.tile(members, ORDERS)[order], table, bits)
        if small:
            small.sort()
            index.small = np.array([x for x, _ in small], np.uint64), np.array([i for _, i in small])
        return index

    def candidates(self, shingles: np.ndarray, offsets: np.ndarray):
        """``(text, items)`` of a block of texts worth verifying. A text's items are marked in one array, however many windows meet them."""
        counts, found = np.diff(offsets), []
        if not len(shingles):
            return
        if self.small is not None:
            found.append(self._met(*self.small, shingles, np.repeat(np.arange(len(counts)), counts)))
        # The least values of runs of 16 shingles; all longer windows are made from these.
        n = -(-counts // 16)
        text = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        if self.partitions:
            starts, narrow = offsets[text] + 16 * within, _narrow(shingles)
            runs = np.stack([np.minimum.reduceat(narrow * a, starts) for a in _ODD])
        for c in range(3, max(self.partitions, default=2) + 1):
            if c > 3:  # twice as long
                even = np.flatnonzero(within % 2 == 0)
                runs, text, within = np.minimum.reduceat(runs, even, axis=1), text[even], within[even] // 2
            if c not in self.partitions:
                continue
            # A window is two runs, and windows overlap by one run: what lies within a run's length lies in some window.
            windows = runs.copy()
            joined = text[:-1] == text[1:]
            np.minimum(windows[:, :-1], windows[:, 1:], out=windows[:, :-1], where=joined)
            part = self.partitions[c]
            order, at = np.nonzero(part.table[_codes(windows, part.bits)])
            keys = order.astype(np.uint64) << np.uint64(32) | windows[order, at]
            found.append(self._met(part.keys, part.items, keys, text[at]))
        for t in np.unique(np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])).tolist():
            marked = np.zeros(len(self.ids), bool)
            for texts, low, high, items in found:
                a, b = np.searchsorted(texts, [t, t + 1])
                for at in _spread(low[a:b], high[a:b]):
                    marked[items[at]] = True
            yield t, np.flatnonzero(marked)

    @staticmethod
    def _met(keys, items, values, text):
        """Texts (sorted) and the ranges of ``items`` that their values meet."""
        low, high = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
        some = np.flatnonzero(high > low)
        some = some[np.argsort(text[some], kind="stable")]
        return text[some], low[some], high[some], items

    def shared(self, distinct: np.ndarray) -> np.ndarray:
        """How many of ``distinct`` shingles each item holds."""
        at = np.minimum(np.searchsorted(self.shingles, distinct), len(self.shingles) - 1)
        at = at[self.shingles[at] == distinct]
        counts = np.zeros(len(self.ids), np.int64)
        for own in _spread(self.start[at], self.start[at + 1]):
            counts += np.bincount(self.owners[own], minlength=len(counts))
        return counts

    def matches(self, column: pa.Array, k: int):
        """``(row, item, shared)`` for each text that holds enough of an item's distinct shingles."""
        for first, _, words in word_blocks(column):
            shingles, offsets = shingles_of(words, k)
            for text, items in self.candidates(shingles, offsets):
                shared = self.shared(np.unique(shingles[offsets[text] : offsets[text + 1]]))
                for item in items[shared[items] >= self.least[items]].tolist():
                    yield first + text, item, int(shared[item])


def _blocks(benchmark: DataFrame, block_items: int, block_chars: int) -> tuple[DataFrame, int]:
    """The items with the number of their block, and how many blocks there are."""
    small_batches(benchmark.sparkSession)
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"])
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / block_items), math.ceil(chars / block_chars))
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def _index(items: DataFrame, block: int, k: int, least: float):
    """The broadcast index of one block."""
    rows = items.where(F.col("block") == block).collect()
    rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"] or ""))
    return items.sparkSession.sparkContext.broadcast(ItemIndex.build([r["item_id"] for r in rows], [r["text"] for r in rows], k, least))


def _by_block(find, items: DataFrame, blocks: int, k: int, least: float) -> DataFrame:
    """The union of ``find(index)`` over all blocks. Only one block's index is held at a time: where there are several, each result is written."""
    if blocks == 1:
        return find(_index(items, 0, k, least))
    found = []
    for block in range(blocks):
        index = _index(items, block, k, least)
        found.append(stage_table(find(index), "decontam-block"))
        index.unpersist()
    return reduce(DataFrame.unionByName, found)


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.8, block_items: int = 8192, block_chars: int = 16 << 20) -> DataFrame:
    """Pairs of a document and a benchmark item of whose ``k``-word shingles the document holds at least ``least``.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` needs ``item_id`` and
    ``text``; other columns are ignored. Returns ``doc_id, item_id, item_shingles,
    shared, containment``.

    Items are partitioned by size, and each partition compares with overlapping
    windows of the document of two to eight times the item's size, so that long
    documents don't drown short items: a window shares the least value of one of 64
    hash orders with the item. Wherever the shared shingles lie in the document, an
    item at 80 % is missed with probability 1e-5 at most. For items of under 8 shingles
    the window is one shingle and nothing is missed: their least values would be their
    few shingles themselves, so these are looked up, the rarest ones only. Each
    candidate is verified on all distinct shingles of item and document. The benchmark
    goes out in blocks of about ``block_items`` items and ``block_chars`` characters (a
    longer item makes its block longer), one after the other, each against all
    documents. A task holds a number per item for one document at a time, whatever
    phrases they share. Documents are not shuffled.

    Null or empty texts have no shingles: such documents hold nothing and such items
    are held by nothing. A text of fewer than ``k`` words is its whole sequence as
    one shingle. Repeated rows and equal items are reported each. An empty table on
    either side gives an empty result.
    """
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])

    def find(shared):
        def run(batches):
            index = shared.value
            for b in batches:
                hits = list(index.matches(b.column("text"), k))
                ids = b.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                size = [int(index.sizes[h[1]]) for h in hits]
                yield batch(_PAIR, doc_id=ids, item_id=[index.ids[h[1]] for h in hits], item_shingles=size, shared=[h[2] for h in hits], containment=[h[2] / s for h, s in zip(hits, size, strict=True)])

        return chosen.mapInArrow(lean(run), "doc_id long, item_id long, item_shingles long, shared long, containment double")

    return _by_block(find, *_blocks(benchmark, block_items, block_chars), k, least)


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.8, block_items: int = 8192, block_chars: int = 16 << 20) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; see ``contaminated``.

    Where the benchmark is one block nothing is shuffled. With several, the rows that
    hold an item are found block by block and taken out of the documents at the end.
    """
    items, blocks = _blocks(benchmark, block_items, block_chars)
    if blocks == 1:
        shared = _index(items, 0, k, least)

        def keep(batches):
            for b in batches:
                hit = {row for row, _, _ in shared.value.matches(b.column("text"), k)}
                yield b.take(pa.array([i for i in range(b.num_rows) if i not in hit], pa.int64())) if hit else b

        return docs.mapInArrow(lean(keep), docs.schema)
    row = F.xxhash64(docs["doc_id"], docs["text"])
    chosen = docs.select(row.alias("row"), docs["text"])

    def find(shared):
        def run(batches):
            for b in batches:
                hit = sorted({row for row, _, _ in shared.value.matches(b.column("text"), k)})
                yield batch(_HIT, row=b.column("row").take(pa.array(hit, pa.int64())))

        return chosen.mapInArrow(lean(run), "row long")

    found = _by_block(find, items, blocks, k, least).distinct()
    return docs.join(found, row == found["row"], "left_anti").select(*[docs[c] for c in docs.columns])


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``contaminated`` over all documents and the whole benchmark."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP3_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM t),
s AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
i AS (SELECT id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, x.id AS item_id, any_value(i.n) AS item_shingles, count(*) AS shared, count(*) / any_value(i.n) AS containment
FROM s d JOIN s x ON d.g = x.g AND d.kind = 'd' AND x.kind = 'i' JOIN i ON i.id = x.id
GROUP BY d.id, x.id HAVING count(*) >= 0.8 * any_value(i.n)
"""
