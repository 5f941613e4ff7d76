"""Exact duplicates by an extendible-hash index on shared files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import batch, shuffle_width, stage_table

#: Deleted from a text before comparing: space, and tab to carriage return.
WHITESPACE = " \t\n\x0b\x0c\r"

_ENTRY = pa.schema([("h", pa.int64()), ("sha", pa.string()), ("norm", pa.string()), ("n", pa.int64()), ("best_cp", pa.int64()), ("best_id", pa.int64()), ("best_pos", pa.int32()), ("members", pa.list_(pa.int64()))])
_ENTRY_SQL = "h long, sha string, norm string, n long, best_cp long, best_id long, best_pos int, members array<long>"
_OWNED = pa.schema([("gid", pa.int64()), ("keep_gid", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _better(cp_a, id_a, cp_b, id_b) -> bool:
    """Whether a stays rather than b: more code points, then the smaller id, a null id last."""
    if cp_a != cp_b:
        return cp_a > cp_b
    return id_b is None and id_a is not None or (id_a is not None and id_b is not None and id_a < id_b)


def _combine(flush_bytes: int):
    """Entries of equal texts within a task become one, so that a very frequent text leaves each task once."""

    def flush(entries: dict) -> pa.RecordBatch:
        rows = list(entries.items())
        return batch(_ENTRY, h=[e[0] for _, e in rows], sha=[e[1] for _, e in rows], norm=[x for x, _ in rows], n=[len(e[5]) for _, e in rows], best_cp=[e[2] for _, e in rows], best_id=[e[3] for _, e in rows], best_pos=[e[4] for _, e in rows], members=[e[5] for _, e in rows])

    def run(batches):
        entries, held = {}, 0
        for b in batches:
            for doc_id, cp, norm, sha, h in zip(*(b.column(c).to_pylist() for c in ("doc_id", "cp", "norm", "sha", "h")), strict=True):
                e = entries.get(norm)
                if e is None:
                    entries[norm] = [h, sha, cp, doc_id, 0, [doc_id]]
                    held += norm.__sizeof__() + 300
                else:
                    if _better(cp, doc_id, e[2], e[3]):
                        e[2], e[3], e[4] = cp, doc_id, len(e[5])
                    e[5].append(doc_id)
                    held += 8
                if held >= flush_bytes:
                    yield flush(entries)
                    entries, held = {}, 0
        if entries:
            yield flush(entries)

    return run


def build_directory(counts: dict[int, int], cell_depth: int, capacity: int) -> tuple[int, list[int], list[int]]:
    """Grow the directory: split each overfull bucket by its next hash bit, doubling the directory where needed.

    ``counts`` has the entries by the first ``cell_depth`` hash bits. Returns the
    global depth, the bucket of each directory slot, and the entries of each
    bucket; buckets are numbered in hash order. A bucket that is overfull at
    ``cell_depth`` stays whole: its owner chains what it holds.
    """
    cells = [0] * (1 << cell_depth)
    for cell, n in counts.items():
        cells[cell] += n
    running = [0]
    for n in cells:
        running.append(running[-1] + n)
    done, depth = [], 0
    waiting = [(0, 0)]  # local depth, prefix
    while waiting:
        local, prefix = waiting.pop()
        width = cell_depth - local
        held = running[(prefix + 1) << width] - running[prefix << width]
        if held > capacity and local < cell_depth:
            depth = max(depth, local + 1)  # the directory doubles when a bucket outgrows it
            waiting += [(local + 1, 2 * prefix + 1), (local + 1, 2 * prefix)]
        else:
            done.append((local, prefix, held))
    slots, sizes = [], []
    for k, (local, _, held) in enumerate(done):
        slots += [k] * (1 << (depth - local))
        sizes.append(held)
    return depth, slots, sizes


def _owners(sizes: list[int], tasks: int) -> list[int]:
    """Consecutive buckets, so a range of keys, for each owner task, with about equal entries."""
    total, seen, owner = sum(sizes) or 1, 0, []
    for n in sizes:
        owner.append(min(tasks - 1, seen * tasks // total))
        seen += n
    return owner


def _own(batches):
    """Rows come sorted by bucket and hash. Texts of one hash form a chain, and bytes decide which are equal."""
    h, chain = None, []  # of [norm, gids, n, cp, id, gid of the best]

    def close():
        for _, gids, n, _, best_id, best_gid in chain:
            for gid in gids:
                out.append((gid, best_gid, best_id, n))

    def emit():
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return batch(_OWNED, gid=columns[0], keep_gid=columns[1], keep_id=columns[2], group_size=columns[3])

    out: list[tuple] = []
    for b in batches:
        for gid, hash_, norm, n, cp, doc_id in zip(*(b.column(c).to_pylist() for c in ("gid", "h", "norm", "n", "best_cp", "best_id")), strict=True):
            if hash_ != h:
                close()
                h, chain = hash_, []
            for link in chain:
                if link[0] == norm:
                    link[1].append(gid)
                    link[2] += n
                    if _better(cp, doc_id, link[3], link[4]):
                        link[3:] = [cp, doc_id, gid]
                    break
            else:
                chain.append([norm, [gid], n, cp, doc_id, gid])
        if len(out) >= 50_000:
            yield emit()
            out = []
    close()
    yield emit()


def exact_groups(docs: DataFrame, capacity: int = 2_048, max_depth: int = 16, flush_bytes: int = 32 << 20) -> DataFrame:
    """Group the documents whose texts are equal once whitespace is deleted.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored, so
    they may have any names. Returns one row per input row: ``doc_id``,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. The row with the most
    code points in its original text stays, then the smallest ``doc_id``.

    1. Each task merges equal texts and writes index entries (hash, digest,
       normalised text, members) to files in the shared folder.
    2. The number of entries by hash prefix (at most ``2**max_depth`` numbers)
       grows an extendible directory: a bucket with more than ``capacity``
       entries is split by its next bit, doubling the directory where needed.
    3. Owner tasks take consecutive buckets, sort them by hash, chain the texts
       of a hash, and compare their bytes.

    Null text counts as empty, and all empty or blank texts form one group. A
    null ``doc_id`` comes last in ties. Of repeated rows one is kept. An empty
    table gives an empty result. A very long text is one entry.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit(""))
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("cp"), F.translate(text, WHITESPACE, "").alias("norm"))
    keyed = keyed.select("doc_id", "cp", "norm", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("h"))
    pages = stage_table(keyed.mapInArrow(_combine(flush_bytes), _ENTRY_SQL).withColumn("gid", F.monotonically_increasing_id()), "exact-index")

    cell = F.shiftrightunsigned("h", 64 - max_depth)
    counts = {r["cell"]: r["n"] for r in pages.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}  # at most 2 ** max_depth rows
    depth, slots, sizes = build_directory(counts, max_depth, capacity)
    tasks = shuffle_width(spark)
    owner = _owners(sizes, tasks)
    schema = T.StructType([T.StructField("slot", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("owner", T.IntegerType())])
    directory = spark.createDataFrame([(s, k, owner[k]) for s, k in enumerate(slots)], schema)
    slot = F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")
    routed = pages.select("gid", "h", "norm", "n", "best_cp", "best_id").withColumn("slot", slot).join(F.broadcast(directory), "slot")  # 2 ** max_depth slots at most
    owned = routed.repartitionById(tasks, F.col("owner")).sortWithinPartitions("bucket", "h").mapInArrow(_own, "gid long, keep_gid long, keep_id long, group_size long")
    members = pages.select("gid", "sha", "best_pos", "members").join(owned, "gid")
    return members.select("*", F.posexplode("members").alias("pos", "doc_id")).select(
        "doc_id", "keep_id", "group_size", ((F.col("gid") == F.col("keep_gid")) & (F.col("pos") == F.col("best_pos"))).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated ids, one row per kept id and text. Columns may have any names."""
    kept = exact_groups(docs, **options).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    sha = F.sha2(F.translate(F.coalesce(docs["text"], F.lit("")), WHITESPACE, ""), 256)
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].cast("long").alias("doc_id"), sha.alias("own"), F.char_length(docs["text"]).alias("cp"))
    joined = own.join(kept, own["doc_id"].eqNullSafe(kept["id"]) & (own["own"] == kept["sha"]), "left_semi")
    return joined.groupBy("doc_id", "own").agg(F.max_by("doc", F.coalesce("cp", F.lit(0))).alias("doc")).select("doc.*")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``exact_groups`` of all documents."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY cp DESC, doc_id)
"""
