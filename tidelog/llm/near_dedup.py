"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import batch, hot_join, lean, shuffle_width, slices, small_batches, stage_table
from tidelog.llm.graph import components
from tidelog.llm.words import mix, shingles_of, word_blocks

#: Trees of the forest; each begins with four 16-bit hash values of its own.
TREES = 32
#: Trees whose neighbours are compared first in a large cluster.
FIRST_TREES = 4
_MULTIPLIERS = np.random.default_rng(7).integers(0, 2**63, 4 * TREES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.string()), ("sig", pa.list_(pa.int64()))])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("tree", pa.int32()), ("k1", pa.int64())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _sets(column: pa.Array, k: int):
    """The distinct shingle hashes of each row, sorted."""
    for _, _, words in word_blocks(column):
        shingles, offsets = shingles_of(words, k)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            yield np.unique(shingles[a:b])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``TREES`` 64-bit values per non-empty set: four 16-bit MinHash values each."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((len(sets), TREES), np.uint64)
    for p, a in enumerate(_MULTIPLIERS):
        least = np.minimum.reduceat(flat * a, at)
        out[:, p // 4] = out[:, p // 4] << np.uint64(16) | mix(least + np.uint64(p)) >> np.uint64(48)
    return out.view(np.int64)


def _sketch(k: int, together: int = 1 << 16):
    """Sketches of a partition's texts; about ``together`` shingles are signed at once."""

    def run(batches):
        for b in slices(batches, 4 << 20):
            n, keys, sigs, held, at = [], [], [], [], []

            def sign():
                for i, row in zip(at, signatures(held) if held else [], strict=True):
                    sigs[i] = row.tolist()
                held.clear(), at.clear()

            size = 0
            for i, s in enumerate(_sets(b.column("text"), k)):
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                sigs.append(None)
                if len(s):
                    held.append(s), at.append(i)
                    size += len(s)
                if size >= together:
                    sign()
                    size = 0
            sign()
            yield batch(_SKETCH, doc_id=b.column("doc_id"), n=n, set_key=keys, sig=sigs)

    return run


def _shared_depth(k1: np.ndarray, k2: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Leading 16-bit values that each row shares with the next one, up to 8; 0 across trees."""
    depth = np.zeros(max(0, len(k1) - 1), np.int64)
    same = tree[:-1] == tree[1:]
    for k in (k1, k2):
        x = (k[:-1] ^ k[1:]).view(np.uint64)
        for shift in (48, 32, 16, 0):
            same &= x >> np.uint64(shift) == 0
            depth += same
    return depth


def _run_sizes(joined: np.ndarray, before: int) -> np.ndarray:
    """For each gap between rows, the number of rows of the run it lies in (1 where the gap separates); the first run has ``before`` more."""
    edges = np.flatnonzero(np.concatenate([[True], ~joined, [True]]))
    size = np.diff(edges)
    size[0] += before
    return np.repeat(size, np.diff(edges))[: len(joined)]


def _neighbours(cap: int, hold: int = 1 << 20):
    """Links between neighbours of a sorted order whose common prefix is long enough for their region.

    A region is a run of rows that share a prefix. Where at most ``cap`` rows
    share three values, three are enough; in a crowded region four are needed,
    and where more than ``cap`` share four, five. The first and the last row of
    the partition are given out too, so that runs cut by a partition's edge can
    be joined.

    About ``hold`` (more than ``cap``) rows of a run are kept in memory. What is
    given out of a longer run is known to lie in a run of more than ``cap`` rows, and
    so is what follows in it: the links are the same whatever ``hold`` is.
    """
    hold = max(hold, cap + 1)

    def links(node, tree, depth, over3, over4):
        size3, size4 = _run_sizes(depth >= 3, (cap + 1) * over3), _run_sizes(depth >= 4, (cap + 1) * over4)
        take = (depth >= 5) | (depth >= 4) & (size4 <= cap) | (depth >= 3) & (size3 <= cap)
        take &= node[:-1] != node[1:]
        i = np.flatnonzero(take)
        nothing = pa.nulls(len(i))
        return batch(_LINK, a=node[i], b=node[i + 1], part=nothing.cast(pa.int32()), last=nothing.cast(pa.bool_()), tree=tree[i], k1=nothing.cast(pa.int64()))

    def run(batches):
        part, first, row = TaskContext.get().partitionId(), True, None
        held = [np.zeros(0, np.int64) for _ in range(4)]
        over3 = over4 = False  # whether the first row held goes on with a run known to be over the cap
        for b in batches:
            if not b.num_rows:
                continue
            new = [np.asarray(b.column(c), dtype=np.int64) for c in ("tree", "k1", "k2", "node")]
            row = [x[-1] for x in new]
            if first:
                first = False
                yield batch(_LINK, a=[new[3][0]], b=[None], part=[part], last=[False], tree=[new[0][0]], k1=[new[1][0]])
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            depth = _shared_depth(held[1], held[2], held[0])
            cuts = np.flatnonzero(depth < 3)
            if len(cuts):  # whole runs
                cut = cuts[-1] + 1
                yield links(held[3][:cut], held[0], depth[: cut - 1], over3, over4)
                held, depth, over3, over4 = [x[cut:] for x in held], depth[cut:], False, False
            if len(held[0]) > hold:  # one run of more than ``cap`` rows
                over3, cuts = True, np.flatnonzero(depth < 4)
                if len(cuts):
                    cut = cuts[-1] + 1
                    yield links(held[3][:cut], held[0], depth[: cut - 1], over3, over4)
                    held, depth, over4 = [x[cut:] for x in held], depth[cut:], False
                if len(held[0]) > hold:
                    over4 = True
                    yield links(held[3], held[0], depth, over3, over4)
                    held = [x[-1:] for x in held]
        if row is not None:
            yield links(held[3], held[0], _shared_depth(held[1], held[2], held[0]), over3, over4)
            yield batch(_LINK, a=[row[3]], b=[None], part=[part], last=[True], tree=[row[0]], k1=[row[1]])

    return run


def candidate_links(nodes: DataFrame, cap: int = 64) -> DataFrame:
    """Edges ``a, b`` between neighbours in each ``tree``'s sorted order of ``nodes`` (``node``, ``sig``)."""
    turn = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.get("sig", t).alias("k1"), F.get("sig", F.pmod(t + 1, F.lit(TREES))).alias("k2")))
    rows = nodes.select("node", F.explode(turn).alias("t")).select("node", "t.*")
    ordered = rows.repartitionByRange(shuffle_width(nodes.sparkSession), "tree", "k1", "k2", "node").sortWithinPartitions("tree", "k1", "k2", "node")
    found = stage_table(ordered.mapInArrow(lean(_neighbours(cap)), "a long, b long, part int, last boolean, tree int, k1 long"), "forest-links")
    ends = found.where("part IS NOT NULL")  # two rows per partition
    after = ends.where("NOT last").alias("y")
    before = ends.where("last").alias("x")
    order = ends.select("part").distinct().selectExpr("part", "lead(part) OVER (ORDER BY part) AS following")
    joined = before.join(order, "part").join(after.withColumnRenamed("part", "following"), "following")
    cut = joined.where("x.tree = y.tree AND shiftright(x.k1, 16) = shiftright(y.k1, 16)").select(F.col("x.a").alias("a"), F.col("y.a").alias("b"), F.col("x.tree").alias("tree"))
    return found.where("part IS NULL").select("a", "b", "tree").unionByName(cut)


def _text_sets(k: int):
    schema = pa.schema([("node", pa.int64()), ("items", pa.binary())])

    def run(batches):
        for b in slices(batches, 4 << 20):
            yield batch(schema, node=b.column("node"), items=[s.tobytes() for s in _sets(b.column("text"), k)])

    return run


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    inter = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * inter >= percent * (len(x) + len(y) - inter) and inter > 0


def similar_links(nodes: list[int], component: list[int], block: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what pairs of at least ``percent`` % similarity connect, beyond the components known before.

    Where two blocks meet, only pairs across them are looked at. Two such sets share
    one of their rarest items: with the items of each set in order of their frequency,
    one of the first ``size - least overlap + 1`` is common. Only these meet in posting
    lists, so that what very many sets share makes no pairs. A pair of one component is
    passed over; the others whose sizes allow it are compared on the full sets.
    """
    if len(sets) == 2:
        return [(nodes[0], nodes[1])] if component[0] != component[1] and _alike(*sets, percent) else []
    n, size, blocks = len(sets), np.array([len(s) for s in sets]), np.array(block)
    owner = np.repeat(np.arange(n), size)
    _, term, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    term = term[np.lexsort((term, df[term], owner))]
    place = np.arange(len(term)) - np.repeat(np.cumsum(size) - size, size)
    use = (place <= np.repeat(size + -percent * size // 100, size)) & (df[term] > 1)
    owner, term = owner[use], term[use]
    by_term = np.argsort(term, kind="stable")
    postings, start = owner[by_term], np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(df)))])
    own_at = np.searchsorted(owner, np.arange(n + 1))
    root = np.unique(np.array(component), return_inverse=True)[1]
    members = {}
    for i, r in enumerate(root.tolist()):
        members.setdefault(r, []).append(i)
    two, out = len(set(block)) > 1, []
    for x in range(n):
        mine = term[own_at[x] : own_at[x + 1]]
        if not len(mine) or len(members) == 1:
            continue
        met = np.unique(np.concatenate([postings[start[t] : start[t + 1]] for t in mine]))
        met = met[(met > x) & (root[met] != root[x])]
        met = met[(100 * size[met] >= percent * size[x]) & (100 * size[x] >= percent * size[met])]
        for y in (met[blocks[met] != blocks[x]] if two else met).tolist():
            if root[x] != root[y] and _alike(sets[x], sets[y], percent):
                out.append((nodes[x], nodes[y]))
                few, many = sorted((root[x], root[y]), key=lambda r: len(members[r]))
                root[members[few]] = many
                members[many] += members.pop(few)
    return out


def _confirm(percent: int):
    def run(batches):
        key, group, out = None, [], []

        def close():
            if len(group) > 1:
                nodes, components_, block, items = zip(*group, strict=True)
                out.extend(similar_links(nodes, components_, block, [np.frombuffer(x, np.uint64) for x in items], percent))

        for b in batches:
            for i, j, *row in zip(*(b.column(c).to_pylist() for c in ("i", "j", "node", "component", "block", "items")), strict=True):
                if (i, j) != key:
                    close()
                    key, group = (i, j), []
                group.append(row)
            if len(out) > 20_000:
                yield batch(_EDGE, a=[e[0] for e in out], b=[e[1] for e in out])
                out = []
        close()
        yield batch(_EDGE, a=[e[0] for e in out], b=[e[1] for e in out])

    return run


def _verify(percent: int):
    """The links of a batch whose two sets are alike."""

    def run(batches):
        for b in batches:
            pairs = zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)
            ok = pa.array([_alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in pairs], pa.bool_())
            yield batch(_EDGE, a=b.column("a").filter(ok), b=b.column("b").filter(ok))

    return run


def _first_links(candidates: DataFrame, large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between neighbours of the first trees in ``large`` clusters. No node has more than two neighbours in a tree."""
    pairs = candidates.where(F.col("tree") < FIRST_TREES).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.join(large.select(F.col("node").alias("a")), "a", "left_semi")
    one, two = sets.select(F.col("node").alias("a"), F.col("items").alias("x")), sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(lean(_verify(percent)), "a long, b long")


def _block_pairs(large: DataFrame, total: int, block_shingles: int, block_sets: int) -> DataFrame:
    """``i, j, node, component, block``: the sets of each pair of blocks that may hold a new link.

    ``large`` has ``node, n, label, component``. A cluster that is one component is
    done. The others are dealt into blocks of sets of like size; a component of more
    than ``block_sets`` sets has blocks of its own. Two blocks are compared unless
    their sizes rule out a link or both belong to the same one component.

    Rows are written after each of the joins with their own sums. Such a join reads its
    rows three times: one plan of them all would hold the first ones 27 times.
    """
    stats = large.groupBy("label").agg(F.count("*").alias("n_left"), (F.min("component") < F.max("component")).alias("open"))
    rows = stage_table(hot_join(large, stats, "label", total).where("open").drop("open"), "near-open")
    sizes = rows.groupBy("component").agg(F.count("*").alias("n_left"), F.count("*").alias("members"))
    rows = stage_table(hot_join(rows, sizes, "component", total), "near-of-size")
    own = F.when(F.col("members") > block_sets, F.col("component"))
    rows = rows.withColumn("scale", F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int")).withColumn("kind", F.xxhash64("label", "scale", own)).drop("members")
    parts = F.greatest(F.ceil(F.sum("n") / block_shingles), F.ceil(F.count("*") / F.greatest(F.lit(block_sets), F.least(F.lit(32 * block_sets), F.count("*") / 32))))
    rows = hot_join(rows, rows.groupBy("kind").agg(F.count("*").alias("n_left"), parts.cast("long").alias("parts")), "kind", total)
    rows = stage_table(rows.withColumn("block", F.xxhash64("kind", F.pmod(F.xxhash64("node"), "parts"))), "near-blocks")
    blocks = rows.groupBy("block").agg(F.min("label").alias("label"), F.min("scale").alias("scale"), F.min("component").alias("low"), F.max("component").alias("high"))
    met = blocks.alias("x").join(blocks.alias("y"), F.expr("x.label = y.label AND x.block <= y.block AND abs(x.scale - y.scale) <= 1 AND NOT (x.low = x.high AND y.low = y.high AND x.low = y.low)"))
    met = met.select(F.col("x.block").alias("i"), F.col("y.block").alias("j")).withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    return rows.join(met, "block").select("i", "j", "node", "component", "block")


def _same_id_links(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` of each id that has texts of several classes to those classes' nodes."""
    texts = linked.groupBy("doc_id", "set_key").agg(F.count("*").alias("rows"))
    several = texts.groupBy("doc_id").agg(F.count("*").alias("n_left")).where("n_left > 1")
    several = stage_table(several.select("doc_id", "n_left", F.lit(True).alias("several")), "near-repeated-ids")
    total = several.agg(F.coalesce(F.sum("n_left"), F.lit(0))).first()[0]
    if not total:
        return linked.sparkSession.createDataFrame([], "a long, b long")
    texts = stage_table(hot_join(texts.drop("rows"), several, "doc_id", total).where("several").select("doc_id", "set_key"), "near-repeated-texts")
    nodes = texts.groupBy("set_key").agg(F.count("*").alias("n_left")).join(classes.select("set_key", "node"), "set_key")
    return hot_join(texts, nodes, "set_key", total).select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, cap: int = 64, block_shingles: int = 1 << 20, block_sets: int = 128) -> DataFrame:
    """Components of documents linked where their sets of ``k``-word shingles are at least ``percent`` % similar (Jaccard).

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored.
    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``.

    1. Every whole text becomes its set of shingles, a digest of the set and 128
       MinHash values in 32 trees. Documents of one set form a class.
    2. The classes are sorted once per tree by their values. Neighbours with a
       common prefix of three to five values, by how crowded their region is, are
       candidates; they connect to clusters. A pair at 80 % is in no common cluster
       with probability 1.5e-5 in the most crowded regions (a tree's fifth value is the
       next tree's first) and 5e-8 where four values are enough.
    3. In a cluster of more than ``block_sets`` sets the neighbours in the first four
       trees are compared, which connects most of it, at a few set reads per set.
    4. Every pair of a cluster that isn't connected yet is compared on the full sets:
       small clusters whole, large ones block against block, each pair of blocks a
       row group of its own of at most about 2 * ``block_shingles`` shingles.
    5. Confirmed links connect to components.

    A text without words (null, empty, blank) has no shingles and is a component of
    its own; a row without ``doc_id`` too, with null component. Repeated ids count
    as one document that has the links of all its rows, and link their classes. Ties and repeated texts
    have the smallest id as component. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    sketch = stage_table(chosen.mapInArrow(lean(_sketch(k)), "doc_id long, n long, set_key string, sig array<long>"), "near-sketch")
    linked = sketch.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage_table(linked.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count("*").alias("n_left")), "near-classes")
    nodes = linked.join(classes, (linked["set_key"] == classes["set_key"]) & (linked["doc_id"] == classes["node"])).select("node", "n", "sig")
    candidates = candidate_links(nodes, cap)

    sized = nodes.groupBy("node").agg(F.sum("n").alias("n")).join(components(candidates, "near-clusters"), "node").withColumnRenamed("component", "label")
    sized = stage_table(sized, "near-sized")
    total = sized.count()
    per_cluster = sized.groupBy("label").agg(F.count("*").alias("n_left"), ((F.count("*") > block_sets) | (F.sum("n") > block_shingles)).alias("large"))
    clusters = stage_table(hot_join(sized, per_cluster, "label", total), "near-cluster-of")
    texts = chosen.join(clusters.select("node"), chosen["doc_id"] == F.col("node")).select("node", "text")
    sets = stage_table(texts.mapInArrow(lean(_text_sets(k)), "node long, items binary"), "near-sets")

    large = clusters.where("large").drop("large")
    first = stage_table(_first_links(candidates, large, sets, percent), "near-first-links")
    known = components(first, "near-first")
    large = stage_table(large.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")), "near-large")
    small = clusters.where("NOT large").select(F.col("label").alias("i"), F.col("label").alias("j"), "node", F.col("node").alias("component"), F.col("label").alias("block"))
    rows = small.unionByName(_block_pairs(large, total, block_shingles, block_sets)).join(sets, "node")
    # Written before they are connected: a task that ran both steps would hold two Python workers.
    links = stage_table(rows.repartition(shuffle_width(docs.sparkSession), "i", "j").sortWithinPartitions("i", "j", "node").mapInArrow(lean(_confirm(percent)), "a long, b long"), "near-confirmed")
    links = known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links).unionByName(_same_id_links(linked, classes))
    found = components(links, "near-links")

    named = classes.join(found, "node", "left").select("set_key", "n_left", F.coalesce("component", "node").alias("component_id"))
    same_id = hot_join(linked.select("doc_id", "n", "set_key"), named, "set_key", linked.count())
    alone = sketch.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = same_id.select("doc_id", "n", "component_id").unionByName(alone)
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, one row of each component, with all their columns.

    Of rows of one id, repeated or not, the one whose text's hash is least stays; they
    meet after each task has chosen among its own. Rows without ``doc_id`` all stay.
    Columns may have any names.
    """
    kept = near_groups(docs, **options).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("hash"))
    one = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min_by("doc", "hash").alias("doc")).join(kept, "doc_id", "left_semi")
    return one.select("doc").unionByName(rows.where("doc_id IS NULL").select("doc")).select("doc.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_groups`` of all documents by four-word shingles."""
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
