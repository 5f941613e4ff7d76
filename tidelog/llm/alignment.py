"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, B a
``sentencepiece`` model; A reads a space and the text, B adds that space itself. The
tokens of a batch stand one after another on one line of bytes, and
``pandas.merge_asof``, keyed by document, finds for each token start the other side's
token that covers it; both directions together give all overlaps. Where two tokens
end together they are linked, and their common ends cut a document into groups.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import batch, lean, read_table, slices, small_batches, stage_table

#: Folder of the vocabulary files; a parameter of every function here.
TOKENIZERS = "/opt/tokenizers"

#: Fixed value: the split that byte-level BPE files of this kind ask for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A single space between two characters that aren't white space: no token of either tokenizer reaches across its left side.
_CUT = re.compile(r"(?<=\S) (?=\S)")

_ID_BITS = 20  # of a token id within a pair's number
_SHORT, _LATIN = 400, "ɐ"


def _byte_of_character() -> dict[str, int]:
    """The characters that byte-level BPE writes for bytes: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, read from the bytes of their files, with each id's bytes and its decimal digits."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        spec = json.loads(a_file)
        vocab, of = spec["model"]["vocab"], _byte_of_character()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        text = {i: bytes(of[c] for c in t) for t, i in vocab.items() if t not in added} | {i: t.encode() for t, i in added.items()}
        self.a_bytes = [text.get(i, b"") for i in range(max(text) + 1)]
        # Where merges are in the order of the ids, ranks give the same tokens in a third of the time.
        ranks = {text[i]: i for t, i in vocab.items() if t not in added}
        order = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if order == sorted(order) and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["normalizer"] is None else None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.b_bytes = [piece(i) for i in range(self.b.get_piece_size())]
        self.inner_space = any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = np.zeros((n, len(str(n)) + 1), np.uint8)
        self.n_digits = np.array([len(str(i)) for i in range(n)])
        for i in range(n):
            self.digits[i, : self.n_digits[i]] = np.frombuffer(str(i).encode(), np.uint8)

    @cached_property
    def a_sizes(self) -> np.ndarray:
        return np.array([len(x) for x in self.a_bytes], np.int64)

    @cached_property
    def b_sizes(self) -> np.ndarray:
        return np.array([len(x) for x in self.b_bytes], np.int64)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text. Short Latin texts go by ranks, for which a test shows equal ids; all others by the file's own library."""
        out: list = [None] * len(texts)
        slow = []
        for i, t in enumerate(texts):
            if self.fast is not None and len(t) < _SHORT and (t.isascii() or max(t) < _LATIN):
                out[i] = self.fast.encode_ordinary(" " + t)
            else:
                slow.append(i)
        for i, e in zip(slow, self.a.encode_batch([" " + texts[i] for i in slow], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1) if texts else []


@dataclass
class Side:
    """Tokens of all texts of a block: text number, id, first byte and end on the common line."""

    doc: np.ndarray
    id: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _side(stretch: np.ndarray, doc: np.ndarray, ids: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> Side:
    n = np.diff(offsets)[stretch]
    before = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(offsets[stretch] - before, n)
    own = ids[at]
    end = np.cumsum(sizes[own])
    return Side(np.repeat(doc, n), own, end - sizes[own], end)


class Lexicon:
    """Stretches already encoded, numbered in order of their first use, with both sides' ids. A worker keeps it from block to block and starts anew beyond ``most`` ids."""

    def __init__(self, tokenizers: Tokenizers, most: int = 3_000_000):
        self.tokenizers, self.most = tokenizers, most
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.a = self.b = (np.zeros(0, np.int64), np.zeros(1, np.int64))

    def codes(self, texts: list[str]) -> np.ndarray:
        known = self.known
        n = len(known)
        out = np.array([known.setdefault(t, len(known)) for t in texts], np.int64)
        if len(known) > n:
            self._add(list(known)[n:])
        return out

    def _add(self, fresh: list[str]) -> None:
        t = self.tokenizers
        a, b = t.encode_a(fresh), t.encode_b(fresh)
        whole = lambda ids, table: b"".join([table[i] for i in ids])
        restored = lambda s, x, y: whole(y, t.b_bytes) == s and (t.fast is not None or whole(x, t.a_bytes) == s)  # noqa: E731 (ranks cover all bytes, and merges keep them)
        good = [restored(b" " + s.encode(), x, y) for s, x, y in zip(fresh, a, b, strict=True)]
        self.good = np.concatenate([self.good, np.array(good, bool)])
        self.a, self.b = _extended(self.a, a), _extended(self.b, b)


def _extended(flat: tuple[np.ndarray, np.ndarray], ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in ids], np.int64)
    return np.concatenate([flat[0], np.array(list(chain.from_iterable(ids)), np.int64)]), np.concatenate([flat[1], flat[1][-1] + np.cumsum(sizes)])


def encode_block(texts: list[str | None], lexicon: Lexicon) -> tuple[Side, Side]:
    """Both sides' tokens of a block of texts.

    Texts are cut at single spaces, where neither tokenizer has a token across, and
    each different stretch is encoded once. A text of which a stretch's joined bytes
    aren't its own, on either side, has no tokens, nor has a null or empty one.
    """
    t = lexicon.tokenizers
    if len(lexicon.a[0]) + len(lexicon.b[0]) > lexicon.most:
        lexicon.clear()
    parts = [([x] if t.inner_space else _CUT.split(x)) if x else [] for x in texts]
    code = lexicon.codes(list(chain.from_iterable(parts)))
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    keep = np.ones(len(texts), bool)
    keep[doc[~lexicon.good[code]]] = False
    code, doc = code[keep[doc]], doc[keep[doc]]
    return _side(code, doc, *lexicon.a, t.a_sizes), _side(code, doc, *lexicon.b, t.b_sizes)


def overlaps(a: Side, b: Side) -> pd.DataFrame:
    """All pairs of tokens that share a byte, as positions ``a``, ``b`` in the sides; ``together`` where both end there."""
    left = pd.DataFrame({"doc": a.doc, "start": a.start, "a": np.arange(len(a.id))})
    right = pd.DataFrame({"doc": b.doc, "start": b.start, "b": np.arange(len(b.id))})
    of_a = pd.merge_asof(left, right, on="start", by="doc")[["a", "b"]]
    of_b = pd.merge_asof(right, left, on="start", by="doc")[["a", "b"]]
    of_b = of_b[a.start[of_b["a"].to_numpy()] != b.start[of_b["b"].to_numpy()]]  # equal starts are found from both sides
    pairs = pd.concat([of_a, of_b], ignore_index=True)
    return pairs.assign(together=a.end[pairs["a"].to_numpy()] == b.end[pairs["b"].to_numpy()])


def _groups_text(a: Side, b: Side, a_last: np.ndarray, b_last: np.ndarray, tokenizers: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;...`` of all texts as bytes, each followed by one more separator, and for each token in their order its number of bytes."""
    ga, gb = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    n_groups = int(a_last.sum())
    in_a, in_b = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    at_a = np.arange(len(ga)) + (np.cumsum(in_b) - in_b)[ga]
    at_b = np.arange(len(gb)) + np.cumsum(in_a)[gb]
    n = len(ga) + len(gb)
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[at_a], ids[at_b] = a.id, b.id
    mark[at_a[a_last]], mark[at_b[b_last]] = ord("|"), ord(";")
    cells, size = tokenizers.digits[ids], tokenizers.n_digits[ids]
    cells[np.arange(n), size] = mark
    return cells[np.arange(cells.shape[1]) <= size[:, None]], size + 1


def align_block(texts: list[str | None], lexicon: Lexicon) -> dict:
    """A block's digests by text, and its links as sorted ``text number, pair number`` with counts."""
    n = len(texts)
    a, b = encode_block(texts, lexicon)
    found = overlaps(a, b)
    links = found[found["together"]]
    la, lb = links["a"].to_numpy(), links["b"].to_numpy()
    a_last, b_last = np.zeros(len(a.id), bool), np.zeros(len(b.id), bool)
    a_last[la], b_last[lb] = True, True
    count = lambda doc: np.bincount(doc, minlength=n)
    n_a, n_b, n_links = count(a.doc), count(b.doc), count(a.doc[la])
    flat, sizes = _groups_text(a, b, a_last, b_last, lexicon.tokenizers)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(n_a + n_b)]
    data, start, sha = flat.tobytes(), 0, []
    for end, tokens in zip(ends.tolist(), n_a.tolist(), strict=True):
        sha.append(hashlib.sha256(data[start : end - 1]).hexdigest() if tokens else "")
        start = end
    key = a.doc[la] << (2 * _ID_BITS) | b.id[lb] << _ID_BITS | a.id[la]
    key, times = np.unique(key, return_counts=True)
    cuts = np.searchsorted(key, np.arange(n + 1) << (2 * _ID_BITS))
    return {"n_a": n_a, "n_b": n_b, "n_groups": count(a.doc[a_last]), "n_links": n_links, "groups_sha256": sha, "pair": key & ((1 << 2 * _ID_BITS) - 1), "times": times, "cuts": cuts}


_held: dict[tuple, Lexicon] = {}


def _loaded(files: tuple[bytes, bytes]) -> Lexicon:
    """One object a worker process for the same files."""
    key = tuple(hashlib.md5(f).digest() for f in files)
    if key not in _held:
        _held.clear()
        _held[key] = Lexicon(Tokenizers(*files))
    return _held[key]


def _files(spark: SparkSession, folder: str, a: str, b: str):
    """Both vocabulary files, a few MB whatever the data, broadcast: executors need no copy of the folder."""
    read = lambda name: open(f"{folder}/{name}", "rb").read()  # noqa: E731, SIM115
    return spark.sparkContext.broadcast((read(a), read(b)))


def token_overlaps(docs: DataFrame, folder: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", block_bytes: int = 1 << 20) -> DataFrame:
    """Every overlap of an A and a B token: ``doc_id``, both tokens' positions ``a_at, b_at`` in the text and ids, their shared bytes ``start, end`` (of the space and the text), ``together`` where both end there, and the number of their ``groups_before``.

    Texts that are null, empty or not restored by both tokenizers give no rows;
    repeated rows give theirs each; an empty table none.
    """
    small_batches(docs.sparkSession)
    files = _files(docs.sparkSession, folder, a, b)
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("a_at", "b_at", "a_id", "b_id", "start", "end")], ("together", pa.bool_()), ("groups_before", pa.int64())])

    def run(batches):
        lexicon = _loaded(files.value)
        for x in slices(batches, block_bytes):
            left, right = encode_block(x.column("text").to_pylist(), lexicon)
            found = overlaps(left, right)
            ia, ib = found["a"].to_numpy(), found["b"].to_numpy()
            first = lambda side: np.searchsorted(side.doc, side.doc)
            base = left.start[first(left)]
            last = np.zeros(len(left.id), bool)
            last[ia[found["together"].to_numpy()]] = True
            before = np.cumsum(last) - last
            yield batch(
                schema, doc_id=x.column("doc_id").take(pa.array(left.doc[ia])), a_at=ia - first(left)[ia], b_at=ib - first(right)[ib], a_id=left.id[ia], b_id=right.id[ib],
                start=np.maximum(left.start[ia], right.start[ib]) - base[ia], end=np.minimum(left.end[ia], right.end[ib]) - base[ia], together=found["together"].to_numpy(), groups_before=before[ia] - before[first(left)][ia],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), "doc_id long, a_at long, b_at long, a_id long, b_id long, start long, end long, together boolean, groups_before long")


_ROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("pair", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])


def aligned(docs: DataFrame, folder: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", block_bytes: int = 1 << 20) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256``, and its linked id pairs as ``pair`` (the B id above the A id's 20 bits) with their ``times``."""
    small_batches(docs.sparkSession)
    files = _files(docs.sparkSession, folder, a, b)

    def run(batches):
        lexicon = _loaded(files.value)
        for x in slices(batches, block_bytes):
            made = align_block(x.column("text").to_pylist(), lexicon)
            cuts = pa.array(made.pop("cuts"), pa.int32())
            made["pair"] = pa.ListArray.from_arrays(cuts, pa.array(made["pair"], pa.int64()))
            made["times"] = pa.ListArray.from_arrays(cuts, pa.array(made["times"], pa.int32()))
            yield batch(_ROW, doc_id=x.column("doc_id"), **made)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, times array<int>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best`` from the rows of ``aligned``: how many links of the corpus hold the pair, and whether no pair of its B id has more.

    A B id has as many pairs as A has ids, at most, which bounds the window.
    """
    counts = rows.select(F.explode(F.arrays_zip("pair", "times")).alias("p")).groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.times").alias("count"))
    most = counts.groupBy(F.shiftright("pair", _ID_BITS).alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", F.shiftright("pair", _ID_BITS)).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, most: int = 1 << 18, **files) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): tokens, groups, links and the corpus-wide counts of its linked pairs.

    Texts are encoded once, into a table in the shared folder. Pairs that more than
    one in ``most`` links hold, so fewer than ``most`` of them whatever the data, are
    broadcast; the rest meet their counts in a shuffle, in which no pair has more
    than that share. Null and empty texts, and those that a tokenizer doesn't
    restore, have zeros and an empty digest. Repeated rows and ids give a row each
    and count as often; an empty table gives none; other columns are ignored.
    """
    rows = stage_table(aligned(docs, **files).withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    counts = stage_table(pair_counts(rows), "alignment-pairs")
    total = rows.agg(F.coalesce(F.sum("n_links"), F.lit(0))).first()[0]
    frequent = F.broadcast(counts.where(F.col("count") * most > total))
    pairs = rows.select("row", F.explode(F.arrays_zip("pair", "times")).alias("p")).select("row", F.col("p.pair").alias("pair"), F.col("p.times").cast("long").alias("times"))
    summed = lambda df: df.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    often = summed(pairs.join(frequent, "pair"))
    rarely = summed(pairs.join(frequent.select("pair"), "pair", "left_anti").join(counts.where(F.col("count") * most <= total), "pair"))
    sums = often.unionByName(rarely).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``alignment`` of all documents."""
    return alignment(read_table(spark, sf_dir, "documents"))
