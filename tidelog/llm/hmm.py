"""A hidden Markov language model: Baum-Welch over the whole training corpus, exact likelihoods by scaled forward recursion."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import batch, crc_bucket, slices, stage_table
from tidelog.llm.words import mix, word_blocks

#: Hidden states; words with emissions of their own; classes (by ending) that share the other words.
STATES, FREQUENT, CLASSES = 6, 1 << 15, 256
#: Tokens that are worked off in one go; what is known at a segment's ends carries over to its neighbours.
SEGMENT = 256
#: The end token, counted with the words under a hash of its own.
END = np.uint64(0xE4D0F7E87)
_SLOTS = 20
_COUNT = pa.schema([("h", pa.int64()), ("cls", pa.int32()), ("n", pa.int64())])
_SYMBOLS = pa.schema([("symbols", pa.binary())])
_SUM = pa.schema([("symbol", pa.int32()), *[(f"s{k}", pa.float64()) for k in range(STATES)]])


def _classes(words) -> np.ndarray:
    return (mix(words.tail.astype(np.uint64)) >> np.uint64(56)).astype(np.int32)


@dataclass
class Vocabulary:
    """The words with emissions of their own, and what the corpus counts say of them and of the classes.

    Symbols: the frequent words in hash order, then the end token, then the classes.
    """

    hashes: np.ndarray
    counts: np.ndarray
    end: int
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    def __post_init__(self):
        slot = (self.hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)
        self.slots = np.full(1 << _SLOTS, -1, np.int32)
        self.slots[slot] = np.arange(len(slot))
        self.shared = np.bincount(slot, minlength=1 << _SLOTS) > 1

    @property
    def size(self) -> int:
        return len(self.hashes) + 1 + CLASSES

    def symbols(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The symbol of each word: its own if it is frequent, else its class's."""
        out = (classes + len(self.hashes) + 1).astype(np.int32)
        slot = (hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)
        at = self.slots[slot]
        some = np.flatnonzero(at >= 0)
        at = at[some]
        many = np.flatnonzero(self.shared[slot[some]])
        at[many] = np.minimum(np.searchsorted(self.hashes, hashes[some[many]]), len(self.hashes) - 1)
        ok = self.hashes[at] == hashes[some]
        out[some[ok]] = at[ok]
        return out

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _count_words(batches):
    """The counts of a task's words: counted in slices, added up, and given out whenever about 2 million words are held."""
    held, size, texts = [], 0, 0

    def added():
        h, cls, n = (np.concatenate([p[k] for p in held]) for k in range(3))
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])) if len(h) else np.zeros(0, np.int64)
        return h[order][first], cls[order][first], np.add.reduceat(n[order], first) if len(h) else n

    def out(h, cls, n):
        return batch(_COUNT, h=np.append(h, END).view(np.int64), cls=np.append(cls, -1), n=np.append(n, texts))

    for piece in slices(batches):
        hashes, classes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for _, _, words in word_blocks(piece.column("text")):
            hashes.append(words.hashes)
            classes.append(_classes(words))
        known, at, n = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
        held.append((known, np.concatenate(classes)[at], n))
        size, texts = size + len(known), texts + piece.num_rows
        if size > 1 << 21:
            held = [added()]
            size = len(held[0][0])
            if size > 1 << 20:
                yield out(*held.pop())
                size = texts = 0
    if texts:
        yield out(*(added() if held else (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))))


def corpus_counts(train: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """The count of every training token (``h, cls, n``; a written table) and the bounded vocabulary."""
    raw = train.mapInArrow(_count_words, "h long, cls int, n long")
    counts = stage_table(raw.groupBy("h", "cls").agg(F.sum("n").alias("n")).where("n > 0"), "hmm-counts")
    tokens, distinct, end = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("cls") < 0, F.col("n"))), F.lit(0))).first()
    # How many words have each count decides which counts are frequent; only those words go to the driver.
    sizes = counts.where("cls >= 0").groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(FREQUENT).collect()
    least, held = None, 0
    for r in sizes:
        held += r["words"]
        if held >= FREQUENT:
            break
        least = r["n"]
    top = counts.where((F.col("cls") >= 0) & (F.col("n") >= least)).collect() if least else []  # fewer than FREQUENT
    hashes = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    own = np.array([r["n"] for r in top], np.int64)
    class_tokens, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.where("cls >= 0").groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # CLASSES rows at most
        class_tokens[r["cls"]], class_words[r["cls"]] = r["n"], r["words"]
    for r in top:
        class_tokens[r["cls"]] -= r["n"]
        class_words[r["cls"]] -= 1
    order = np.argsort(hashes)
    return counts, Vocabulary(hashes[order], own[order], end, tokens, distinct, class_tokens, class_words)


def _texts(batch_column: pa.Array, vocabulary: Vocabulary):
    """Blocks of ``(first, last, words, classes, symbols with ends, offsets of those)``."""
    for first, last, words in word_blocks(batch_column):
        classes = _classes(words)
        offsets = words.offsets + np.arange(len(words.offsets))
        symbols = np.full(offsets[-1], len(vocabulary.hashes), np.int32)
        ends = np.zeros(offsets[-1], bool)
        ends[offsets[1:] - 1] = True
        symbols[~ends] = vocabulary.symbols(words.hashes, classes)
        yield first, last, words, classes, symbols, offsets


def first_model(vocabulary: Vocabulary, seed: int = 17) -> Model:
    """States that tend to stay, with the corpus frequencies, each distorted in its own way."""
    rng = np.random.default_rng(seed)
    n = np.concatenate([vocabulary.counts, [vocabulary.end], vocabulary.class_tokens]) + 0.5
    emit = n * np.exp(rng.normal(0, 1, (STATES, len(n))))
    move = np.full((STATES, STATES), 0.1 / (STATES - 1)) + np.eye(STATES) * (0.9 - 0.1 / (STATES - 1))
    return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(1, keepdims=True))


@dataclass
class Segments:
    """Texts cut into runs of at most ``SEGMENT`` tokens, in order; ``nth`` counts a text's segments."""

    starts: np.ndarray
    lengths: np.ndarray
    text: np.ndarray
    nth: np.ndarray

    @classmethod
    def of(cls, offsets: np.ndarray) -> Segments:
        size = np.diff(offsets)
        n = -(-size // SEGMENT)
        text = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        return cls(offsets[text] + nth * SEGMENT, np.minimum(SEGMENT, size[text] - nth * SEGMENT), text, nth)

    @property
    def rounds(self):
        """The segments that follow another, by their place in the text: each round's depend on the round before."""
        late = np.flatnonzero(self.nth)
        late = late[np.argsort(self.nth[late], kind="stable")]
        return np.split(late, np.flatnonzero(np.diff(self.nth[late])) + 1) if len(late) else []


def _products(model: Model, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, together: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """For each segment the weights from a state at its first token (emission included) to a state at its last, and the
    log of the scale taken out. They don't depend on what comes before, so all segments are worked off together."""
    k = len(model.start)
    out, logs = np.zeros((len(starts), k, k)), np.zeros(len(starts))
    order, move = np.argsort(-lengths, kind="stable"), np.ascontiguousarray(model.move.T)
    for i in range(0, len(order), together):
        own = order[i : i + together]
        s, m = starts[own], lengths[own]
        w = np.eye(k)[:, :, None] * np.take(model.emit, symbols[s], axis=1, mode="clip")[:, None, :]  # last state, first state, segment
        scale = np.zeros(len(own))
        for t in range(1, int(m[0])):
            n = int(np.searchsorted(-m, -t, side="left"))
            now = (move @ w[:, :, :n].reshape(k, -1)).reshape(k, k, n)
            now *= np.take(model.emit, symbols[s[:n] + t], axis=1, mode="clip")[:, None, :]
            if t % 16 == 0:
                c = now.sum((0, 1))
                now /= c
                scale[:n] += np.log(c)
            w[:, :, :n] = now
        c = w.sum((0, 1))
        out[own], logs[own] = (w / c).transpose(2, 1, 0), scale + np.log(c)
    return out, logs


def _carried(model: Model, symbols: np.ndarray, parts: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each segment knows of the rest of its text: the filtered states before it (rows), the weights of what follows
    its last token, both up to scale, and each text's log probability as far as its segments but the last."""
    count, k = len(parts.starts), len(model.start)
    before, after = np.zeros((count, k)), np.ones((count, k))
    log = np.zeros(int(parts.text[-1]) + 1 if count else 0)
    rounds = parts.rounds
    if not rounds:
        return before, after, log
    chosen = np.unique(np.concatenate([np.concatenate(rounds), np.concatenate(rounds) - 1]))  # of texts of several segments
    weights, logs = np.zeros((count, k, k)), np.zeros(count)
    weights[chosen], logs[chosen] = _products(model, symbols, parts.starts[chosen], parts.lengths[chosen])
    for own in rounds:
        last = own - 1
        entry = np.where(parts.nth[last][:, None] == 0, model.start, before[last] @ model.move)
        state = np.einsum("ni,nij->nj", entry, weights[last])
        c = state.sum(1)
        before[own] = state / c[:, None]
        log[parts.text[own]] += np.log(c) + logs[last]
    for own in reversed(rounds):
        back = np.einsum("nij,nj->ni", weights[own], after[own]) @ model.move.T
        after[own - 1] = back / back.sum(1, keepdims=True)
    return before, after, log


def expected_counts(model: Model, symbols: np.ndarray, offsets: np.ndarray, together: int = 2048):
    """Baum-Welch's expected counts of the texts of ``symbols``: first states, moves, emissions, and the log likelihood.

    Long texts are worked off in segments side by side. Each begins with the filtered
    states of the one before and ends with the weights of all that follows, so the
    counts are those of the whole text: moves from segment to segment are counted, and
    only a text's first token counts as a first state.
    """
    k, size = model.emit.shape
    parts = Segments.of(offsets)
    before, after, _ = _carried(model, symbols, parts)
    before, after = before.T.astype(np.float32), after.T.astype(np.float32)
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    first, moves, likelihood = np.zeros(k), np.zeros((k, k)), 0.0
    emissions = np.zeros((k, size))
    order = np.argsort(-parts.lengths, kind="stable")
    for i in range(0, len(order), together):
        own = order[i : i + together]
        s, m, late = parts.starts[own], parts.lengths[own], parts.nth[own] > 0
        steps = int(m[0])
        active = np.searchsorted(-m, -np.arange(1, steps + 1), side="right")
        sym, b, alpha, scale = [], [], [], []
        a = np.where(late, move.T @ before[:, own], model.start.astype(np.float32)[:, None])
        for t, n in enumerate(active):
            sym.append(symbols[s[:n] + t])
            b.append(np.take(emit, sym[t], axis=1, mode="clip"))
            a = (move.T @ a[:, :n] if t else a) * b[t]
            c = np.maximum(a.sum(0), np.float32(1e-30))
            a /= c
            alpha.append(a), scale.append(c)
            likelihood += float(np.log(c).sum(dtype=np.float64))
        beta = after[:, own]
        ends = np.stack([alpha[t][:, j] for j, t in enumerate(m - 1)], axis=1)
        beta /= (ends * beta).sum(0)
        for t in range(steps - 1, -1, -1):
            n = active[t]
            gamma = alpha[t] * beta[:, :n]
            onward = b[t] * beta[:, :n] / scale[t]
            if t:
                moves += alpha[t - 1][:, :n] @ onward.T
                beta[:, :n] = move @ onward
            else:
                moves += before[:, own[late]] @ onward[:, late].T
                first += gamma[:, ~late].sum(1, dtype=np.float64)
            alpha[t] = gamma
        flat = np.concatenate(sym)
        for j in range(k):
            emissions[j] += np.bincount(flat, np.concatenate([g[j] for g in alpha]), size)
    return first, moves * model.move.astype(np.float64), emissions, likelihood


def _write_symbols(train: DataFrame, shared) -> DataFrame:
    """The symbols of every training text (``symbols``, 4 bytes a token), written once for all passes."""

    def run(batches):
        for piece in slices(batches):
            for *_, symbols, offsets in _texts(piece.column("text"), shared.value):
                yield batch(_SYMBOLS, symbols=[symbols[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])

    return stage_table(train.mapInArrow(run, "symbols binary"), "hmm-symbols")


def baum_welch(train: DataFrame, vocabulary: Vocabulary, passes: int = 4, least_gain: float = 0.002) -> tuple[Model, list[float]]:
    """Train on every training text; also the log likelihood before each pass.

    ``passes`` is the most; training ends before where a pass gained less than
    ``least_gain`` of the likelihood. Each task sends, per symbol, one row of expected
    counts by state; these are added up on the executors, and the driver gets one row
    per symbol (a number fixed by ``FREQUENT`` and ``CLASSES``).
    """
    context, model, history = train.sparkSession.sparkContext, first_model(vocabulary), []
    if not passes:
        return model, history
    size = vocabulary.size
    texts = _write_symbols(train, context.broadcast(vocabulary))
    for _ in range(passes):
        current = context.broadcast(model)

        def gather(batches, current=current):
            totals = None
            for b in slices(batches, column="symbols"):
                held = [np.frombuffer(x.as_buffer(), np.int32) for x in b.column("symbols")]
                new = expected_counts(current.value, np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])]))
                totals = new if totals is None else tuple(x + y for x, y in zip(totals, new, strict=True))
            if totals is not None:
                first, moves, emissions, likelihood = totals
                used = np.flatnonzero(emissions.any(0))
                sums = np.vstack([emissions[:, used].T, moves, first, np.eye(1, STATES) * likelihood])
                symbols = np.concatenate([used, np.arange(size, size + STATES + 2)])
                yield batch(_SUM, symbol=symbols, **{f"s{k}": sums[:, k] for k in range(STATES)})

        columns = [f"s{k}" for k in range(STATES)]
        added = texts.mapInArrow(gather, "symbol int, " + ", ".join(f"{c} double" for c in columns)).groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns])
        sums = np.zeros((size + STATES + 2, STATES))
        for r in added.collect():  # a row per symbol: a number fixed by FREQUENT and CLASSES
            sums[r["symbol"]] = [r[c] for c in columns]
        current.unpersist()
        emit = sums[:size].T + 0.01
        move, start = sums[size : size + STATES] + 1.0, sums[size + STATES] + 1.0
        history.append(float(sums[size + STATES + 1, 0]))
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
        if len(history) > 1 and history[-1] - history[-2] < least_gain * abs(history[-2]):
            break
    return model, history


def forward_log10(model: Model, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The exact log10 probability of each whole symbol sequence, by the forward recursion with a scale at each step.

    The segments of a long text are worked off side by side and joined by what they carry."""
    parts = Segments.of(offsets)
    before, _, log = _carried(model, symbols, parts)
    out = np.zeros(len(offsets) - 1)
    out[: len(log)] = log
    last = np.flatnonzero(np.append(parts.text[1:] != parts.text[:-1], True)[: len(parts.text)])
    order = last[np.argsort(-parts.lengths[last], kind="stable")]
    s, m, late = parts.starts[order], parts.lengths[order], parts.nth[order] > 0
    sums = np.zeros(len(m))
    move = model.move.T.copy()
    a = np.where(late, move @ before[order].T, model.start[:, None])
    for t in range(int(m[0]) if len(m) else 0):
        n = int(np.searchsorted(-m, -(t + 1), side="right"))
        a = move @ a[:, :n] if t else a[:, :n]
        a = a * np.take(model.emit, symbols[s[:n] + t], axis=1, mode="clip")
        c = a.sum(0)
        a /= c
        sums[:n] += np.log(c)
    out[parts.text[order]] += sums
    return out / np.log(10)


def score_texts(docs: DataFrame, held_out_rest: int = 1, passes: int = 4) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. The model
    learns from all rows whose crc32(doc_id) mod 5 is not ``held_out_rest``.

    The vocabulary grows with the corpus, the model doesn't: the most frequent words
    (at most 32,767, those of one count together) and the end token have emissions of their own, every other word
    is emitted through one of 256 classes by its ending, and within its class by
    its corpus count. That last factor doesn't depend on the state, so the forward
    recursion runs over bounded tables and the factor is added per word. The counts
    of the words beyond the frequent ones come from a join by word of one row per
    text and distinct word; frequent words never enter it, so no key is hot.

    A word never seen has its class's share for unseen words. Null text is empty: one
    end token. Rows without ``doc_id`` are scored and not learned from. Repeated rows
    are scored each, and counted each. Nothing to learn from leaves uniform emissions;
    an empty table gives no rows. A very long text is one exact recursion.
    """
    context = docs.sparkSession.sparkContext
    held_out = F.coalesce(crc_bucket(docs["doc_id"]) == held_out_rest, F.lit(False))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], held_out.alias("held_out"))
    train = rows.where("NOT held_out AND doc_id IS NOT NULL").select("text")
    counts, vocabulary = corpus_counts(train)
    model, _ = baum_welch(train, vocabulary, passes if vocabulary.tokens else 0)
    shared = context.broadcast((vocabulary, model))
    tail_type = pa.list_(pa.struct([("h", pa.int64()), ("cls", pa.int32()), ("tf", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("forward", pa.float64()), ("tail", tail_type)])

    def run(batches):
        vocabulary, model = shared.value
        own = len(vocabulary.hashes)
        base = vocabulary.base(np.append(vocabulary.counts, vocabulary.end))
        known_end = int(vocabulary.end > 0)
        for b in batches:
            n_tokens, known, head, tails, symbols, lengths = [], [], [], [], [np.zeros(0, np.int32)], []
            blocks = (x for piece in slices([b]) for x in _texts(piece.column("text"), vocabulary))
            for first, last, words, classes, sym, off in blocks:
                text = np.repeat(np.arange(last - first), np.diff(off))
                is_own = sym <= own
                n_tokens.append(np.diff(off))
                known.append(np.bincount(text[sym < own], minlength=last - first) + known_end)
                head.append(np.bincount(text[is_own], base[sym[is_own]], last - first))
                inner = np.ones(len(sym), bool)
                inner[off[1:] - 1] = False
                rare = sym[inner] > own
                text, h, cls = text[inner][rare], words.hashes[rare], classes[rare]
                order = np.lexsort((h, text))
                text, h, cls = text[order], h[order], cls[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(h)))
                items = pa.StructArray.from_arrays([pa.array(h[at].view(np.int64)), pa.array(cls[at]), pa.array(tf.astype(np.int32))], names=["h", "cls", "tf"])
                bounds = np.searchsorted(text[at], np.arange(last - first + 1))
                tails.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items))
                symbols.append(sym)
                lengths.append(np.diff(off))
            sizes = np.concatenate(lengths or [np.zeros(0, np.int64)])
            forward = forward_log10(model, np.concatenate(symbols), np.concatenate([[0], np.cumsum(sizes)]))
            joined = lambda x: np.concatenate(x or [np.zeros(0)])
            tail = pa.concat_arrays(tails) if tails else pa.array([], tail_type)
            yield batch(schema, doc_id=b.column("doc_id"), held_out=b.column("held_out"), n_tokens=sizes, known=joined(known), base=joined(head), forward=forward, tail=tail.cast(tail_type))

    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, known long, base double, forward double, tail array<struct<h: long, cls: int, tf: int>>")
    scored = stage_table(scored.withColumn("uid", F.monotonically_increasing_id()), "hmm-scored")

    n = F.coalesce("n", F.lit(0))
    of_class = lambda x: F.element_at(F.lit([float(v) for v in x]), F.col("t.cls") + 1)
    words = scored.select("uid", F.explode("tail").alias("t"))
    words = words.join(counts.where("cls >= 0"), (words["t.h"] == counts["h"]) & (words["t.cls"] == counts["cls"]), "left")
    base = F.log10((n + 0.5) / F.lit(vocabulary.tokens + 0.5 * (vocabulary.distinct + 1)))
    inside = F.log10((n + 0.5) / (of_class(vocabulary.class_tokens) + 0.5 * (of_class(vocabulary.class_words) + 1)))
    per_text = words.groupBy("uid").agg(F.sum(F.col("t.tf") * base).alias("tail_base"), F.sum(F.col("t.tf") * inside).alias("tail_inside"), F.sum(F.when(n > 0, F.col("t.tf")).otherwise(0)).alias("tail_known"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return scored.drop("tail").join(per_text, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("tail_known")).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("tail_base")).alias("base_score"), (F.col("forward") + zero("tail_inside")).alias("score"),
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``score_texts`` of all documents."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
