"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import crc_bucket, free_name, lean, slices, small_batches, text_bytes

#: Units of each direction, the bytes of a window, and the bytes at a window's inner edges that are only read for their
#: context: windows overlap by twice as many, so no position is labelled next to a cut.
UNITS, WINDOW, MARGIN = 8, 128, 8
UNKNOWN = "und"


@dataclass
class ByteTagger:
    """Weights: per direction the input table ``w`` (256 x 3 units: update, reset, new), the recurrent
    ``u`` (units x 2 units) and ``v`` (units x units); ``out`` maps both states to the labels. Gates and
    states use the soft sign ``x / (1 + |x|)``, which is cheaper than tanh and trains as well."""

    labels: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, labels: list[str], seed: int = 5) -> ByteTagger:
        rng, p = np.random.default_rng(seed), {}
        for d in "fb":
            p[f"w{d}"] = rng.normal(0, 0.3, (256, 3 * UNITS))
            p[f"u{d}"] = rng.normal(0, UNITS**-0.5, (UNITS, 2 * UNITS))
            p[f"v{d}"] = rng.normal(0, UNITS**-0.5, (UNITS, UNITS))
            p[f"out{d}"] = rng.normal(0, UNITS**-0.5, (UNITS, len(labels)))
        p["bias"] = np.zeros(len(labels))
        return cls(labels, {k: x.astype(np.float32) for k, x in p.items()})

    def _states(self, x: np.ndarray, active: np.ndarray, d: str, use) -> None:
        """Run one direction and call ``use(t, h before, update, reset, new, h after)`` at each step, all of them units x windows.

        ``x`` is steps x windows; at step t the first ``active[t]`` windows, which
        are sorted by length, have a byte. The backward direction goes from the last
        step to the first, and a window joins in at its last byte.
        """
        w, u, v = self.params[f"w{d}"].T.copy(), self.params[f"u{d}"].T.copy(), self.params[f"v{d}"].T.copy()
        state = np.zeros((UNITS, x.shape[1]), np.float32)
        half = np.float32(0.5)
        for t in range(len(active)) if d == "f" else range(len(active) - 1, -1, -1):
            n = active[t]
            h = state[:, :n]
            a = np.take(w, x[t, :n], axis=1, mode="clip")
            gates = a[: 2 * UNITS]
            gates += u @ h
            gates /= np.abs(gates) + 1  # soft sign, to a gate between 0 and 1
            gates *= half
            gates += half
            z, r, new = gates[:UNITS], gates[UNITS:], a[2 * UNITS :]
            new += v @ (r * h)
            new /= np.abs(new) + 1
            after = new - h
            after *= z
            after += h
            use(t, h, z, r, new, after)
            if d == "f":
                state = after
            else:
                state[:, :n] = after

    def train(self, x: np.ndarray, y: np.ndarray, steps: int, windows: int, rate: float, seed: int = 3) -> None:
        """Backpropagation through time with Adam. ``x``: full windows (rows) of bytes, ``y``: their labels; labels are drawn equally often."""
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        by_label = [b for b in by_label if len(b)]
        moment = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in self.params.items()}
        for step in range(1, steps + 1):
            picked = np.concatenate([rng.choice(b, -(-windows // len(by_label))) for b in by_label])
            for k, g in self._gradient(x[picked].T, y[picked]).items():
                m, s = moment[k]
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                self.params[k] -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        steps, n = x.shape
        full, kept = np.full(steps, n), {d: [None] * steps for d in "fb"}
        logits = np.tile(self.params["bias"][:, None], (steps, 1, n))

        def keep(d):
            def use(t, h, z, r, new, after):
                kept[d][t] = (h.copy(), z, r, new)
                logits[t] += self.params[f"out{d}"].T @ after
                states[d][t] = after

            return use

        states = {d: [None] * steps for d in "fb"}
        for d in "fb":
            self._states(x, full, d, keep(d))
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[:, y, np.arange(n)] -= 1
        p /= steps * n
        grads = {"bias": p.sum((0, 2))}
        for d in "fb":
            u, v, out = (self.params[k + d] for k in ("u", "v", "out"))
            du, dv, dout, da = np.zeros_like(u), np.zeros_like(v), np.zeros_like(out), np.zeros((steps, 3 * UNITS, n), np.float32)
            dh = np.zeros((UNITS, n), np.float32)
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, z, r, new = kept[d][t]
                dout += states[d][t] @ p[t].T
                dh = dh + out @ p[t]
                dnew = dh * z * (1 - np.abs(new)) ** 2
                back = v @ dnew
                da[t, :UNITS] = dh * (new - h) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                da[t, UNITS : 2 * UNITS] = back * h * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                da[t, 2 * UNITS :] = dnew
                gates = da[t, : 2 * UNITS]
                dv += (r * h) @ dnew.T
                du += h @ gates.T
                dh = dh * (1 - z) + back * r + u @ gates
            flat = x.ravel()
            grads[f"w{d}"] = np.stack([np.bincount(flat, da[:, k].ravel(), 256) for k in range(3 * UNITS)], 1).astype(np.float32)
            grads[f"u{d}"], grads[f"v{d}"], grads[f"out{d}"] = du, dv, dout
        return grads

    def document_probabilities(self, flat: np.ndarray, bounds: np.ndarray, together: int | None = None) -> np.ndarray:
        """Mean over all positions of each text's label probabilities; a row of zeros for an empty text.

        ``together`` windows go side by side: 4096, and fewer with more than 8 labels, as every step of theirs holds a number a label.
        """
        together = together or max(8, 4096 * 8 // max(8, len(self.labels)))
        size, stride = np.diff(bounds), WINDOW - 2 * MARGIN
        n = np.where(size > WINDOW, 1 - (WINDOW - size) // stride, size > 0)
        text = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        start, length = bounds[text] + nth * stride, np.minimum(WINDOW, size[text] - nth * stride)
        inner_start, inner_end = nth > 0, nth < n[text] - 1
        order = np.argsort(-length, kind="stable")
        total = np.zeros((len(self.labels), len(size)))
        outf, outb, bias = self.params["outf"].T.copy(), self.params["outb"].T.copy(), self.params["bias"][:, None]
        for i in range(0, len(order), together):
            own = order[i : i + together]
            s, m, cut_before, cut_after = start[own], length[own], inner_start[own], inner_end[own]
            steps = int(m[0])
            active = np.searchsorted(-m, -np.arange(1, steps + 1), side="right")
            x = flat[np.minimum(s + np.arange(steps)[:, None], len(flat) - 1)]
            logits: list = [None] * steps
            pooled = np.zeros((len(self.labels), len(own)), np.float32)

            def first(t, h, z, r, new, after, logits=logits):
                logits[t] = outb @ after

            def second(t, h, z, r, new, after, logits=logits, pooled=pooled, cut_before=cut_before, cut_after=cut_after):
                p = outf @ after
                p += logits[t]
                p += bias
                p -= p.max(0)
                np.exp(p, out=p)
                p /= p.sum(0)
                if t < MARGIN:
                    p *= ~cut_before[: p.shape[1]]
                elif t >= WINDOW - MARGIN:
                    p *= ~cut_after[: p.shape[1]]
                pooled[:, : p.shape[1]] += p

            self._states(x, active, "b", first)
            self._states(x, active, "f", second)
            for k in range(len(self.labels)):
                total[k] += np.bincount(text[own], pooled[k], len(size))
        return (total / np.maximum(size, 1)).T


def training_windows(docs: DataFrame, per_label: int = 400, most_rows: int = 25_600, chars: int = 512) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels, byte windows and label numbers from a bounded sample: ``per_label`` labelled texts at most of each label,
    however rare beside the others, ``chars`` characters from a place that a hash of id and text picks. Equal rows count once.

    Every label is learnt. With many labels each has fewer rows, so that all have ``most_rows`` together; that is
    also the bound on the number of labels, of which the most frequent ones count.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(crc_bucket(F.col("doc_id")) != 0).select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    rows = rows.withColumn("key", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("key").alias("least")).orderBy(F.desc("n"), "lang").limit(most_rows).collect()
    if not counts:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    per_label = max(1, min(per_label, most_rows // len(counts)))
    # Keys below the bound are drawn; the label's least key always is, so that no label is left out.
    bound = docs.sparkSession.createDataFrame([(r["lang"], max(r["least"] + 1, int(min(1.0, 1.2 * per_label / r["n"]) * (1 << 30)))) for r in counts], "lang string, bound long")
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), F.char_length("text") - chars)) + 1
    chosen = rows.join(F.broadcast(bound), "lang").where("key < bound")
    chosen = chosen.groupBy("lang", "key").agg(F.min(F.substring("text", place.cast("int"), F.lit(chars))).alias("text"))
    # Each label has a limit of its own: a common one on the keys would cut the rarest label, whose keys reach farthest.
    nth = F.row_number().over(W.partitionBy("lang").orderBy("key", "text"))
    sample = chosen.withColumn("nth", nth).where(F.col("nth") <= per_label).orderBy("key", "lang", "text").collect()
    labels = sorted({r["lang"] for r in sample})
    x, y = [], []
    for r in sample:
        raw = np.frombuffer(r["text"].encode("utf-8", "replace"), np.uint8)
        if len(raw):
            raw = np.resize(raw, max(WINDOW, len(raw)))
            for a in range(0, len(raw) - WINDOW + 1, WINDOW):
                x.append(raw[a : a + WINDOW])
                y.append(labels.index(r["lang"]))
    return labels, np.array(x, np.uint8).reshape(-1, WINDOW), np.array(y, np.int64)


def train_tagger(docs: DataFrame, steps: int = 160, windows: int = 96, rate: float = 0.02, **sample) -> ByteTagger | None:
    """A tagger trained on the rows of ``docs`` whose crc32(doc_id) mod 5 is not 0; None where no row has a label and text."""
    labels, x, y = training_windows(docs, **sample)
    if not len(x):
        return None
    tagger = ByteTagger.fresh(labels)
    tagger.train(x, y, steps, windows, rate)
    return tagger


def label_languages(docs: DataFrame, tagger: ByteTagger | None, label: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its pooled probability as columns ``label`` and ``score``.

    Only ``text`` is looked at. Every byte of the whole text gets label
    probabilities; their mean decides, the first label in order on a tie. Null text,
    and text without a letter, is ``und`` with score 0, and so is all text where
    there is no tagger. Repeated rows get equal labels; very long texts are read in
    overlapping windows; an empty table stays empty. If a name clashes with a column, pass another.
    """
    if {label, score} & set(docs.columns):
        raise ValueError(f"{label} or {score} is a column already; pass other names")
    schema = T.StructType([*docs.schema.fields, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        tagger = model.value
        for b in slices(batches, 2 << 20):
            letters = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            names, best = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            if tagger is not None and b.num_rows:
                p = tagger.document_probabilities(*text_bytes(b.column("text")))
                best = np.where(letters, np.clip(p.max(1), 0.0, 1.0), 0.0)
                names = [tagger.labels[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), letters, strict=True)]
            columns = [*b.columns[:-1], pa.array(names, pa.string()), pa.array(best, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    flag = F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False))
    return docs.select("*", flag.alias(free_name(docs, "_letters"))).mapInArrow(lean(run), schema)


def score_bounds(docs: DataFrame, tagger: ByteTagger) -> dict[str, float]:
    """Half the lowest score among a label's held-out documents that get that label: all of them are scored.

    Held-out rows are those ``train_tagger`` leaves out. A label without such documents has no bound.
    """
    rows = docs.where(F.col("lang").isin(tagger.labels) & F.col("text").isNotNull() & (crc_bucket(F.col("doc_id")) == 0)).select(F.col("lang").cast("string").alias("lang"), "text")
    scored = label_languages(rows, tagger, "_pred", "_score").where("_pred = lang")
    return {r["lang"]: r["least"] / 2 for r in scored.groupBy("lang").agg(F.min("_score").alias("least")).collect()}


def known_language(docs: DataFrame, tagger: ByteTagger | None = None, least: float | None = None) -> DataFrame:
    """The documents with a language: those not ``und`` and with a pooled probability of the label's bound or more.

    The bounds are ``score_bounds``, or ``least`` for every label where it is given.
    Without a tagger (no row to learn from) all documents with a letter stay.
    A document in a language that the tagger wasn't trained on gets the label that
    is nearest, and stays if it reaches that label's bound.
    """
    tagger = tagger or train_tagger(docs)
    if tagger is None:
        return docs.where(docs["text"].rlike(r"\p{L}"))
    bounds = {} if least is not None or "lang" not in docs.columns else score_bounds(docs, tagger)
    label, score = free_name(docs, "_lang_pred"), free_name(docs, "_lang_score")
    bound = F.lit(0.0 if least is None else least)
    if bounds:
        bound = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in bounds.items() for x in kv]), F.col(label)), bound)
    labelled = label_languages(docs, tagger, label, score)
    return labelled.where((F.col(label) != UNKNOWN) & (F.col(score) >= bound)).select(*docs.columns)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``label_languages`` of all documents, by a tagger that learnt from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", F.coalesce(crc_bucket(docs["doc_id"]) == 0, F.lit(False)).alias("held_out"))
    return label_languages(rows, train_tagger(docs)).select("doc_id", "held_out", "lang_pred", "score")
