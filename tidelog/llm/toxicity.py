"""Toxicity by a chain of linear classifiers, each fed the probabilities of the categories before it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.words import PUNCTUATION, mix, word_blocks

#: The chain over the label table: each category and how it follows from a row.
CATEGORIES = {
    "low_quality": "1 - quality",
    "toxic": "toxic",
    "toxic_low_quality": "toxic * (1 - quality)",
}


def _features(column: pa.Array):
    """``(first, last, text numbers, feature hashes)`` of blocks of rows: each word without punctuation, and each raw word's last three bytes."""
    for (first, last, raw), (_, _, bare) in zip(word_blocks(column), word_blocks(column, separators=PUNCTUATION), strict=True):
        text = np.arange(last - first)
        tails = mix(raw.tail.astype(np.uint64) + np.uint64(0x7A11 << 40))
        yield first, last, np.concatenate([np.repeat(text, bare.counts), np.repeat(text, raw.counts)]), np.concatenate([bare.hashes, tails])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Link:
    """One category's linear model: feature hashes (sorted) and weights, weights of the earlier categories, bias, threshold."""

    name: str
    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    threshold: float = 0.5


def _select(rows: np.ndarray, features: np.ndarray, width: int, y: np.ndarray, most: int, least_score: float) -> np.ndarray:
    """The feature numbers (below ``width``) that tell the classes apart best by chi-square, at most ``most``, sorted."""
    n, positive = len(y), y.sum()
    df, hits = np.bincount(features, minlength=width).astype(float), np.bincount(features, y[rows], minlength=width)
    other = positive - hits, n - positive - (df - hits)
    cross = hits * other[1] - other[0] * (df - hits)
    score = n * cross**2 / np.maximum(1.0, df * (n - df) * positive * (n - positive))
    order = np.argsort(-score, kind="stable")[:most]
    return np.sort(order[(score[order] >= least_score) & (df[order] >= 3)])


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return w


def _design(rows, features, n, selected) -> np.ndarray:
    x = np.zeros((n, len(selected)))
    if len(selected):
        at = np.minimum(np.searchsorted(selected, features), len(selected) - 1)
        ok = selected[at] == features
        x[rows[ok], at[ok]] = 1
    return x


def fit_chain(texts: list[str], labels: dict[str, list[int | None]], folds: int = 5, most: int = 256, least_score: float = 15.0) -> list[Link]:
    """Fit the chain on a bounded sample held in memory.

    A category's model sees the earlier categories as probabilities. In training
    these are out-of-fold predictions (a row's probability comes from a model that
    didn't see the row), so later models learn from inputs as uncertain as those
    they meet. A row whose label is null is left out of that category's fit.
    A category's threshold is the one with the best F1 on out-of-fold predictions.
    """
    n, parts = len(texts), list(_features(pa.array(texts, pa.string())))
    rows = np.concatenate([r + first for first, _, r, _ in parts] or [np.zeros(0, np.int64)])
    hashes, features = np.unique(np.concatenate([f for *_, f in parts] or [np.zeros(0, np.uint64)]), return_inverse=True)
    often = np.bincount(features, minlength=len(hashes)) >= 3
    rows, features, hashes = rows[often[features]], (np.cumsum(often) - 1)[features[often[features]]], hashes[often]
    width = max(1, len(hashes))
    rows, features = np.divmod(np.unique(rows * width + features), width)
    fold, chain, before = np.arange(n) % folds, [], np.zeros((n, 0))

    def model(keep, y):
        use = keep[rows]
        renumber = np.cumsum(keep) - 1
        own_rows, own = renumber[rows[use]], features[use]
        selected = _select(own_rows, own, width, y[keep], most, least_score)
        w = _fit(np.hstack([_design(own_rows, own, keep.sum(), selected), before[keep]]), y[keep])
        return selected, w

    for name, values in labels.items():
        known = np.array([v is not None for v in values])
        y = np.array([float(v or 0) for v in values])
        outside = np.zeros(n)
        if not known.any() or y[known].min() == y[known].max():
            constant = float(y[known].max()) if known.any() else 0.0
            chain.append(Link(name, np.zeros(0, np.uint64), np.zeros(0), np.zeros(before.shape[1]), 40.0 * (2 * constant - 1)))
            before = np.hstack([before, np.full((n, 1), constant)])
            continue
        for k in range(folds):
            train, test = known & (fold != k), fold == k
            if not train.any() or not test.any():
                continue
            selected, w = model(train, y)
            x = np.hstack([_design(rows, features, n, selected), before])[test]
            outside[test] = _sigmoid(x @ w[:-1] + w[-1])
        selected, w = model(known, y)
        m = len(selected)
        order = np.argsort(-outside[known], kind="stable")
        hit = np.cumsum(y[known][order])
        f1 = 2 * hit / (np.arange(1, len(hit) + 1) + y[known].sum())
        cut = int(np.argmax(f1))
        ranked = outside[known][order]
        threshold = (ranked[cut] + (ranked[cut + 1] if cut + 1 < len(ranked) else 0.0)) / 2
        chain.append(Link(name, hashes[selected], w[:m], w[m:-1], float(w[-1]), float(np.clip(threshold, 0.25, 0.95))))
        before = np.hstack([before, outside[:, None]])
    return chain


def predict(chain: list[Link], column: pa.Array) -> np.ndarray:
    """Probabilities (texts x categories) of a string column, category by category."""
    every = np.unique(np.concatenate([link.features for link in chain] or [np.zeros(0, np.uint64)]))
    maybe = np.zeros(1 << 16, bool)
    maybe[(every >> np.uint64(48)).astype(np.int64)] = True
    out = np.zeros((len(column), len(chain)))
    for first, last, rows, features in _features(column):
        use = maybe[(features >> np.uint64(48)).astype(np.int64)]
        rows, features = rows[use], features[use]
        at = np.searchsorted(every, features) if len(every) else np.zeros(0, np.int64)
        ok = every[np.minimum(at, len(every) - 1)] == features if len(every) else np.zeros(0, bool)
        pairs = np.unique(rows[ok] * max(1, len(every)) + at[ok])
        rows, features = pairs // max(1, len(every)), every[pairs % max(1, len(every))]
        for k, link in enumerate(chain):
            z = np.full(last - first, link.bias)
            if len(link.features):
                at = np.minimum(np.searchsorted(link.features, features), len(link.features) - 1)
                ok = link.features[at] == features
                z += np.bincount(rows[ok], link.weights[at[ok]], last - first)
            out[first:last, k] = _sigmoid(z + out[first:last, :k] @ link.earlier)
    return out


def train_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, sample: int = 4000, sample_chars: int = 64 << 20) -> list[Link]:
    """A chain fitted on at most ``sample`` labelled documents of ``sample_chars`` characters together, picked by a hash of their id.

    Of repeated labels the largest counts; of repeated ids the text that is first in
    order. A document that would take the sample beyond its characters is left out.
    """
    chosen = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(F.expr(e)).cast("int").alias(c) for c, e in categories.items()])
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sizes = found.groupBy("doc_id").agg(F.max(F.coalesce(F.char_length("text"), F.lit(0))).alias("chars")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # at most ``sample`` rows
    wanted, left = [], sample_chars
    for r in sizes:
        if r["chars"] <= left:
            wanted.append((r["doc_id"],))
            left -= r["chars"]
    wanted = docs.sparkSession.createDataFrame(wanted, "doc_id long")
    rows = found.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", *categories).agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit_chain([r["text"] for r in rows], {c: [r[c] for r in rows] for c in categories})


def score_toxicity(docs: DataFrame, chain: list[Link], prefix: str = "p_", flag: str = "is_") -> DataFrame:
    """``docs`` with a probability ``p_<category>`` and a decision ``is_<category>`` for each category of the chain.

    Only ``text`` is looked at, and all of it. Null, empty and blank texts have no
    features and get the bias alone. Repeated rows are scored alike; an empty table
    stays empty. If a new name clashes with a column, pass other prefixes.
    """
    names = [prefix + c.name for c in chain] + [flag + c.name for c in chain]
    if set(names) & set(docs.columns):
        raise ValueError(f"one of {', '.join(names)} is a column already; pass other prefixes")
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType() if k < len(chain) else T.BooleanType()) for k, n in enumerate(names)]])
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for b in batches:
            p = predict(model.value, b.column("text"))
            flags = [pa.array(p[:, k] >= link.threshold) for k, link in enumerate(model.value)]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x) for x in p.T], *flags], names=schema.names)

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, chain: list[Link], category: str = "toxic") -> DataFrame:
    """The documents not flagged as ``category``, with their own columns only."""
    prefix = "_"
    while any(c.lower().startswith((f"{prefix}p_", f"{prefix}is_")) for c in docs.columns):
        prefix += "_"
    return score_toxicity(docs, chain, f"{prefix}p_", f"{prefix}is_").where(~F.col(f"{prefix}is_{category}")).select(*docs.columns)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probabilities of all documents, and which of them are toxic."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), train_chain(docs, labels))
    return scored.select("doc_id", *[f"p_{c}" for c in CATEGORIES], F.col("is_toxic").alias("toxic"))
