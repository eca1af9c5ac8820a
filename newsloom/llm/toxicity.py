"""Toxicity by a classifier chain of sparse linear models.

The categories are predicted one after the other. Each has a logistic model over the words of a text
and the beginnings of its longer words, present or not, and over the probabilities of the
categories before it. In training these probabilities are out-of-fold: each fold's come from models
fitted on the other folds, so a later model sees what an earlier one is worth on texts it has not learned from.
Weights are kept sparse by soft thresholding, so words that only happen to occur get none, and long
texts do not add up noise. A category's threshold is the one with the best F1 on out-of-fold predictions.

The models are fitted on at most ``SAMPLE_ROWS`` labelled rows, those first in the order of a hash of their id;
only their ids travel to the document table, so texts are not shuffled. A model's
size is bounded by ``BUCKETS`` hashed features. Scoring is one pass over all whole texts.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from .common import worker_model

SAMPLE_ROWS = 8000
BUCKETS = 1 << 18
PREFIX = 5
FOLDS = 4
MIN_DOCS = 4
PENALTY = 3e-4
STEPS = 150
CACHED = 500_000
_runs = re.compile(r"[^\W_]+").findall


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


def word_features(word: str) -> tuple[int, ...]:
    return (_bucket(word), _bucket(word[:PREFIX] + "*")) if len(word) > PREFIX else (_bucket(word),)


def features(text: str | None) -> set[int]:
    """The hashed features of a text; none for a null text."""
    words = set(_runs(text.lower())) if text else ()
    return {f for word in words for f in word_features(word)}


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Sample:
    """Documents by features, in both directions, without features of very few documents."""

    def __init__(self, documents: list[np.ndarray]):
        self.n = len(documents)
        rows = np.repeat(np.arange(self.n), [len(d) for d in documents])
        columns = np.concatenate(documents) if documents else np.zeros(0, np.int64)
        often = np.bincount(columns, minlength=BUCKETS) >= MIN_DOCS
        self.used = np.nonzero(often)[0]
        keep = often[columns]
        self.rows, self.columns = rows[keep], np.searchsorted(self.used, columns[keep])

    def fit(self, target: np.ndarray, chain: np.ndarray, include: np.ndarray) -> tuple:
        """Sparse logistic regression by accelerated proximal gradient steps over the rows in ``include``."""
        n, some = max(1, include.sum()), include[self.rows]
        rows, columns = self.rows[some], self.columns[some]
        size, dense = len(self.used), chain.shape[1]
        rate = np.clip(target[include].mean() if include.any() else 0.5, 1e-4, 1 - 1e-4)
        # each weight has its own step: a bound on its share of the curvature
        length = np.bincount(rows, minlength=self.n).max(initial=1) + dense + 1
        frequency = np.bincount(columns, minlength=size) / n
        step = 4 / np.maximum(frequency * min(length, 400), 1e-9)
        step_dense = 4 / (min(length, 400) * np.maximum((chain ** 2 * include[:, None]).sum(axis=0) / n, 1e-9))
        w, v, b = np.zeros(size), np.zeros(dense), float(np.log(rate / (1 - rate)))
        w0, v0, b0, t = w, v, b, 1.0
        for _ in range(STEPS):
            t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            m = (t - 1) / t1
            wy, vy, by = w + m * (w - w0), v + m * (v - v0), b + m * (b - b0)
            z = np.bincount(rows, weights=wy[columns], minlength=self.n) + chain @ vy + by
            error = np.where(include, _sigmoid(z) - target, 0.0) / n
            w0, v0, b0, t = w, v, b, t1
            w = wy - step * np.bincount(columns, weights=error[rows], minlength=size)
            w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0)
            v = vy - step_dense * (chain.T @ error)
            b = by - 4 / min(length, 400) * error.sum()
        return w, v, b

    def predict(self, model: tuple, chain: np.ndarray) -> np.ndarray:
        w, v, b = model
        return _sigmoid(np.bincount(self.rows, weights=w[self.columns], minlength=self.n) + chain @ v + b)


@dataclass
class Link:
    """One category's model: weights of hashed features, weights of earlier categories, bias, threshold."""

    category: str
    weights: dict[int, float]
    chain: list[float]
    bias: float
    threshold: float


def _threshold(truth: np.ndarray, scores: np.ndarray) -> float:
    if not truth.any():
        return 1.0
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    last = np.append(np.diff(scores[order]) != 0, True)  # equal scores stay together
    best = int(np.where(last, f1, -1).argmax())
    below = scores[order][best + 1] if best + 1 < len(order) else 0.0
    return float((scores[order][best] + below) / 2)


def fit_chain(documents: list[np.ndarray], labels: dict[str, np.ndarray], folds: np.ndarray) -> list[Link]:
    """Models for the categories in the order of ``labels``; a label that is NaN is left out of its model."""
    sample, chain, links = _Sample(documents), np.zeros((len(documents), 0)), []
    for category, label in labels.items():
        known = ~np.isnan(label)
        target = np.where(known, label, 0.0)
        inside = np.zeros(len(documents))
        for fold in range(FOLDS):
            out = folds == fold
            model = sample.fit(target, chain, known & ~out)
            inside[out] = sample.predict(model, chain)[out]
        w, v, b = sample.fit(target, chain, known)
        used = np.nonzero(w)[0]
        links.append(Link(category, dict(zip(sample.used[used].tolist(), w[used].tolist())), v.tolist(), b,
                          _threshold(target[known] > 0, inside[known])))
        chain = np.column_stack((chain, inside))
    return links


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], text: str = "text",
        id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> list[Link]:
    """Fit the chain on labelled rows; no labelled rows give models that predict false."""
    chosen = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), *[
        F.col(c).cast("double").alias(c) for c in categories])
    hashed = F.xxhash64(F.col("_id").cast("string"))
    first = chosen.orderBy(hashed, "_id", *categories).limit(sample_rows)
    joined = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(first), "_id")
    keep = ["_id", *categories]

    def run(batches):
        for batch in batches:
            found = [sorted(features(t)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(found, pa.list_(pa.int32()))], [*keep, "features"])

    schema = StructType([joined.schema[c] for c in keep])
    rows = joined.mapInArrow(run, schema.simpleString()[7:-1] + ", features array<int>").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["_id"]).encode()), str(r["_id"]), r["features"]))
    folds = np.array([zlib.crc32(f"fold {r['_id']}".encode()) % FOLDS for r in rows])
    values = {c: np.array([np.nan if r[c] is None else r[c] for r in rows], float) for c in categories}
    return fit_chain([np.array(r["features"], np.int64) for r in rows], values, folds)


class Scorer:
    """Applies a chain. Which features of a word have weights is kept per worker."""

    def __init__(self, links: list[Link]):
        self.links = links
        self.weighted = set().union(*(link.weights for link in links)) if links else set()
        self.known: dict[str, tuple] = {}

    def _features(self, word: str) -> tuple:
        found = self.known.get(word)
        if found is None:
            found = tuple(f for f in word_features(word) if f in self.weighted)
            if len(self.known) >= CACHED:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def score(self, text: str | None) -> list[float]:
        active = {f for word in set(_runs(text.lower()) if text else ()) for f in self._features(word)}
        scores: list[float] = []
        for link in self.links:
            z = link.bias + sum(a * b for a, b in zip(link.chain, scores))
            z += sum(link.weights[f] for f in sorted(active) if f in link.weights)
            scores.append(float(_sigmoid(z)))
        return scores


def predict(docs: DataFrame, links: list[Link], text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``<category>_score`` from 0 to 1 and ``<category>_pred`` for each category.

    Null and empty texts get the score of a text without words. Columns with the new names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(links)
    made = [name for link in links for name in (f"{link.category}_score", f"{link.category}_pred")]
    own = [c for c in docs.columns if c not in made]
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    schema = StructType([packed.schema["row"]])
    for link in links:
        schema = schema.add(f"{link.category}_score", DoubleType()).add(f"{link.category}_pred", BooleanType())

    def run(batches):
        chain = shared.value
        scorer = worker_model(chain, Scorer)
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("row")]
            for i, link in enumerate(chain):
                columns += (pa.array([s[i] for s in scores], pa.float64()),
                            pa.array([s[i] >= link.threshold for s in scores], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return packed.mapInArrow(run, schema).select(*[F.col("row")[c].alias(c) for c in own], *made)
