"""Quality classifier: Bradley-Terry scores learned from preference pairs.

A bounded sample of labelled documents yields pairs (a good one, a bad one); the
weights minimise the logistic loss of the differences of their features, so a
document's raw score is its Bradley-Terry strength. The cutoff is a quantile of
the sample's raw scores, the one that leaves as large a share above it as there are
good labels; the published score is a logistic curve through that point, at
``threshold``. Features are computed in tasks; the driver gets those of the
sample, ``max_rows`` rows of nine numbers.

Cases: a null or empty text has a defined score like any other; without labels of
both kinds all scores are 0.5; equal scores are not told apart; a document
labelled more than once counts with the least label; columns of the input
named like ours are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import below_hash
from .text import measures

N_FEATURES = 9


def features(text: str | None) -> np.ndarray:
    n, chars, symbols, dup, repeat, lines = measures(text)
    per_word, per_line = 1 / max(n, 1), 1 / max(lines, 1)
    return np.array(
        [
            np.log1p(n),
            min(n, 50) / 50,
            min(symbols * per_word, 1),
            np.sqrt(symbols * per_word),
            dup * per_line,
            repeat * per_word,
            np.log1p(chars * per_word),
            np.log1p(n * per_line),
            float(n == 0),
        ]
    )


def _features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def each(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features(t) for t in batch], dtype=object)

    return each(text)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cutoff: float
    spread: float
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.spread:
            return np.full(len(x), 0.5)
        at = np.log(self.threshold / (1 - self.threshold))
        z = np.clip((self.raw(x) - self.cutoff) / self.spread + at, -40, 40)
        return 1 / (1 + np.exp(-z))


def fit_pairs(
    x: np.ndarray,
    y: np.ndarray,
    *,
    threshold: float = 0.7,
    pairs: int = 200_000,
    ridge: float = 1e-4,
    steps: int = 30,
    seed: int = 1,
) -> Ranker:
    """Newton steps on the logistic loss of feature differences."""
    nothing = Ranker(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 0.0, 0.0,
                     threshold)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return nothing
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    n = min(pairs, len(good) * len(bad))
    d = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # chance that the pair is the wrong way
        gradient = ridge * w - d.T @ p / n
        hessian = (d * (p * (1 - p))[:, None]).T @ d / n + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    # between the last score below the cutoff and the first above it
    ordered = np.sort(raw)
    at = min(max(len(bad), 1), len(raw) - 1)
    cutoff = (ordered[at - 1] + ordered[at]) / 2
    spread = max((np.quantile(raw[good], 0.5) - np.quantile(raw[bad], 0.5)) / 8, 1e-6)
    return Ranker(mean, scale, w, float(cutoff), float(spread), threshold)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = 20_000,
    threshold: float = 0.7,
) -> Ranker:
    """Learn from at most ``max_rows`` labelled documents, drawn by a hash of their keys.

    Labelled keys are counted first, and only those below a hash that some more than ``max_rows``
    are expected to lie under are sorted.
    """
    marked = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).alias("_label"))
    )
    hashed = F.xxhash64("_key", F.lit(11))
    # before any text is read; the order of hashes is that of a random draw
    drawn = marked.where(below_hash(hashed, max_rows, marked.count()))
    marks = drawn.orderBy(hashed, "_key").limit(max_rows)
    # max_rows bounds what is broadcast
    own = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text"))
    sample = (
        own.join(F.broadcast(marks), F.col("_doc") == F.col("_key"))
        .select("_doc", "_label", _features(F.col("_text")).alias("x"))
        # repeated documents may exceed the bound again
        .orderBy(F.xxhash64("_doc", F.lit(11)), "_doc", "x")
        .limit(max_rows)
        .select("_label", "x")
        .toPandas()
    )
    if not len(sample):
        return fit_pairs(np.zeros((0, N_FEATURES)), np.zeros(0), threshold=threshold)
    return fit_pairs(
        np.stack(sample["x"].to_numpy()), sample["_label"].to_numpy(), threshold=threshold
    )


def scorer(docs: DataFrame, ranker: Ranker, text: str = "text") -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(ranker)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            if len(batch):
                x = np.stack([features(t) for t in batch])
                yield pd.Series(sent.value.score(x))
            else:
                yield pd.Series([], dtype=float)

    return score(F.col(text))


def classify(docs: DataFrame, ranker: Ranker, *, text: str = "text") -> DataFrame:
    """The documents with ``score`` and ``predicted`` (1 from the threshold on)."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*kept, scorer(docs, ranker, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ranker.threshold).cast("int"))
