"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample of labelled documents, in tasks; the
driver gets one count per language and bucket, at most ``languages * buckets``
rows, and broadcasts the log-probability matrix. Scoring runs over whole texts
in batches: the n-grams of a batch are hashed and looked up with numpy and summed
per text. Very long texts are scored in slices, so memory does not follow them.

Cases: a text that is null or has no letter is ``und`` with score 0; languages tie
to the first in alphabetical order; a null language is not learned from; without
anything to learn from, every text is ``und``; repeated rows are scored (and
counted) one by one; columns of the input named like ours are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import fresh_name, release

_LETTER = re.compile(r"[^\W\d_]")
SLICE = 1 << 18  # characters that are hashed at a time


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # buckets x languages
    log_prior: np.ndarray
    orders: tuple[int, ...]


def ngram_buckets(points: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    mixed = np.full(n, order, np.uint64)
    for i in range(order):
        mixed = (mixed ^ points[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def _slices(text: str, longest: int) -> Iterator[tuple[str, int]]:
    """Pieces of a text and how far each overlaps the one before."""
    for start in range(0, len(text), SLICE):
        back = min(start, longest - 1)
        yield text[start - back : start + SLICE], back


def _counts(texts: Iterator[str], orders: tuple[int, ...], buckets: int) -> np.ndarray:
    total = np.zeros(buckets, np.int64)
    for text in texts:
        for piece, back in _slices(text, max(orders)):
            points = _points(piece)
            for order in orders:
                # n-grams that end in the overlap were counted with the slice before
                own = points[max(0, back - order + 1) :]
                total += np.bincount(ngram_buckets(own, order, buckets), minlength=buckets)
    return total


def train(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 4000,
    orders: tuple[int, ...] = (1, 2, 3),
    buckets: int = 1 << 15,
    smoothing: float = 0.5,
    max_languages: int = 1000,
) -> Model:
    """Learn from about ``rows_per_language`` rows of each language, all if there are fewer.

    Rows are drawn by a hash of their key, so the sample does not depend on order.
    """
    labelled = docs.select(F.col(key), F.col(text), F.col(lang).cast("string").alias("_lang")).where(
        F.col("_lang").isNotNull() & F.col(text).isNotNull()
    )
    sizes = labelled.groupBy("_lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return Model((), np.empty((buckets, 0)), np.empty(0), orders)
    share = F.element_at(
        F.create_map(
            *[F.lit(x) for r in sizes for x in (r[0], min(1.0, rows_per_language / r[1]))]
        ),
        F.col("_lang"),
    )
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1_000_003)) / 1_000_003.0

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, own in batch.groupby("_lang"):
                found = _counts(iter(own[text]), orders, buckets)
                at = np.flatnonzero(found)
                yield pd.DataFrame({"_lang": name, "bucket": at, "n": found[at]})

    rows = (
        labelled.where(drawn < share)
        .select("_lang", text)
        .mapInPandas(count, "_lang string, bucket int, n long")
        .groupBy("_lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(r[0] for r in sizes))
    counts = np.full((buckets, len(languages)), smoothing)
    where = {name: i for i, name in enumerate(languages)}
    np.add.at(counts, (rows["bucket"].to_numpy(int), rows["_lang"].map(where).to_numpy(int)),
              rows["n"].to_numpy(float))
    of = {r[0]: r[1] for r in sizes}
    prior = np.array([of[name] for name in languages], float)
    return Model(
        languages,
        np.log(counts / counts.sum(axis=0)).astype(np.float32),
        np.log(prior / prior.sum()),
        orders,
    )


def _log_sums(texts: list[str], model: Model) -> np.ndarray:
    """Summed log-probabilities, one row per text."""
    buckets, k = model.log_prob.shape
    sums = np.zeros((len(texts), k))
    pieces: list[tuple[int, str, int]] = []
    held = 0

    def flush() -> None:
        for order in model.orders:
            ids, ends = [], []
            for _, piece, back in pieces:
                own = _points(piece)[max(0, back - order + 1) :]
                ids.append(ngram_buckets(own, order, buckets))
                ends.append(len(ids[-1]))
            if not sum(ends):
                continue
            logs = model.log_prob[np.concatenate(ids)]
            rows = np.repeat(np.array([p[0] for p in pieces]), ends)
            starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            np.add.at(sums, rows[starts], np.add.reduceat(logs, starts, axis=0, dtype=float))
        pieces.clear()

    for i, text in enumerate(texts):
        for piece, back in _slices(text, max(model.orders)):
            pieces.append((i, piece, back))
            held += len(piece)
            if held >= SLICE:
                flush()
                held = 0
    flush()
    return sums


def score(texts: pd.Series, model: Model) -> pd.DataFrame:
    """``lang_pred`` and ``score`` (the posterior of that language) of each text."""
    found = [isinstance(t, str) and bool(_LETTER.search(t)) for t in texts]
    at = np.flatnonzero(found)
    names = np.full(len(texts), "und", object)
    best = np.zeros(len(texts))
    if len(at) and model.languages:
        sums = _log_sums([texts.iloc[i] for i in at], model) + model.log_prior
        sums = np.exp(sums - sums.max(axis=1, keepdims=True))
        names[at] = np.array(model.languages, object)[sums.argmax(axis=1)]
        best[at] = sums.max(axis=1) / sums.sum(axis=1)
    return pd.DataFrame({"lang_pred": names, "score": best})


def predictor(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column with the struct ``lang_pred, score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        for batch in texts:
            yield score(batch, sent.value)
        release()

    return predict(F.col(text))


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score``."""
    found = predictor(docs, model, text)
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    both = fresh_name(kept, "_found")
    return docs.select(*kept, found.alias(both)).select(*kept, f"{both}.lang_pred", f"{both}.score")


def keep_identified(
    docs: DataFrame, model: Model, *, text: str = "text", min_score: float = 0.5
) -> DataFrame:
    """The documents with a language of sufficient score, with the columns they have."""
    found = predictor(docs, model, text)
    return docs.where((found["lang_pred"] != "und") & (found["score"] >= min_score))
