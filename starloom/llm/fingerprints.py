"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (what lies between its line breaks, blank ones
too). Every paragraph is hashed to a wide vector, and a fingerprint is the sum of its
paragraphs' vectors modulo powers of two. So it does not depend on their order, and
paragraphs are put in or taken out by adding or subtracting their vectors:
``print(a + "\\n" + b) == print(a) + print(b)``. The vector has two parts:

- ``checks`` lanes modulo 2^64, uniform, from the paragraph's digest. Texts of other
  paragraphs differ here, but for a chance like that of a 512-bit hash.
- ``lanes`` lanes modulo 2^32, the sum of a vector of +1 and -1 for each window of ``words``
  words (a paragraph of fewer words is one window, one without words has none). The
  difference of two fingerprints is that of what the texts do not share, and its mean
  square estimates how many windows that are, so ``likeness`` is
  ``1 - |A - B|^2 / (|A|^2 + |B|^2)``, within 0 and 1: 1 for equal texts, about 0 for
  unrelated ones, with a standard error of about ``1 / sqrt(lanes)``.

An additive hash of this width resists chance, not an adversary who solves for sums.

``edits`` needs each document's successor in the falling order of keys. Documents are dealt
to ranges of keys, one per shuffle partition; a key with very many rows is cut into
several ranges by its texts' hashes. Each range also gets the first document of the next
one as a visitor, and is then sorted and read once as a stream. So texts are shuffled
once, and no task or driver holds more than a batch of them.

Cases: a null text counts as empty, and an empty one is a single blank paragraph; likeness
is 0 between texts of which one has no words, unless the fingerprints are equal; a single document is its
own successor; null keys come last, rows of equal keys in the order of their texts'
hashes, and equal rows follow one another; an empty table gives no rows; other columns are
not read. Keys are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import ship
from .text import _IS_WHITE, mix, windows, word_hashes

_SLICE = 1 << 16  # windows whose signs are unpacked at once
_OUTPUT = 1024  # rows a task sends on together


@dataclass(frozen=True)
class Spec:
    checks: int = 8
    lanes: int = 128
    words: int = 3

    def __post_init__(self) -> None:
        if not 0 < self.checks <= 8 or self.lanes <= 0 or self.lanes % 64:
            raise ValueError("1 to 8 checks, and lanes in multiples of 64")


@dataclass(frozen=True)
class Print:
    """A sum of paragraphs' vectors."""

    checks: np.ndarray  # uint64
    lanes: np.ndarray  # int32

    def __add__(self, other: Print) -> Print:
        return Print(self.checks + other.checks, self.lanes + other.lanes)

    def __sub__(self, other: Print) -> Print:
        return Print(self.checks - other.checks, self.lanes - other.lanes)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Print) and self.to_bytes() == other.to_bytes()

    def to_bytes(self) -> bytes:
        return self.checks.astype("<u8").tobytes() + self.lanes.astype("<i4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, spec: Spec = Spec()) -> Print:
        cut = 8 * spec.checks
        return cls(np.frombuffer(raw[:cut], "<u8"), np.frombuffer(raw[cut:], "<i4"))

    def likeness(self, other: Print) -> float:
        if self == other:
            return 1.0
        own, their = self.lanes.astype(float), other.lanes.astype(float)
        sizes = own @ own + their @ their
        if not sizes:
            return 0.0
        apart = (self - other).lanes.astype(float)
        return float(min(1.0, max(0.0, 1 - apart @ apart / sizes)))


def _windows(paragraphs: list[bytes], words: int) -> np.ndarray:
    """Hashes of the windows of words that lie within a paragraph."""
    raw = b"\n".join(paragraphs)
    hashes = word_hashes(raw)
    if not len(hashes):
        return hashes
    # words by paragraph: as many as there are starts of words before each break
    data = np.frombuffer(raw, np.uint8)
    white = np.ones(len(data) + 1, bool)
    white[1:] = _IS_WHITE[data]
    starts = np.flatnonzero(white[:-1] & ~white[1:])
    breaks = np.flatnonzero(data == 10)
    edges = np.r_[0, np.searchsorted(starts, breaks), len(starts)]
    sizes = np.diff(edges)
    n = len(hashes)
    if n >= words:
        place = np.repeat(np.arange(len(sizes)), sizes)
        found = windows(hashes, words)[place[: n - words + 1] == place[words - 1 :]]
    else:
        found = hashes[:0]
    short = [windows(hashes[edges[i] : edges[i + 1]], sizes[i])
             for i in np.flatnonzero((sizes > 0) & (sizes < words))]
    return np.concatenate([found, *short])


def fingerprint(text: str | None, spec: Spec = Spec()) -> Print:
    """The fingerprint of a whole text."""
    paragraphs = (text or "").encode("utf-8", "replace").split(b"\n")
    digests = b"".join([hashlib.sha512(p).digest() for p in paragraphs])
    checks = np.frombuffer(digests, "<u8").reshape(-1, 8)[:, : spec.checks].sum(axis=0)
    found = _windows(paragraphs, spec.words)
    rounds = spec.lanes // 64
    ones = np.zeros(spec.lanes, np.int64)
    for i in range(0, len(found), _SLICE):
        part = found[i : i + _SLICE]
        bits = np.empty((len(part), rounds), "<u8")
        for r in range(rounds):
            bits[:, r] = mix(part + np.uint64((0x9E3779B97F4A7C15 * (r + 1)) % (1 << 64)))
        ones += np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return Print(checks, (2 * ones - len(found)).astype(np.int32))  # wraps, as sums do


def fingerprints(docs: DataFrame, *, text: str = "text", spec: Spec = Spec()) -> Column:
    """A column with the fingerprint of each text, as bytes."""
    ship(docs.sparkSession)

    @F.pandas_udf("binary")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: fingerprint(t, spec).to_bytes(), na_action=None)

    return prints(F.col(f"`{text}`"))


def edited(text: str, after: str) -> tuple[str, int]:
    """``text`` with its last half replaced by as much of ``after``, and the number of code points
    that stay."""
    half = len(text) // 2
    kept = len(text) - half
    return text[:kept] + after[:half], kept


class _Successors:
    """Rows of ranges in order, each with the text that comes next."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.held: tuple | None = None  # range, key, text, print of the paragraphs before and after the cut

    def parts(self, text: str) -> tuple[Print, Print, int]:
        """Prints of the paragraphs before the one the edit begins in, and of the others, which
        begin at the third value."""
        kept = len(text) - len(text) // 2
        start = text.rfind("\n", 0, kept) + 1
        tail = fingerprint(text[start:], self.spec)
        if not start:
            return tail - tail, tail, 0
        return fingerprint(text[: start - 1], self.spec), tail, start

    def rows(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for place, visits, key, text in zip(*columns, strict=True):
            text = text or ""
            now = (place, visits, key, text, self.parts(text))
            if self.held is not None and self.held[0] == place and not self.held[1]:
                yield self.row(self.held, now)
            self.held = now

    def row(self, own: tuple, following: tuple) -> tuple:
        _, _, key, text, (head, tail, start) = own
        _, _, _, after, (next_head, next_tail, _) = following
        changed, _ = edited(text, after)
        # the paragraphs before the cut stay; what follows is taken out, the edit's put in
        whole = head + tail
        other = head + fingerprint(changed[start:], self.spec)
        return (
            key, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
            whole.to_bytes(), other.to_bytes(), whole.likeness(other),
            whole.likeness(next_head + next_tail),
        )


def _ranges(docs: DataFrame, n: int) -> list[int]:
    """Keys that cut the documents into ``n`` ranges of about as many rows, rising."""
    shares = [(i + 1) / n for i in range(n - 1)]
    cuts = docs.agg(F.percentile_approx("k", shares, F.lit(min(20 * n, 1 << 24)))).first()[0] if n > 1 else []
    return list(cuts or [])


def _placed(docs: DataFrame, cuts: list[int]) -> DataFrame:
    """With ``place``, the number of a row's range in the falling order of keys."""
    n = len(cuts) + 1
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        k = keys.fillna(0).to_numpy(np.int64)
        first, last = np.searchsorted(bounds, k, "left"), np.searchsorted(bounds, k, "right")
        # a key that several cuts repeat has several ranges: hashes fall as places rise
        share = hashes.to_numpy(np.int64).astype(float) / 2.0**64 + 0.5
        at = first + np.minimum((share * (last - first + 1)).astype(int), last - first)
        at = np.where(last - first > 1, at, first)
        return pd.Series(np.where(keys.isna(), n - 1, n - 1 - at).astype(np.int32))

    if n == 1:
        return docs.withColumn("place", F.lit(0))
    return docs.withColumn("place", place("k", "h"))


def edits(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", spec: Spec = Spec()
) -> DataFrame:
    """Per document ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (bytes),
    ``near_edited, near_next``: how it compares with its edited text and with its successor."""
    spark = docs.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(
        F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")
    )
    own = own.select("k", "t", F.xxhash64("t").alias("h"))
    placed = _placed(own, _ranges(own, n))
    falling = [F.col("k").desc_nulls_last(), F.col("h").desc()]
    # the first document of each range: one row a range, and keys before texts, which are long
    first = placed.groupBy("place").agg(
        F.max(F.struct(F.col("k").isNotNull().alias("known"), "k", "h")).alias("first")
    )
    heads = sorted((r["place"], r["first"]["k"], r["first"]["h"]) for r in first.collect())
    if not heads:
        return spark.createDataFrame([], _schema(key))
    before = [heads[i - 1][0] for i in range(len(heads))]
    visits = spark.createDataFrame(
        [(k, h, place) for (_, k, h), place in zip(heads, before, strict=True)],
        "k long, h long, place int",
    )
    on = own["k"].eqNullSafe(visits["k"]) & (own["h"] == visits["h"])
    visitors = own.join(F.broadcast(visits), on).select(visits["place"], own["k"], own["h"], own["t"])
    visitors = visitors.dropDuplicates(["place"])  # equal rows
    columns = ["place", F.lit(False).alias("visits"), "k", "t", "h"]
    visiting = ["place", F.lit(True).alias("visits"), "k", "t", "h"]
    dealt = placed.select(*columns).unionByName(visitors.select(*visiting))
    ordered = dealt.repartitionById(n, F.col("place")).sortWithinPartitions("place", "visits", *falling)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        successors, names, rows = _Successors(spec), _NAMES, []
        for batch in batches:
            for row in successors.rows(batch):
                rows.append(row)
                if len(rows) == _OUTPUT:
                    yield _batch(rows, names)
                    rows = []
        if rows:
            yield _batch(rows, names)

    found = ordered.select("place", "visits", "k", "t").mapInArrow(compare, _schema("k"))
    return found.withColumnRenamed("k", key)


_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _schema(key: str) -> T.StructType:
    kinds = [T.LongType(), T.StringType(), T.BinaryType(), T.BinaryType(), T.DoubleType(), T.DoubleType()]
    return T.StructType([T.StructField(n, k) for n, k in zip([key, *_NAMES], [T.LongType(), *kinds], strict=True)])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["k", *names])
