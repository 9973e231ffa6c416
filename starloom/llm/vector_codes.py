"""Vectors compressed to one codebook index per part, found by equal-average search.

1. A vector's components become integers ``floor(scale * v)``, and the vector is cut into
   equal consecutive parts. Each part position has a codebook of its own.
2. A codebook starts as that part of the vectors with the least keys. In each round every
   part goes to its nearest entry (squared Euclidean distance, ties to the lower index),
   and an entry becomes the floor of the mean of its parts; unused entries stay. A task
   adds its parts up per entry before anything is shuffled, so a round sends a codebook's
   worth of numbers per task, however often one vector occurs.
3. The nearest entry is found by equal-average search: entries are sorted by the sum of
   their components, and a part looks outward from its own sum. By Cauchy-Schwarz an entry
   whose sum differs by ``g`` is at least ``g * g / width`` away, so the search ends once
   that strictly exceeds the best distance so far: at equality an entry could still tie.
   All of it is exact integer arithmetic.

The codebooks (``entries`` whole vectors) are all that the driver and the tasks hold.

Cases: rows whose vector is null, empty, shorter than the longest, or holds null, NaN or
infinite components are dropped; with fewer rows than entries the codebooks are as short
as that; without rows there are none, and no codes. Null keys come last among the least,
equal keys in the order of their vectors; repeated rows count one by one. Null labels are
equal to each other. A vector whose length the parts do not divide, or with components
beyond ``2^30 / width`` after scaling, raises ``ValueError``. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import Tables, ship
from .vectors import array_sums, floors, matrix, whole_rows

_SLICE = 4096  # vectors that a task searches for at once


@dataclass(frozen=True)
class Spec:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


class Nearest:
    """Nearest entries of all codebooks (parts x entries x width) by equal-average search."""

    def __init__(self, books: np.ndarray):
        self.parts, self.entries, self.width = books.shape
        sums = books.sum(axis=2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, axis=1).ravel()
        self.sorted = np.take_along_axis(books, self.order[:, :, None], axis=1).reshape(-1, self.width)
        self.index = self.order.ravel()
        self.looked_at = 0  # entries whose distance was computed

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index, distance)`` of the parts of ``x`` (rows x parts x width), by row and part."""
        limit = (1 << 30) // self.width
        if x.size and (x.max() > limit or x.min() < -limit):
            raise ValueError(f"a component lies beyond {limit} after scaling")
        found = [self._search(x[i : i + _SLICE]) for i in range(0, len(x), _SLICE)]
        if not found:
            empty = np.empty((0, self.parts), np.int64)
            return empty, empty
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, m, far = len(x), self.entries, np.int64(1) << 31
        part = np.tile(np.arange(self.parts), rows)
        x = x.reshape(-1, self.width)
        own = x.sum(axis=1)
        first, last = part * m, part * m + m  # where this part's entries stand
        right = np.empty(len(x), np.int64)  # the next entry with a sum not below the part's
        for p in range(self.parts):
            right[p :: self.parts] = p * m + np.searchsorted(self.sums[p * m : p * m + m], own[p :: self.parts])
        left = right - 1
        best = np.full(len(x), (1 << 61) // self.width, np.int64)
        index = np.full(len(x), m, np.int64)
        open_ = np.arange(len(x))
        while len(open_):
            a, b, s = left[open_], right[open_], own[open_]
            below = np.where(a >= first[open_], s - self.sums[np.maximum(a, 0)], far)
            above = np.where(b < last[open_], self.sums[np.minimum(b, len(self.sums) - 1)] - s, far)
            gap = np.minimum(below, above)
            go = (gap < far) & (gap * gap <= best[open_] * self.width)
            open_, a, b, down = open_[go], a[go], b[go], (below <= above)[go]
            at = np.where(down, a, b)
            left[open_] = a - down
            right[open_] = b + ~down
            apart = x[open_] - self.sorted[at]
            distance, entry = (apart * apart).sum(axis=1), self.index[at]
            self.looked_at += len(at)
            known = best[open_]
            better = (distance < known) | ((distance == known) & (entry < index[open_]))
            best[open_[better]], index[open_[better]] = distance[better], entry[better]
        return index.reshape(rows, self.parts), best.reshape(rows, self.parts)


@dataclass(frozen=True)
class Codebooks:
    """The trained entries, ``parts x entries x width`` integers."""

    entries: np.ndarray
    spec: Spec = Spec()

    @property
    def sha256(self) -> str:
        text = ",".join(map(str, self.entries.ravel().tolist()))
        return hashlib.sha256(text.encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The integer vectors that codes (rows x parts) stand for."""
        chosen = self.entries[np.arange(self.entries.shape[0]), codes]
        return chosen.reshape(len(codes), -1)


def _whole_parts(vectors: DataFrame, vector: str, spec: Spec) -> tuple[DataFrame, int]:
    kept, dim = whole_rows(vectors, vector)
    if dim % spec.parts:
        raise ValueError(f"{spec.parts} parts do not divide vectors of length {dim}")
    return kept, dim


def train(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", spec: Spec = Spec()
) -> Codebooks:
    """The codebooks of a table of vectors."""
    kept, dim = _whole_parts(vectors, vector, spec)
    x = floors(F.col(f"`{vector}`"), spec.scale).alias("x")
    start = np.array(_first(kept.select(F.col(f"`{key}`").alias("k"), x), spec.entries), np.int64)
    width = dim // spec.parts
    books = start.reshape(len(start), spec.parts, width).transpose(1, 0, 2).copy()
    if not len(start):
        return Codebooks(books, spec)
    for _ in range(spec.rounds):
        books = _updated(kept.select(x), books)
    return Codebooks(books, spec)


def _first(rows: DataFrame, n: int) -> list[list[int]]:
    """The vectors of the ``n`` least keys; keys alone are ranked first, as they are short."""
    by_key = F.col("k").asc_nulls_last()
    least = [row["k"] for row in rows.select("k").orderBy(by_key).limit(n).collect()]
    if len(least) == n and least[-1] is not None:
        rows = rows.where(F.col("k") <= F.lit(least[-1]))
    return [row["x"] for row in rows.orderBy(by_key, "x").limit(n).collect()]


def _updated(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: means of what their entries are nearest to."""
    parts, entries, width = books.shape
    spark = kept.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(books)

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        x = matrix(batch.column(0), parts * width).reshape(-1, parts, width)
        index, _ = Nearest(sent.value)(x)
        slot = (index + np.arange(parts) * entries).ravel()
        np.add.at(total, slot, np.c_[x.reshape(-1, width), np.ones(len(slot), np.int64)])

    sums = array_sums(kept, add, (parts * entries, width + 1), np.int64)
    sent.destroy()
    count = sums[:, -1:]
    means = np.where(count > 0, sums[:, :-1] // np.maximum(count, 1), books.reshape(-1, width))
    return means.reshape(books.shape)


def encode(
    vectors: DataFrame,
    books: Codebooks,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    more: Iterable[str] = (),
) -> DataFrame:
    """``key``, the columns ``more``, ``codes`` (an index per part) and ``error`` (the sum of
    the squared distances) of the rows with whole vectors."""
    spec, entries = books.spec, books.entries
    parts, m, width = entries.shape
    more = list(more)
    spark = vectors.sparkSession
    kept, dim = _whole_parts(vectors, vector, spec)
    fields = [vectors.schema[key], *[vectors.schema[c] for c in more]]
    names = [f"c{i}" for i in range(len(fields))]  # whatever the columns are called
    schema = T.StructType(
        [T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)]
        + [T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())]
    )
    out = [F.col(n).alias(f.name) for n, f in zip(names, fields, strict=True)]
    if not dim or not m:
        return spark.createDataFrame([], schema).select(*out, "codes", "error")
    if dim != parts * width:
        raise ValueError(f"codebooks for vectors of length {parts * width}, not {dim}")
    ship(spark)
    sent = spark.sparkContext.broadcast(entries)

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(sent.value)
        for batch in batches:
            *own, x = batch.columns
            index, distance = nearest(matrix(x, dim).reshape(-1, parts, width))
            codes = pa.FixedSizeListArray.from_arrays(pa.array(index.ravel(), pa.int32()), parts)
            columns = [*own, codes.cast(pa.list_(pa.int32())), pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "codes", "error"])

    chosen = [F.col(f"`{f.name}`").alias(n) for f, n in zip(fields, names, strict=True)]
    numbers = floors(F.col(f"`{vector}`"), spec.scale).alias("x")
    return kept.select(*chosen, numbers).mapInArrow(code, schema).select(*out, "codes", "error")


def hex_code(codes: Column) -> Column:
    """Two lower-case hex digits per index."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def compress(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    spec: Spec = Spec(),
) -> DataFrame:
    """Per row with a whole vector ``key, label, code`` (hex), ``error``, ``label_error`` (the
    errors of equal labels added up) and ``codebooks_sha256``.

    The codes are written once; labels are added up before they meet the rows again, and a
    label with very many rows is split by the join.
    """
    tables = Tables(vectors.sparkSession)
    books = train(vectors, key=key, vector=vector, spec=spec)
    coded = encode(vectors, books, key=key, vector=vector, more=[label]).toDF("k", "l", "codes", "error")
    coded = tables.write(coded.select("k", "l", hex_code(F.col("codes")).alias("code"), "error"), "codes")
    sums = tables.write(coded.groupBy("l").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.alias("c").join(sums.alias("s"), F.col("c.l").eqNullSafe(F.col("s.l")))
    return joined.select(
        F.col("k").alias(key), F.col("c.l").alias(label), "code", "error", "label_error",
        F.lit(books.sha256).alias("codebooks_sha256"),
    )
