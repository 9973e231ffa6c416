"""Whitened embeddings by Chebyshev-filtered subspace iteration.

1. Components become integers ``floor(scale * c) + offset``. The fit list holds each
   distinct integer vector once; it is written to the shared folder, so every pass reads the
   same rows. A vector that occurs very often is one row before anything is shuffled.
2. A block ``Q`` of orthonormal columns, as many as the wanted components and some guards,
   is improved in rounds. A pass over the fit list gives ``V Q`` for the covariance ``V``:
   each task adds up ``X'(X Q)`` of its centred rows, and the tasks' matrices are added up by
   rows. A round applies a Chebyshev polynomial in ``V`` by its three-term recurrence, a
   pass per degree. The polynomial is small on the unwanted spectrum, an interval from
   below the least eigenvalue to the block's least Ritz value, and grows fast above it.
   The degree is kept so low that no wanted column drowns in the first one. Then come QR
   and Rayleigh-Ritz.
3. The interval's lower end comes from a Lanczos run whose vector rides along as one more
   column of the first passes. If it is off, rounds get longer; results do not change.
4. Rounds end when the residuals ``|V q - e q|`` of all wanted pairs are certified: below
   ``certified`` times the largest eigenvalue, and either at the rounding of that
   eigenvalue or no longer falling. Else ``ArithmeticError``.

Sums ``S`` and ``n`` are exact. The offset cancels in ``x - S/n``, so passes centre the
numbers without it, which keeps all digits. The driver and the tasks hold matrices of
``dim x block`` numbers, whatever the number of rows.

Cases: rows whose vector is null, empty, shorter than the longest, or holds null, NaN or
infinite components are dropped. Only components with an eigenvalue above rounding can be
whitened, so there are no more than the covariance's rank: none of a single distinct
vector, and no rows then. Repeated rows and keys, and null keys, give rows each.
``deviation`` is null where it does not fit a long. Components beyond ``2^40`` after
scaling raise ``ValueError``. Equal eigenvalues give some orthonormal basis of their space.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import Tables, ship
from .vectors import array_sums, floors, matrix, whole_rows

_EPS = float(np.finfo(float).eps)
_LARGEST = 1 << 40
_EXACT = 2.0**62  # a float estimate below this means that a sum fits a long


@dataclass(frozen=True)
class Spec:
    components: int = 16
    guards: int = 16
    scale: int = 64
    offset: int = 1_000_000
    degree: int = 40  # at most
    spread: float = 18.0  # log of how much more a round may raise the first column than the last
    lanczos: int = 12  # steps
    rounds: int = 100
    certified: float = 1e-10
    seed: int = 0


@dataclass(frozen=True)
class Whitening:
    """What a fit gives. ``sums`` are of the integers with their offset."""

    n: int
    sums: np.ndarray  # exact
    components: np.ndarray  # dim x rank, orthonormal columns
    eigenvalues: np.ndarray  # falling
    trace: float
    residual: float  # largest of the wanted pairs
    passes: int
    identity_error: float
    spec: Spec = Spec()

    @property
    def rank(self) -> int:
        return len(self.eigenvalues)


class _Passes:
    """``V B`` for the covariance ``V`` of a fit list, one pass over it each."""

    def __init__(self, fit: DataFrame, n: int, mean: np.ndarray):
        self.fit, self.n, self.mean, self.count = fit, n, mean, 0

    def sums(self, function, shape: tuple[int, int]) -> np.ndarray:
        """The sum of ``function(rows)`` over centred rows."""
        sent = self.fit.sparkSession.sparkContext.broadcast(self.mean)

        def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
            mean = sent.value
            for i in range(0, batch.num_rows, 4096):
                total += function(matrix(batch.column(0)[i : i + 4096], len(mean)) - mean)

        self.count += 1
        total = array_sums(self.fit, add, shape)
        sent.destroy()
        return total

    def product(self, block: np.ndarray) -> np.ndarray:
        sent = self.fit.sparkSession.sparkContext.broadcast(block)
        total = self.sums(lambda rows: rows.T @ (rows @ sent.value), block.shape)
        sent.destroy()
        return total / self.n


class _Lanczos:
    """A lower bound of the spectrum; its vector joins blocks that pass anyway."""

    def __init__(self, passes: _Passes, start: np.ndarray, steps: int):
        self.passes, self.steps = passes, min(steps, len(start))
        self.basis, self.diagonal, self.beside = [start / np.linalg.norm(start)], [], []

    def product(self, block: np.ndarray) -> np.ndarray:
        if len(self.diagonal) >= self.steps:
            return self.passes.product(block)
        out = self.passes.product(np.c_[block, self.basis[-1]])
        w, basis = out[:, -1], np.array(self.basis)
        self.diagonal.append(float(self.basis[-1] @ w))
        for _ in range(2):
            w = w - basis.T @ (basis @ w)
        size = float(np.linalg.norm(w))
        self.beside.append(size)
        if size <= _EPS * max(map(abs, self.diagonal)) * len(w):
            self.steps = len(self.diagonal)  # the basis spans all that the start can reach
        else:
            self.basis.append(w / size)
        return out[:, :-1]

    def low(self) -> float:
        off = self.beside[:-1]
        values, vectors = np.linalg.eigh(np.diag(self.diagonal) + np.diag(off, 1) + np.diag(off, -1))
        return max(0.0, float(values[0] - abs(self.beside[-1] * vectors[-1, 0])))


def _filtered(product, q: np.ndarray, vq: np.ndarray, top: float, low: float, high: float,
              degree: int) -> np.ndarray:
    """A Chebyshev polynomial in V, small on [low, high] and scaled to 1 at ``top``, times q."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = half / (top - middle)
    scale, before, now = first, q, (vq - middle * q) * (first / half)
    for _ in range(2, degree + 1):
        after = 1 / (2 / first - scale)
        now, before = (
            (product(now) - middle * now) * (2 * after / half) - (scale * after) * before,
            now,
        )
        scale = after
    return now


def _eigenpairs(passes: _Passes, dim: int, spec: Spec) -> tuple[np.ndarray, np.ndarray, float]:
    """``values, vectors, residual`` of the covariance's first components."""
    wanted = min(spec.components, dim)
    width = min(dim, wanted + spec.guards)
    random = np.random.default_rng(spec.seed)
    lanczos = _Lanczos(passes, random.standard_normal(dim), spec.lanczos)
    q = np.linalg.qr(random.standard_normal((dim, width)))[0]
    last = np.inf
    for _ in range(spec.rounds):
        vq = lanczos.product(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        largest = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max())
        if residual <= spec.certified * largest and (
            residual <= 8 * _EPS * largest or residual > last / 2
        ):
            return values[:wanted], q[:, :wanted], residual
        last = residual
        if width == dim and residual <= 64 * dim * _EPS * largest:
            return values[:wanted], q[:, :wanted], residual  # the block spans all there is
        high = float(values[-1])
        low = min(lanczos.low(), high * (1 - 1e-6))
        high = max(high, low + 1e-9 * largest)
        rate = float(np.arccosh(max(1 + 2 * (largest - high) / (high - low), 1.0001)))
        degree = int(max(2, min(spec.degree, spec.spread / rate)))
        top = max(largest, high * (1 + 1e-9))
        q = np.linalg.qr(_filtered(lanczos.product, q, vq, top, low, high, degree))[0]
    raise ArithmeticError(f"no certified components after {spec.rounds} rounds: residual {last:g}")


def fit(vectors: DataFrame, *, vector: str = "embedding", spec: Spec = Spec()) -> Whitening:
    """The whitening of a table of vectors, from its distinct integer vectors."""
    spark = vectors.sparkSession
    ship(spark)
    kept, dim = whole_rows(vectors, vector)
    tables = Tables(spark)
    x = floors(F.col(f"`{vector}`"), spec.scale).alias("x")
    distinct = tables.write(kept.select(x).distinct(), "fit-list")
    n = distinct.count()  # from the files' footers
    nothing = np.empty((dim, 0))
    if not n:
        tables.drop(distinct)
        return Whitening(0, np.empty(0, object), nothing, np.empty(0), 0.0, 0.0, 0, 0.0, spec)

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        rows = matrix(batch.column(0), dim)
        if abs(rows).max() > _LARGEST:
            raise ValueError(f"a component lies beyond {_LARGEST} after scaling")
        total += rows.sum(axis=0)

    sums = array_sums(distinct, add, (1, dim), np.int64)[0]
    passes = _Passes(distinct, n, sums / n)
    trace = passes.sums(lambda rows: np.array([[(rows * rows).sum()]]), (1, 1))[0, 0] / n
    exact = np.array([int(s) + n * spec.offset for s in sums], object)
    if trace <= 0:
        tables.drop(distinct)
        return Whitening(n, exact, nothing, np.empty(0), 0.0, 0.0, passes.count, 0.0, spec)
    values, q, residual = _eigenpairs(passes, dim, spec)
    real = values > dim * _EPS * values[0]
    values, q = values[real], q[:, real]
    error = _identity_error(passes, q / np.sqrt(values))
    tables.drop(distinct)
    return Whitening(n, exact, q, values, trace, residual, passes.count, error, spec)


def _identity_error(passes: _Passes, turn: np.ndarray) -> float:
    """How far the covariance of the whitened rows is from the identity, at most."""
    rank = turn.shape[1]
    sent = passes.fit.sparkSession.sparkContext.broadcast(turn)

    def moments(rows: np.ndarray) -> np.ndarray:
        white = rows @ sent.value
        return np.r_[white.T @ white, white.sum(axis=0)[None]]

    total = passes.sums(moments, (rank + 1, rank)) / passes.n
    sent.destroy()
    mean = total[-1]
    return float(abs(total[:-1] - np.outer(mean, mean) - np.eye(rank)).max())


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Exact sums of squares by row; null where one does not fit a long."""
    rough = (centred.astype(float) ** 2).sum(axis=1)
    if not len(rough) or rough.max() < _EXACT:
        whole = centred.astype(np.int64)
        return (whole * whole).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in centred]
    return [v if v < 1 << 63 else None for v in exact]


def transform(
    vectors: DataFrame, model: Whitening, *, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Per row with a whole vector ``key, deviation, whitened`` (an array by component)."""
    spark, spec = vectors.sparkSession, model.spec
    kept, dim = whole_rows(vectors, vector)
    kind = vectors.schema[key].dataType
    schema = T.StructType([
        T.StructField("k", kind), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])
    named = [F.col("k").alias(key), "deviation", "whitened"]
    if not dim or not model.rank:
        return spark.createDataFrame([], schema).select(*named)
    if dim != len(model.sums):
        raise ValueError(f"whitening of vectors of length {len(model.sums)}, not {dim}")
    ship(spark)
    n, offset = model.n, spec.offset
    # n * x - S without the offset; as Python integers where longs would not hold the products
    sums = np.array([s - n * offset for s in model.sums], object)
    small = n * _LARGEST < 1 << 62 and max(map(abs, sums)) < 1 << 62
    turn = model.components / np.sqrt(model.eigenvalues)
    sent = spark.sparkContext.broadcast((sums.astype(np.int64) if small else sums, turn))

    def whiten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, turn = sent.value
        for batch in batches:
            rows = matrix(batch.column(1), dim)
            times_n = (rows if small else rows.astype(object)) * n - sums
            white = (times_n.astype(float) / n) @ turn
            columns = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), turn.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_deviations(times_n), pa.int64()),
                 columns.cast(pa.list_(pa.float64()))],
                ["k", "deviation", "whitened"],
            )

    x = floors(F.col(f"`{vector}`"), spec.scale).alias("x")
    return kept.select(F.col(f"`{key}`").alias("k"), x).mapInArrow(whiten, schema).select(*named)


def whiten(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", spec: Spec = Spec()
) -> DataFrame:
    """A row per whole vector and component: ``key, component`` (from 1), ``n, deviation,
    whitened, explained, identity_error``."""
    model = fit(vectors, vector=vector, spec=spec)
    rows = transform(vectors, model, key=key, vector=vector)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    out = rows.select(F.col(f"`{key}`").alias("k"), "deviation", F.posexplode("whitened"))
    return out.select(
        F.col("k").alias(key),
        (F.col("pos") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.get(explained.cast("array<double>"), F.col("pos")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
