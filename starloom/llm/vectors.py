"""Helpers for tables of vectors: which rows are whole, integer forms, sums of arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """Not null, not empty, and without null, NaN or infinite components."""
    infinite = F.lit(float("inf"))

    def finite(v: Column) -> Column:
        v = v.cast("double")
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != infinite)

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def floors(vector: Column, scale: int) -> Column:
    """``floor(scale * v)`` of every component, as longs."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * scale).cast("long"))


def whole_rows(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows with whole vectors of the greatest length, and that length (0 without rows).

    A shorter vector lacks components and goes like one that holds nulls.
    """
    column = F.col(f"`{vector}`")
    kept = vectors.where(whole(column))
    dim = kept.agg(F.max(F.size(column))).first()[0] or 0
    return kept.where(F.size(column) == dim), dim


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """A batch's column of vectors as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def array_sums(
    df: DataFrame,
    add: Callable[[np.ndarray, pa.RecordBatch], None],
    shape: tuple[int, int],
    kind: type = np.float64,
) -> np.ndarray:
    """The sum over all tasks of a matrix that ``add(total, batch)`` fills.

    A task sends its matrix by rows, those of zeros not at all; Spark adds the rows up.
    Tasks, shuffle and driver each hold ``shape`` numbers, whatever the number of rows.
    """
    rows, columns = shape
    is_long = np.issubdtype(kind, np.integer)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            add(total, batch)
        used = np.flatnonzero(total.any(axis=1))
        values = pa.array(list(total[used]), pa.list_(pa.int64() if is_long else pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), values], ["at", "v"])

    sent = df.mapInArrow(partial, f"at long, v array<{'long' if is_long else 'double'}>")
    sums = sent.groupBy("at").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(columns)]).alias("v"))
    out = np.zeros(shape, kind)
    for row in sums.collect():  # at most ``rows`` of them
        out[row["at"]] = row["v"]
    return out
