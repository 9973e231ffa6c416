"""Digests of whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.predicates import FRACTIONAL

# Fixed value: the second digest is seeded with it, so that the two are independent.
SECOND_SEED = 0x5851F42D

ATOMIC = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType,
          T.TimestampNTZType)


def can_digest(df: DataFrame) -> bool:
    """Whether equal rows of ``df`` have equal digests: nested values may hide a NaN or a -0.0."""
    return bool(df.columns) and all(isinstance(f.dataType, ATOMIC) for f in df.schema)


def row_digests(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit digests of a row, equal for rows that grouping takes for equal: nulls
    equal each other, as do NaNs, and -0.0 equals 0.0.

    Spark's hash passes over nulls, so their places are hashed as well.
    """
    values, nulls = [], F.lit("")
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, FRACTIONAL):
            column = F.when(F.isnan(column), float("nan")).otherwise(column + F.lit(0.0))
        values.append(column)
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.xxhash64(*values, nulls), F.xxhash64(F.lit(SECOND_SEED), nulls, *reversed(values))
