"""Predicates of the data checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the column's type has one."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_blank(text: Column) -> Column:
    """Text of white space only, tabs and line breaks included."""
    return ~text.rlike(r"(?U)\S")


def outside(value: Column, low, high) -> Column:
    """Below ``low`` or above ``high``; both ends count as inside."""
    return ~value.between(low, high)
