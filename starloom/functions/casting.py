"""Casts that give null, not an error, for values that do not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cast names a source spec may use, and the Spark type of each.
CAST_TYPES = {
    "int": "int",
    "long": "long",
    "float": "float",
    "double": "double",
    "str": "string",
    "string": "string",
    "date": "date",
}


# Text that is a number. Text that is none is told apart by pattern, because a
# failing cast costs an exception per row: some twenty times the match.
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NO_FINITE_NUMBER = r"(?i)^\s*([+-]?inf(inity)?|nan)\s*$"


def safe_cast(column: Column, source_type: T.DataType, to: str) -> Column:
    """Cast ``column`` of ``source_type`` to the type named ``to``.

    Text such as ``2016.0`` is no integer to Spark's casts, so text is read as
    a double and then truncated; whole numbers that are to be long directly.
    """
    if to not in CAST_TYPES:
        raise ValueError(f"unknown cast type {to!r} (allowed: {', '.join(CAST_TYPES)})")
    target = CAST_TYPES[to]
    if not isinstance(source_type, T.StringType) or target in ("string", "date"):
        return column.try_cast(target)
    is_number = column.rlike(NUMBER)
    if target == "int":
        return F.when(is_number, column.try_cast("double").try_cast(target))
    if target == "long":
        return F.when(column.rlike(WHOLE), column.try_cast(target)).when(
            is_number, column.try_cast("double").try_cast(target)
        )
    return F.when(is_number | column.rlike(NO_FINITE_NUMBER), column.try_cast(target))
