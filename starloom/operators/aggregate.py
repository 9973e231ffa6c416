"""Averages, pivots and distinct keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import fresh_name


def average_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The average of every numeric column, under its own name."""
    numeric = [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys
    ]
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[F.avg(f"`{c}`").alias(c) for c in numeric]
    )


def pivot_average(
    df: DataFrame,
    keys: Sequence[str],
    pivot: str,
    value: str,
    values: Mapping[str, str],
    measures: Mapping[str, str],
    zero_fill: bool = True,
) -> DataFrame:
    """Average ``measures`` and, per entry of ``values``, one pivoted column.

    ``measures`` maps output names to columns, ``values`` output names to values
    of the ``pivot`` column. With ``zero_fill`` a row of another pivot value
    enters the average as 0, so the result is the sum over the group's rows
    divided by all of them; without, only rows of the pivot value count.
    """
    averages = [F.avg(f"`{column}`").alias(name) for name, column in measures.items()]
    for name, wanted in values.items():
        cell = F.when(F.col(f"`{pivot}`") == wanted, F.col(f"`{value}`"))
        averages.append(F.avg(cell.otherwise(0) if zero_fill else cell).alias(name))
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*averages)


def key_sets(
    df: DataFrame, sets: Mapping[str, Sequence[str]], *aggregates: Column
) -> tuple[DataFrame, dict[str, Column]]:
    """Distinct values of several key sets, with ``aggregates`` of each, from one scan of ``df``.

    Returns one frame holding all sets, the aggregates after its keys, and per set a condition
    that picks its rows. The sets are to be disjoint.
    """
    columns = [c for names in sets.values() for c in names]
    number = fresh_name(columns, "key_set")
    table = df.groupingSets(
        [[F.col(f"`{c}`") for c in names] for names in sets.values()], *[F.col(f"`{c}`") for c in columns]
    ).agg(F.grouping_id().alias(number), *aggregates)
    # A grouping id has one bit per column, the first column's highest; the bit
    # is 0 where the column belongs to the set.
    picks = {}
    for name, members in sets.items():
        bits = ["0" if c in members else "1" for c in columns]
        picks[name] = F.col(number) == int("".join(bits), 2)
    return table, picks
