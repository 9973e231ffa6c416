"""Counted keys: what dimensions, audit and analyses need of the arrivals, in one small table.

One scan adds up additive parts per foreign key: rows, and per measure the sum and the
number of its values. Averages over any coarser unit follow from these. The table is
reduced before its only shuffle and written once, so nothing of the fact's size is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import date_of_day
from starloom.operators import key_sets
from starloom.plans.dimensions import DIMENSIONS, key_columns
from starloom.scratch import settle
from starloom.specs import StarSpec

ROWS = "n_arrivals"


def _parts(measure: str) -> tuple[str, str]:
    return f"sum_{measure}", f"values_{measure}"


@dataclass(frozen=True)
class CountedKeys:
    """The counted keys of some dimensions."""

    table: DataFrame
    picks: Mapping[str, Column]
    columns: Mapping[str, Sequence[str]]  # per dimension, those of its key first
    measures: Sequence[str]
    spec: StarSpec

    def _rows(self, dimension: str) -> DataFrame:
        return self.table.where(self.picks[dimension])

    def keys(self, dimension: str) -> DataFrame:
        """The distinct keys, as the dimension's builder takes them."""
        own = list(key_columns(dimension, self.spec))
        rows = self._rows(dimension).select(*own)
        return rows if own == list(self.columns[dimension]) else rows.distinct()

    def counts(self, dimension: str, by: Sequence[str] = ()) -> DataFrame:
        """The parts per key, named as in the fact, and per column of ``by``."""
        name, key = fact_key(dimension, self.spec)
        parts = [ROWS, *[p for m in self.measures for p in _parts(m)]]
        return (
            self._rows(dimension)
            .groupBy(key.alias(name), *by)
            .agg(*[F.sum(p).alias(p) for p in parts])
        )


def fact_key(dimension: str, spec: StarSpec) -> tuple[str, Column]:
    """A dimension's key column in the fact, and how it comes from the key columns."""
    return {
        "date": (spec.date_key, date_of_day(F.col("date_day")).cast("string")),
        "country": (spec.country_key, F.col("code_used")),
        "airport": (spec.port_key, F.col("port")),
        "demographics": (spec.state_key, F.col("state_used")),
    }[dimension]


def count_keys(
    arrivals: DataFrame,
    spec: StarSpec,
    dimensions: Sequence[str] = DIMENSIONS,
    measures: Sequence[str] = ("i94bir",),
    also: Mapping[str, Sequence[str]] | None = None,
) -> CountedKeys:
    """Count the keys of ``dimensions`` in one scan; ``also`` names columns of the arrivals that
    a dimension's keys are counted by as well."""
    by = {d: key_columns(d, spec) | {c: F.col(f"`{c}`") for c in (also or {}).get(d, ())} for d in dimensions}
    keys = arrivals.select(
        *[c.alias(name) for columns in by.values() for name, c in columns.items()],
        *[F.col(f"`{m}`").alias(f"_of_{m}") for m in measures],
    )
    parts = [F.count(F.lit(1)).alias(ROWS)]
    for m in measures:
        total, values = _parts(m)
        parts += [F.sum(f"_of_{m}").alias(total), F.count(f"_of_{m}").alias(values)]
    table, picks = key_sets(keys, {d: list(columns) for d, columns in by.items()}, *parts)
    return CountedKeys(settle(table), picks, {d: list(c) for d, c in by.items()}, tuple(measures), spec)
