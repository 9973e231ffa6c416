"""Exploration: profiles, distinct values, key uniqueness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import is_missing, safe_cast
from starloom.operators.quantiles import (
    exact_quantiles,
    merged_sketches,
    no_quantiles,
    sketch_size,
)

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _rows(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Aggregate once, then turn the structs into rows."""
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of null or NaN per column: (column, percent_null)."""
    return _rows(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                (F.avg(F.when(is_missing(df, c), 1.0).otherwise(0.0)) * 100).alias("percent_null"),
            )
            for c in columns or df.columns
        ],
    )


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each named condition: (check, n_rows), in one pass."""
    return _rows(
        df,
        [
            F.struct(F.lit(name).alias("check"), F.count_if(condition).alias("n_rows"))
            for name, condition in conditions.items()
        ],
    )


def rows_at_max(df: DataFrame, column: str) -> DataFrame:
    """The rows whose value is the column's maximum; NaN is missing, not large."""
    present = F.when(~is_missing(df, column), F.col(f"`{column}`"))
    return df.where(F.col(f"`{column}`") == df.select(F.max(present)).scalar())


def distinct_counts(
    df: DataFrame, columns: Sequence[str], relative_error: float | None = None
) -> DataFrame:
    """Distinct values per column, null being one: (column, n_distinct).

    With ``relative_error`` the counts are estimates from fixed-size sketches.
    """
    structs = []
    for c in columns:
        column = F.col(f"`{c}`")
        if relative_error is None:
            values = F.count_distinct(column)
        else:
            values = F.approx_count_distinct(column, relative_error)
        null = F.coalesce(F.max(F.when(column.isNull(), 1).otherwise(0)), F.lit(0))
        structs.append(F.struct(F.lit(c).alias("column"), (values + null).alias("n_distinct")))
    return _rows(df, structs)


def distinct_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], lg_size: int = 14
) -> DataFrame:
    """A HyperLogLog sketch of each column per group of ``by``: (by, *columns, has_null).

    Stored, they give the distinct counts of any union of groups without reading the rows
    again. ``2^lg_size`` registers bound a sketch, so do the groups that Spark merges.
    ``has_null`` is an array of flags by column.
    """
    text = {c: F.col(f"`{c}`").cast("string") for c in columns}
    sketches = [F.hll_sketch_agg(value, F.lit(lg_size)).alias(c) for c, value in text.items()]
    nulls = F.array(*[F.max(value.isNull()) for value in text.values()]).alias("has_null")
    return df.groupBy(*[F.col(f"`{c}`").alias(f"by_{c}") for c in by]).agg(*sketches, nulls)


def merged_distinct_counts(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimates (column, n_distinct) over all groups of ``distinct_sketches``, null being a
    value; the standard error is ``1.04 / sqrt(2^lg_size)`` of the count."""
    structs = []
    for i, c in enumerate(columns):
        values = F.hll_sketch_estimate(F.hll_union_agg(F.col(f"`{c}`")))
        null = F.max(F.get("has_null", F.lit(i))).cast("int")
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce((values + null).cast("long"), F.lit(0)).alias("n_distinct"),
            )
        )
    return _rows(sketches, structs)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(f"`{column}`")).distinct()


def _key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("key_rows"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key: (n_duplicates)."""
    extra = F.sum(F.col("key_rows") - 1)
    return _key_rows(df, keys).agg(F.coalesce(extra, F.lit(0)).alias("n_duplicates"))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n_rows, n_keys, is_unique)"""
    rows, n_keys = F.coalesce(F.sum("key_rows"), F.lit(0)), F.count(F.lit(1))
    return _key_rows(df, keys).agg(
        rows.alias("n_rows"), n_keys.alias("n_keys"), (rows == n_keys).alias("is_unique")
    )


def _as_numbers(df: DataFrame, columns: Sequence[str], numeric_text: bool) -> dict[str, Column]:
    """The columns to take moments and quartiles of, as doubles; null for NaN."""
    numbers = {}
    for c in columns:
        kind, column = df.schema[c].dataType, F.col(f"`{c}`")
        if isinstance(kind, T.NumericType):
            numbers[c] = F.when(~is_missing(df, c), column.cast("double"))
        elif numeric_text and isinstance(kind, T.StringType):
            number = safe_cast(column, kind, "double")
            numbers[c] = F.when(~F.isnan(number), number)
    return numbers


def sketched_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float], accuracy: int = 1_000
) -> DataFrame:
    """Estimates (column, *quantiles) of double columns that have values.

    The estimates are values of the column. Their ranks are off by some five
    standard deviations where they are off by more than 1/``accuracy`` of the values.
    """
    if not columns:
        return no_quantiles(df.sparkSession, quantiles)
    named = {f"s{i}": c for i, c in enumerate(columns)}
    values = {s: F.col(f"`{c}`") for s, c in named.items()}
    merged = merged_sketches(df, values, sketch_size(accuracy))
    rows = [F.struct(F.lit(c).alias("column"), F.col(s).alias("s")) for s, c in named.items()]
    estimates = [
        F.kll_sketch_get_quantile_double("s", F.lit(p)).alias(q) for q, p in quantiles.items()
    ]
    return (
        merged.select(F.inline(F.array(*rows)))
        .where(F.kll_sketch_get_n_double("s") > 0)
        .select("column", *estimates)
    )


def quantile_ranks(df: DataFrame, estimates: DataFrame, quantiles: Sequence[str]) -> DataFrame:
    """Where estimates (column, *quantiles) lie in the data: (column, quantile, below, upto),
    the shares of values less than, and at most, the estimate; in one pass."""
    found = [r for r in estimates.collect() if r[quantiles[0]] is not None]  # one row a column
    numbers = _as_numbers(df, [r["column"] for r in found], numeric_text=True)
    ranks = [
        F.struct(
            F.lit(r["column"]).alias("column"),
            F.lit(q).alias("quantile"),
            (F.count_if(number < r[q]) / F.count(number)).alias("below"),
            (F.count_if(number <= r[q]) / F.count(number)).alias("upto"),
        )
        for r in found
        for number in [numbers[r["column"]]]
        for q in quantiles
    ]
    return _rows(df, ranks)


def column_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exact: bool = False,
    accuracy: int = 1_000,
    numeric_text: bool = False,
) -> DataFrame:
    """One row per column: counts, moments, quartiles, smallest and largest.

    NaN counts as missing. Quartiles are values of the column. By default they
    come from sketches of fixed size, off by at most 1/accuracy of the values (see
    ``sketched_quantiles``); ``exact`` takes three scans or more instead, guided by them, some of
    them of each column by itself (see ``exact_quantiles``): pass a table written by columns. ``numeric_text`` gives mean, deviation and quartiles for those texts
    that are numbers, beside the smallest and largest text.
    """
    columns = list(columns or df.columns)
    numbers = _as_numbers(df, columns, numeric_text)
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    # Nulls for NaN, and numbers of texts, once, below the aggregation and not in each aggregate.
    values = df.select(
        *[numbers[c].alias(f"n{i}") for i, c in enumerate(columns) if c in numbers],
        *[
            F.col(f"`{c}`").cast("string").alias(f"t{i}")
            for i, c in enumerate(columns)
            if c not in numeric
        ],
    )
    structs = []
    for i, c in enumerate(columns):
        number = F.col(f"n{i}") if c in numbers else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if c in numeric else F.col(f"t{i}")
        fields = {
            "column": F.lit(c),
            "n_rows": F.count(F.lit(1)),
            "n_values": F.count(number if c in numeric else text),
            "mean": F.avg(number),
            "stddev": F.stddev(number),
            "min": F.min(number),
            "max": F.max(number),
            "min_text": F.min(text),
            "max_text": F.max(text),
        }
        structs.append(F.struct(*[value.alias(name) for name, value in fields.items()]))
    ranked = df.select(*[number.alias(c) for c, number in numbers.items()])
    if exact:
        quartiles = exact_quantiles(ranked, list(numbers), QUARTILES)
    else:
        quartiles = sketched_quantiles(ranked, list(numbers), QUARTILES, accuracy)
    return _rows(values, structs).join(quartiles, "column", "left").select(
        "column", "n_rows", "n_values", "mean", "stddev", "min", *QUARTILES, "max",
        "min_text", "max_text",
    )


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
