"""Cleaning: casts, missing values, duplicates, unneeded columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import safe_cast
from starloom.specs import SourceSpec


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what}: no column {', '.join(missing)}")


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast columns by name, in one projection."""
    require_columns(df, casts, "cast_columns")
    return df.withColumns(
        {
            name: safe_cast(F.col(f"`{name}`"), df.schema[name].dataType, to)
            for name, to in casts.items()
        }
    )


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    require_columns(df, names, "drop_columns")
    return df.drop(*names)


def drop_missing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop rows with null or NaN in any of the columns."""
    require_columns(df, names, "drop_missing")
    return df.dropna(subset=list(names))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns.

    Null keys are equal to each other. This is an aggregation and not a window,
    so each map task sends at most one row per key and a key with very many
    rows fits in one reducer.
    """
    require_columns(df, [*keys, *order], "dedupe")
    rest = [c for c in (*order, *df.columns) if c not in keys]
    rest = list(dict.fromkeys(rest))
    if not rest:
        return df.select(*df.columns).distinct()
    first = F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("first")
    rows = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(first)
    return rows.select(
        *[
            F.col(f"`{c}`") if c in keys else F.col(f"first.`{c}`").alias(c)
            for c in df.columns
        ]
    )


def clean(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """All cleaning steps of a source spec.

    Rows with missing values go before duplicates do, so a row that is about to
    vanish never replaces its complete twin. Dropped columns go before the
    shuffle of ``dedupe`` unless it needs them.
    """
    what = f"source {spec.path}"
    for names in (spec.casts, spec.dropna, spec.dedupe, spec.dedupe_order, spec.drop):
        require_columns(df, names, what)
    if spec.casts:
        df = cast_columns(df, spec.casts)
    if spec.dropna:
        df = drop_missing(df, spec.dropna)
    if spec.dedupe:
        needed = {*spec.dedupe, *spec.dedupe_order}
        df = df.drop(*[c for c in spec.drop if c not in needed])
        df = dedupe(df, spec.dedupe, spec.dedupe_order)
    return df.drop(*spec.drop)
