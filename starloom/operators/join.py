"""Lookups, dimension joins and the foreign-key audit."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import fresh_name
from starloom.operators.aggregate import key_sets
from starloom.scratch import settle


def lookup(keys: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Left join on keys of different name; the table's key is dropped."""
    return keys.join(table, keys[key] == table[table_key], "left").drop(table[table_key])


def attach_dimension(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``attach_dimensions`` with one dimension."""
    return attach_dimensions(fact, {key: dim})


def attach_dimensions(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Left join dimensions, by their key columns, to the fact; its rows stay as they are.

    A repeated key would multiply fact rows and raises ``ValueError``; one job looks at
    all dimensions. Pass written tables (``settle``): Spark then knows their size and
    broadcasts the small ones; for others AQE splits the fact's hot keys. Fact rows without
    a key match nothing, so in the join they are dealt out by a hash of the row.
    """
    dims = {key: dim.where(F.col(key).isNotNull()) for key, dim in dims.items()}
    _require_unique(dims)
    for key, dim in dims.items():
        fact = _attached(fact, dim, key)
    return fact


def _attached(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """A left join with a dimension whose keys are known to be unique and not null."""
    attributes = [c for c in dim.columns if c != key]
    taken = {c.lower() for c in fact.columns}
    twice = [c for c in attributes if c.lower() in taken]
    if twice:
        raise ValueError(f"dimension of {key}: the fact has column {', '.join(twice)} already")
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    spread = F.when(F.col(f"`{key}`").isNull(), row_hash).otherwise(F.lit(0).cast("long"))
    aside = fresh_name([*fact.columns, *dim.columns], "_spread")
    left = fact.withColumn(aside, spread)
    # not a literal, which Spark would take out of the join's keys
    right = dim.withColumn(aside, F.col(f"`{key}`").isNull().cast("long"))
    kept = [F.col(f"`{c}`") for c in (*fact.columns, *attributes)]
    return left.join(right, [key, aside], "left").select(*kept)


def mark_known(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, mark: str) -> DataFrame:
    """``mark``: whether the dimension has the row's key; a null key it has not."""
    known = dim.select(F.col(f"`{dim_key}`").alias(key)).where(F.col(f"`{key}`").isNotNull()).distinct()
    found = _attached(fact, known.withColumn(mark, F.lit(True)), key)
    return found.withColumn(mark, F.coalesce(F.col(f"`{mark}`"), F.lit(False)))


def _require_unique(dims: Mapping[str, DataFrame]) -> None:
    most = [
        dim.groupBy(key).count().agg(F.lit(key).alias("key"), F.max("count").alias("most"))
        for key, dim in dims.items()
    ]
    if not most:
        return
    repeated = reduce(DataFrame.unionByName, most).where("most > 1").collect()  # a row per key
    if repeated:
        raise ValueError(f"dimension key {', '.join(r.key for r in repeated)} is not unique")


def missing_keys(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact keys without a dimension row: (dimension, key, n_rows).

    ``dims`` maps a name to (dimension, key column). Null keys appear as a null
    ``key``. The fact is read once to count its keys.
    """
    keys = list(dict.fromkeys(key for _, key in dims.values()))
    counts = F.count(F.lit(1)).alias(fresh_name(keys, "n_rows"))
    table, picks = key_sets(fact, {key: [key] for key in keys}, counts)
    table = settle(table)
    counted = {
        name: table.where(picks[key]).select(F.col(f"`{key}`").alias("key"), F.col(table.columns[-1]).alias("n_rows"))
        for name, (_, key) in dims.items()
    }
    return missing_of_counted(counted, dims)


def missing_of_counted(
    counted: Mapping[str, DataFrame], dims: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``missing_keys`` from ``counted`` keys (key, n_rows) of each dimension.

    Keys are compared in the common type of both sides (as text where there is none).
    """
    audits = []
    for name, (dim, key) in dims.items():
        used = counted[name].select(F.col("key").alias("_used"), "n_rows")
        known = dim.select(F.col(f"`{key}`").alias("_known")).where("_known is not null").distinct()
        left, right = F.col("_used"), F.col("_known")
        if isinstance(used.schema["_used"].dataType, T.StringType) != isinstance(
            known.schema["_known"].dataType, T.StringType
        ):
            left, right = left.cast("string"), right.cast("string")
        missing = used.join(known, left == right, "left_anti")
        audits.append(
            missing.select(F.lit(name).alias("dimension"), F.col("_used").cast("string").alias("key"), "n_rows")
        )
    return reduce(DataFrame.unionByName, audits)
