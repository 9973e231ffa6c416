"""Rows with faults, tagged and set apart."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import fresh_name
from starloom.operators.checks import lost_value
from starloom.operators.clean import cast_columns, require_columns
from starloom.operators.join import mark_known
from starloom.scratch import scratch_folder

FAULTS = "faults"


def tag_faults(
    df: DataFrame,
    casts: Mapping[str, str] | None = None,
    keys: Mapping[str, tuple[DataFrame, str]] | None = None,
    column: str = FAULTS,
) -> DataFrame:
    """The rows with an array of their faults, empty for sound ones.

    ``cast c``: the cast of column ``c`` would turn its value into null. ``unknown c``: the
    dimension given for ``c`` (a frame and its key column) lacks the value, or it is null.
    One pass: dimensions are joined from the left by their distinct keys, so no row is
    lost or doubled; pass written dimensions, so that Spark knows their size.
    """
    casts, keys = dict(casts or {}), dict(keys or {})
    require_columns(df, [*casts, *keys], "tag_faults")
    faults = [F.when(lost_value(df, c, to), F.lit(f"cast {c}")) for c, to in casts.items()]
    marked, own = df, df.columns
    for c, (dim, dim_key) in keys.items():
        mark = fresh_name(marked.columns, f"_known_{c}")
        marked = mark_known(marked, dim, c, dim_key, mark)
        faults.append(F.when(~F.col(f"`{mark}`"), F.lit(f"unknown {c}")))
    tags = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")
    return marked.select(*[F.col(f"`{c}`") for c in own], tags.alias(column))


@dataclass(frozen=True)
class Quarantine:
    """``accepted`` rows, cast; ``rejected`` rows as they came, with their faults."""

    accepted: DataFrame
    rejected: DataFrame

    def by_reason(self) -> DataFrame:
        """(fault, n_rows); a row with several faults counts for each."""
        faults = self.rejected.select(F.explode(FAULTS).alias("fault"))
        return faults.groupBy("fault").agg(F.count(F.lit(1)).alias("n_rows"))


def quarantine(
    df: DataFrame,
    casts: Mapping[str, str] | None = None,
    keys: Mapping[str, tuple[DataFrame, str]] | None = None,
    path: str | None = None,
) -> Quarantine:
    """Split rows into accepted and rejected ones, written side by side in one pass.

    The table at ``path`` (by default in the shared scratch folder) is partitioned by whether a row
    was rejected, so each half is read by itself.
    """
    spark = df.sparkSession
    faults = fresh_name(df.columns, FAULTS)
    rejected = fresh_name([*df.columns, faults], "rejected")
    path = path or f"{scratch_folder(spark)}/quarantine"
    tagged = tag_faults(df, casts, keys, faults).withColumn(rejected, F.size(faults) > 0)
    tagged.write.mode("overwrite").partitionBy(rejected).parquet(path)
    written = spark.read.schema(tagged.schema).parquet(path)
    own = [F.col(f"`{c}`") for c in df.columns]
    accepted = written.where(~F.col(rejected)).select(*own)
    return Quarantine(
        cast_columns(accepted, casts) if casts else accepted,
        written.where(rejected).select(*own, F.col(faults).alias(FAULTS)),
    )
