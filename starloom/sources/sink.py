"""Partitioned Parquet sink."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.clean import require_columns
from starloom.specs import SinkSpec

# A column whose dictionary outgrows this is written plain from there on: its look-ups would
# cost more than the bytes that they save. Parquet's own limit is 1 MB.
DICTIONARY_BYTES = 128 * 1024
# Partition values that a task of ungathered rows writes side by side; it sorts the rows of others.
WRITERS = 32


def table_path(sink: SinkSpec) -> str:
    return f"{sink.path.rstrip('/')}/{sink.name}"


def write_table(
    df: DataFrame, sink: SinkSpec, replace: str = "table", gather: bool = True
) -> str:
    """Overwrite the table at ``sink`` and return its path.

    With ``replace="partitions"`` only those partitions are overwritten that ``df`` has
    rows of; Spark moves them in when all tasks are done, and the others stay.

    Rows of one partition value are brought together so that it gets few
    files; ``rebalance`` lets AQE split a value with many rows over several
    tasks and files, and merge small ones. An empty text in a partition column would be
    read back as null, so it fails the write. Without ``gather`` each task writes its rows where
    they are: for rows that were brought together before, as those of a table partitioned alike.
    """
    require_columns(df, sink.partition_by, f"sink {sink.name}")
    if replace not in ("table", "partitions"):
        raise ValueError(f"replace is table or partitions, not {replace!r}")
    path = table_path(sink)
    texts = [c for c in sink.partition_by if isinstance(df.schema[c].dataType, T.StringType)]
    df = df.withColumns({c: _not_empty(c, sink.name) for c in texts})
    if sink.partition_by and gather:
        df = df.hint("rebalance", *sink.partition_by)
    mode = "dynamic" if replace == "partitions" else "static"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer = writer.option("parquet.dictionary.page.size", DICTIONARY_BYTES)
    with nullcontext() if gather else _side_by_side(df.sparkSession):
        writer.partitionBy(*sink.partition_by).parquet(path)
    return path


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Several open files per task in place of a sort, unless the session sets their number."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.unset(name)


def _not_empty(column: str, sink: str) -> Column:
    refuse = F.raise_error(F.lit(f"sink {sink}: empty text in partition column {column}"))
    return F.when(F.col(f"`{column}`") == "", refuse).otherwise(F.col(f"`{column}`"))
