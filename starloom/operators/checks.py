"""Row-count and duplicate checks of tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions import can_digest, fresh_name, row_digests, safe_cast
from starloom.operators.clean import require_columns
from starloom.scratch import settle

CHECKS = "table string, n_rows long, n_distinct long, n_dup long, enough_rows boolean"

Digests = Callable[[DataFrame], tuple[Column, Column]]


def count_distinct_rows(df: DataFrame, digests: Digests = row_digests) -> tuple[int, int]:
    """``(rows, distinct rows)``, exact, in two passes.

    The first pass counts rows by digest: two 64-bit numbers and a count per row are all that
    is shuffled, and copies of a row are counted before. Digests that occur once are
    distinct rows. The second pass compares in full those rows whose digest occurs more
    often, copies or collisions, and is left out if there are none. Tables with nested
    columns are grouped as they are.
    """
    if not can_digest(df):
        copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count()
        row = copies.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
        return row[0], row[1]
    a, b = (fresh_name(df.columns, name) for name in ("_digest_a", "_digest_b"))
    first, second = digests(df)
    marked = df.withColumns({a: first, b: second})
    counted = marked.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    # above the shuffle, in the stage that writes: a task that runs again is counted once
    counted = counted.observe(
        seen,
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("n") == 1).alias("single"),
        F.count_if(F.col("n") > 1).alias("several"),
    )
    repeated = settle(counted.where("n > 1").select(a, b))
    found = seen.get
    n_distinct = found["single"]
    if found["several"]:
        again = marked.join(repeated, [a, b], "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
        n_distinct += again.distinct().count()
    return found["rows"], n_distinct


def table_check(df: DataFrame, name: str, min_rows: int = 10) -> DataFrame:
    """One row: (table, n_rows, n_distinct, n_dup, enough_rows)."""
    return check_tables({name: df}, min_rows)


def check_tables(
    tables: Mapping[str, DataFrame], min_rows: int | Mapping[str, int] = 10
) -> DataFrame:
    """``table_check`` of several tables, one row each; they are counted at the same time."""
    spark: SparkSession = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:
        count = inheritable_thread_target(spark)(count_distinct_rows)
        counts = dict(zip(tables, pool.map(count, tables.values()), strict=True))
    rows = [
        (name, n, distinct, n - distinct, n >= (min_rows if isinstance(min_rows, int) else min_rows[name]))
        for name, (n, distinct) in counts.items()
    ]
    return spark.createDataFrame(rows, CHECKS)


def require_passed(checks: DataFrame) -> None:
    """Raise ``ValueError`` for tables with too few or duplicate rows, or lost values."""
    lost = F.col("n_lost") if "n_lost" in checks.columns else F.lit(0)
    checks = checks.withColumn("n_lost", lost)
    failed = checks.where("not enough_rows or n_dup > 0 or n_lost > 0").collect()
    if failed:
        found = "; ".join(
            f"{r.table}: {r.n_rows} rows, {r.n_dup} duplicates, {r.n_lost} values lost"
            for r in failed
        )
        raise ValueError(f"table checks failed: {found}")


def lost_value(df: DataFrame, name: str, to: str) -> Column:
    """Whether the cast of a column turns a value into null."""
    column = F.col(f"`{name}`")
    return column.isNotNull() & safe_cast(column, df.schema[name].dataType, to).isNull()


def cast_losses(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Values each cast turns into null: (column, n_lost), in one pass."""
    require_columns(df, casts, "cast_losses")
    losses = [
        F.struct(F.lit(name).alias("column"), F.count_if(lost_value(df, name, to)).alias("n_lost"))
        for name, to in casts.items()
    ]
    return df.agg(F.array(*losses).alias("losses")).select(F.inline("losses"))
