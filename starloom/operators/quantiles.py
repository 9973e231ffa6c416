"""Exact quantiles without gathering or reordering a column."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.scratch import settle

# Values that the last step may rank for one quantile.
SLICE_ROWS = 1_000_000

LEVELS = (4096, 256, 16)  # groups of tasks whose sketches are merged, round by round


def no_quantiles(spark: SparkSession, quantiles: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([], "column string" + "".join(f", `{q}` double" for q in quantiles))


def sketch_size(accuracy: int) -> int:
    """The size of a KLL sketch whose ranks are off by 1/``accuracy`` of the values, at some
    five standard deviations: the published error, 2.296 / k^0.9021 at 99 %, taken twice."""
    return min(max(math.ceil((2 * 2.296 * accuracy) ** (1 / 0.9021)), 8), 65_535)


def merged_sketches(df: DataFrame, values: Mapping[str, Column], size: int) -> DataFrame:
    """One row with a KLL sketch of each named double column expression.

    Sketches are merged in rounds of a few groups each, so the last task takes in
    ``LEVELS[-1]`` of them per column, however many tasks made one.
    """
    k = F.lit(size)
    sketches = df.select(
        (F.spark_partition_id() % LEVELS[0]).alias("part"),
        *[value.alias(name) for name, value in values.items()],
    )
    merge = F.kll_sketch_agg_double
    for parts in LEVELS:
        sketches = sketches.groupBy((F.col("part") % parts).alias("part")).agg(
            *[merge(F.col(s), k).alias(s) for s in values]
        )
        merge = F.kll_merge_agg_double
    return sketches.agg(*[merge(F.col(s), k).alias(s) for s in values])


@dataclass(frozen=True)
class _Target:
    """A wanted rank, and the closed interval that its value lies in (None: open end)."""

    column: str
    quantile: str
    rank: int  # among all values
    low: float | None = None
    high: float | None = None
    below: int = 0  # values below the interval
    inside: int = 0

    def holds(self, value: Column) -> Column:
        at_least = F.lit(True) if self.low is None else value >= self.low
        at_most = F.lit(True) if self.high is None else value <= self.high
        return at_least & at_most

    @property
    def key(self) -> tuple[str, str]:
        return self.column, self.quantile

    @property
    def found(self) -> bool:
        return self.low is not None and self.low == self.high


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Mapping[str, float],
    slice_rows: int = SLICE_ROWS,
    accuracy: int = 1_000,
) -> DataFrame:
    """One row per column that has values, one result column per named quantile.

    The quantile ``p`` of ``n`` values is the value of rank ``ceil(p * n)``; null and NaN are
    no values. Sketches of fixed size give an interval around each wanted rank; one scan
    counts the values below and in all intervals. An interval with more than ``slice_rows``
    values is sketched again by itself and shrinks by the sketch's error each time, until
    it is short, a single value, or mostly copies of a few values. A last scan keeps only the values in the intervals, counted
    before they are shuffled, and ranks them; an interval that is a single value needs none. The driver
    holds a few numbers per column and quantile; nothing of the input's size is shuffled or written.

    Counts and values are taken from each column by itself, as an aggregate of all columns is too
    long for the JVM to compile: pass a table written by columns.
    """
    spark = df.sparkSession
    values = {c: _value(c) for c in columns}
    if not columns:
        return no_quantiles(spark, quantiles)
    size = sketch_size(accuracy)
    named = {f"s{i}": c for i, c in enumerate(columns)}
    merged = merged_sketches(df, {s: values[c] for s, c in named.items()}, size)
    wanted = [(s, c, q, p) for s, c in named.items() for q, p in quantiles.items()]
    ends = merged.select(
        *[F.kll_sketch_get_n_double(s).alias(f"n_{s}") for s in named],
        *[_ends(s, p, accuracy).alias(f"e{i}") for i, (s, _, _, p) in enumerate(wanted)],
    ).first()
    targets = [
        _Target(c, q, max(math.ceil(p * ends[f"n_{s}"]), 1), *ends[f"e{i}"])
        for i, (s, c, q, p) in enumerate(wanted)
        if ends[f"n_{s}"]
    ]
    if not targets:
        return no_quantiles(spark, quantiles)
    targets = _counted(df, values, targets)
    done: set[tuple[str, str]] = set()
    while wide := [t for t in targets if t.inside > slice_rows and not t.found and t.key not in done]:
        smaller = {
            t.key: t for t in _counted(df, values, _narrowed(df, values, wide, size, accuracy))
        }
        # what does not shrink is mostly copies of a few values, which are counted anyway
        done |= {t.key for t in wide if 2 * smaller[t.key].inside > t.inside}
        targets = [
            smaller[t.key] if t.key in smaller and smaller[t.key].inside < t.inside else t
            for t in targets
        ]
    return _values_at(df, values, targets, quantiles)


def _value(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _ends(sketch: str, share: float, accuracy: int) -> Column:
    """The sketch's values an error below and above a share of the values."""
    ends = [F.lit(min(max(share + sign / accuracy, 0.0), 1.0)) for sign in (-1, 1)]
    has_values = F.kll_sketch_get_n_double(sketch) > 0
    return F.struct(
        *[F.when(has_values, F.kll_sketch_get_quantile_double(sketch, e)) for e in ends]
    )


def _counted(df: DataFrame, values: Mapping[str, Column], targets: list[_Target]) -> list[_Target]:
    """The targets with their counts, by one scan; an interval that misses its rank, as a
    sketch's may with a small chance, is opened to the side where the rank lies."""
    while True:
        counts = [
            df.select(values[name].alias("value")).agg(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("target"),
                            F.count_if(_below(F.col("value"), t)).alias("below"),
                            F.count_if(t.holds(F.col("value"))).alias("inside"),
                        )
                        for i, t in some
                    ]
                ).alias("found")
            )
            for name, some in _by_column(targets).items()
        ]
        rows = reduce(DataFrame.unionByName, counts).select(F.inline("found")).collect()
        found = {r["target"]: (r["below"], r["inside"]) for r in rows}
        out, missed = [], False
        for i, t in enumerate(targets):
            below, inside = found[i]
            low, high = t.low, t.high
            if t.rank <= below:
                low, missed = None, True
            elif t.rank > below + inside:
                high, missed = None, True
            out.append(_Target(t.column, t.quantile, t.rank, low, high, below, inside))
        targets = out
        if not missed:
            return targets


def _by_column(targets: list[_Target]) -> dict[str, list[tuple[int, _Target]]]:
    """The targets and their numbers, by column."""
    out: dict[str, list[tuple[int, _Target]]] = {}
    for i, t in enumerate(targets):
        out.setdefault(t.column, []).append((i, t))
    return out


def _below(value: Column, target: _Target) -> Column:
    return F.lit(False) if target.low is None else value < target.low


def _narrowed(df: DataFrame, values: Mapping[str, Column], targets: list[_Target], size: int,
              accuracy: int) -> list[_Target]:
    """Smaller intervals, from sketches of what lies in the given ones."""
    inside = {
        f"s{i}": F.when(t.holds(values[t.column]), values[t.column]) for i, t in enumerate(targets)
    }
    ends = merged_sketches(df, inside, size).select(
        *[
            _ends(f"s{i}", (t.rank - t.below) / t.inside, accuracy).alias(f"e{i}")
            for i, t in enumerate(targets)
        ]
    )
    row = ends.first()
    return [_Target(t.column, t.quantile, t.rank, *row[f"e{i}"]) for i, t in enumerate(targets)]


def _values_at(df: DataFrame, values: Mapping[str, Column], targets: list[_Target],
               quantiles: Mapping[str, float]) -> DataFrame:
    known = [(t.column, t.quantile, t.low + 0.0) for t in targets if t.found]  # 0.0 for -0.0
    rows = df.sparkSession.createDataFrame(known, "column string, q string, value double")
    targets = [t for t in targets if not t.found]
    if targets:
        rows = rows.unionByName(_ranked(df, values, targets))
    return rows.groupBy("column").agg(
        *[F.min(F.when(F.col("q") == q, F.col("value"))).alias(q) for q in quantiles]
    )


def _ranked(df: DataFrame, values: Mapping[str, Column], targets: list[_Target]) -> DataFrame:
    """``column, q, value`` of targets, by the values in their intervals."""
    inside = []
    for name, some in _by_column(targets).items():
        value = F.col("value")
        of = F.array(*[F.when(t.holds(value), F.lit(i)) for i, t in some])
        kept = df.select(values[name].alias("value")).where(reduce(Column.__or__, [t.holds(value) for _, t in some]))
        inside.append(kept.select(F.explode(F.array_compact(of)).alias("target"), "value"))
    # each column is counted before its values are shuffled
    counted = settle(
        reduce(DataFrame.unionByName, inside).groupBy("target", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("target").orderBy("value")
    local = F.element_at(F.array(*[F.lit(t.rank - t.below) for t in targets]), F.col("target") + 1)
    reached = counted.select(
        "target", F.when(F.sum("n").over(running) >= local, F.col("value")).alias("value")
    )
    named = F.array(*[F.struct(F.lit(t.column).alias("column"), F.lit(t.quantile).alias("q")) for t in targets])
    return reached.groupBy("target").agg(F.min("value").alias("value")).select(
        F.element_at(named, F.col("target") + 1).alias("t"), "value"
    ).select("t.column", "t.q", "value")
