"""The star: its fact table, the whole set of tables, the joined form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import iso_date
from starloom.operators import (
    attach_dimensions,
    check_tables,
    missing_keys,
    missing_of_counted,
    require_passed,
)
from starloom.operators.clean import require_columns
from starloom.plans.counted import ROWS, CountedKeys, count_keys
from starloom.plans.dimensions import (
    DIMENSIONS,
    airport_dimension,
    country_dimension,
    date_dimension,
    demographics_dimension,
    keys_of,
    keys_of_all,
)
from starloom.scratch import settle_all
from starloom.sources import FORMATS, load_all_observed, publish
from starloom.specs import RunSpec, SinkSpec, StarSpec

TABLES = ("date", "country", "airport", "demographics", "fact")


def fact_table(arrivals: DataFrame, spec: StarSpec) -> DataFrame:
    """The arrivals with ISO dates and the dimensions' key names."""
    require_columns(arrivals, [*spec.date_columns, *spec.renames], "fact table")
    dates = {name: iso_date(F.col(name)) for name in spec.date_columns}
    return arrivals.withColumns(dates).withColumnsRenamed(spec.renames)


def build_dimension(
    name: str, keys: DataFrame, sources: Mapping[str, DataFrame], spec: StarSpec
) -> DataFrame:
    if name == "date":
        return date_dimension(keys, spec)
    if name == "country":
        return country_dimension(keys, sources["codes"], sources["temperatures"], spec)
    if name == "airport":
        return airport_dimension(keys, sources["airports"], spec)
    return demographics_dimension(keys, sources["demographics"], spec)


def dimension(name: str, sources: Mapping[str, DataFrame], spec: StarSpec) -> DataFrame:
    """One dimension by itself."""
    return build_dimension(name, keys_of(sources["arrivals"], name, spec), sources, spec)


def build_star(sources: Mapping[str, DataFrame], spec: StarSpec) -> dict[str, DataFrame]:
    """All tables of the star.

    The arrivals are scanned once for the keys of all dimensions; the
    dimensions are then written, so reading them again costs nothing and Spark
    knows their size.
    """
    keys = keys_of_all(sources["arrivals"], spec)
    star = settle_all({name: build_dimension(name, keys[name], sources, spec) for name in keys})
    star["fact"] = fact_table(sources["arrivals"], spec)
    return star


def build_counted(
    sources: Mapping[str, DataFrame],
    spec: StarSpec,
    dimensions: Sequence[str] = DIMENSIONS,
    also: Mapping[str, Sequence[str]] | None = None,
) -> tuple[dict[str, DataFrame], CountedKeys]:
    """Dimensions and the counted keys they are built from: all that the analyses and the audit
    need, by one scan of the arrivals and without a fact."""
    counted = count_keys(sources["arrivals"], spec, dimensions, also=also)
    dims = {d: build_dimension(d, counted.keys(d), sources, spec) for d in dimensions}
    return settle_all(dims), counted


def write_star(star: Mapping[str, DataFrame], sinks: Mapping[str, SinkSpec]) -> dict[str, DataFrame]:
    """Publish every table and return them as read back from their files."""
    return publish(star, sinks)


def star_counts(
    star: Mapping[str, DataFrame], min_rows: int | Mapping[str, int] = 10
) -> DataFrame:
    """(table, n_rows, enough_rows); from file footers if the star is written."""
    counts = [
        df.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("n_rows"),
            (
                F.count(F.lit(1)) >= (min_rows if isinstance(min_rows, int) else min_rows[name])
            ).alias("enough_rows"),
        )
        for name, df in star.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def star_join(star: Mapping[str, DataFrame], spec: StarSpec) -> DataFrame:
    """The fact with all dimensions attached, one row per fact row.

    Needs unique dimension keys, hence ``unique_ports``.
    """
    dims = {key: star[name] for name, key in dimension_keys(spec).items()}
    return attach_dimensions(star["fact"], dims)


def dimension_keys(spec: StarSpec) -> dict[str, str]:
    return {
        "date": spec.date_key,
        "country": spec.country_key,
        "airport": spec.port_key,
        "demographics": spec.state_key,
    }


def audit_keys(
    star: Mapping[str, DataFrame], spec: StarSpec, counted: CountedKeys | None = None
) -> DataFrame:
    """Fact keys that have no dimension row; from counted keys, or else from the fact."""
    dims = {name: (star[name], key) for name, key in dimension_keys(spec).items()}
    if counted is None:
        return missing_keys(star["fact"], dims)
    keys = {
        name: counted.counts(name).select(F.col(f"`{key}`").alias("key"), F.col(ROWS).alias("n_rows"))
        for name, (_, key) in dims.items()
    }
    return missing_of_counted(keys, dims)


def state_slice(star: Mapping[str, DataFrame], spec: StarSpec, states: Column) -> DataFrame:
    """Fact rows of the states that meet a condition on the demographics, with their ``State``.

    For a written star: the fact is partitioned by state, and Spark reads the partitions of
    those states only, which it learns from the dimension while the query runs.
    """
    chosen = star["demographics"].where(states).select(spec.state_key, "State").distinct()
    return star["fact"].join(chosen, spec.state_key)


def describe_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The schemas of tables: (table, position, column, type)."""
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for i, field in enumerate(df.schema, start=1)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def run(
    spark: SparkSession,
    spec: RunSpec,
    formats: Mapping[str, str] = FORMATS,
    strict: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Load, check, build and publish. Returns (star, source checks, star counts).

    Row-based sources are parsed once, into Parquet, by a pass that also counts their rows and
    the values that declared types and casts turned into null: ``n_read`` and ``n_lost`` of
    the checks. The star's tables are written beside their places and counted there; then
    all of them are moved. With ``strict`` a failed check of a source raises before anything
    is written to the sinks, and a table of the star below its ``min_rows`` before anything
    published is touched.
    """
    loaded = load_all_observed(spark, spec.sources, formats)
    sources = {name: source.df for name, source in loaded.items()}
    min_rows = {name: source.min_rows for name, source in spec.sources.items()}
    seen = spark.createDataFrame(
        [(name, source.n_read, source.n_lost) for name, source in loaded.items()],
        "table string, n_read long, n_lost long",
    )
    checks = check_tables(sources, min_rows).join(seen, "table")
    if strict:
        require_passed(checks)
    star = build_star(sources, spec.star)
    least = {name: spec.sinks[name].min_rows if name in spec.sinks else 10 for name in star}
    require = partial(_require_rows, min_rows=least) if strict else lambda tables: None
    if spec.sinks:
        star = publish(star, spec.sinks, require)
    else:
        require(star)
    return star, checks, star_counts(star, least)


def _require_rows(star: Mapping[str, DataFrame], min_rows: Mapping[str, int]) -> None:
    small = star_counts(star, min_rows).where(~F.col("enough_rows")).collect()  # a row per table
    if small:
        raise ValueError(f"too few rows in {', '.join(r.table for r in small)}")
