"""

The queries run on the driver's tables seen as the five sources of the arrivals
star (``standin.py``). Averages are rounded to six places in both engines.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import standin  # noqa: E402
from standin import SPECS, with_views  # noqa: E402
from starloom import SinkSpec, SourceSpec, StarSpec, operators  # noqa: E402
from starloom.functions import is_blank, iso_date, outside, parse_date  # noqa: E402
from starloom.plans import analyses, dimensions, monthly  # noqa: E402
from starloom.plans import star as star_plan  # noqa: E402
from starloom.plans.arrivals import MEASURES, RACES, SINKS  # noqa: E402
from starloom.scratch import scratch_folder, settle  # noqa: E402
from starloom.sources import (  # noqa: E402
    load_all_observed,
    publish,
    read_source,
    write_table,
)
from starloom.sources import load_sources as load_source_specs  # noqa: E402

# The training-data operators are a part that may be absent, or lack a library they need.
try:
    import corpus_pipeline
    from starloom.llm import queries as llm_queries
except ImportError as error:
    if error.name not in ("corpus_pipeline", "starloom.llm"):
        print(f"without the training-data operators: {error}", file=sys.stderr)
    LLM, LLM_SQL = {}, {}
else:
    LLM = llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    LLM_SQL = llm_queries.oracle_sql()
    if corpus_pipeline.ORACLE_SQL:
        LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

SMOKE_DIR = "/root/testdata/sf0.001"

STAR = StarSpec()
UNIQUE = StarSpec(unique_ports=True)
ARRIVALS = SPECS["arrivals"]
TEMPERATURES = SPECS["temperatures"]

# Source columns that each dimension and analysis needs of the arrivals.
KEY_COLUMNS = {
    "date": ["arrdate"],
    "country": ["i94res"],
    "airport": ["i94port", "i94mode"],
    "demographics": ["i94addr"],
}


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in doubles})


def _arrivals(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned arrivals, or some of their columns."""
    raw = standin.raw_arrivals(spark, sf_dir, columns or None)
    if not columns:
        return operators.clean(raw, ARRIVALS)
    return operators.cast_columns(raw, {c: t for c, t in ARRIVALS.casts.items() if c in columns})


def _source(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.clean(standin.RAW[name](spark, sf_dir), SPECS[name])


def _star_inputs(spark: SparkSession, sf_dir: str, *dims: str, more: tuple[str, ...] = ()):
    """What some dimensions, and a fact of their columns and ``more``, are built from."""
    columns = dict.fromkeys([c for d in dims for c in KEY_COLUMNS[d]] + list(more))
    inputs = {"arrivals": _arrivals(spark, sf_dir, *columns)}
    needed = {
        "country": ("codes", "temperatures"),
        "airport": ("airports",),
        "demographics": ("demographics",),
    }
    for d in dims:
        for name in needed.get(d, ()):
            inputs[name] = _source(name, spark, sf_dir)
    return inputs


def _dimension(name: str, spec: StarSpec = STAR):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim = star_plan.dimension(name, _star_inputs(spark, sf_dir, name), spec)
        return _rounded(dim)

    return query


def _counted(dim: str, spec: StarSpec, spark: SparkSession, sf_dir: str, *by: str):
    """One dimension, and the counted keys that it and its analysis come from."""
    more = (*by, "i94bir")
    inputs = _star_inputs(spark, sf_dir, dim, more=more)
    return star_plan.build_counted(inputs, spec, [dim], {dim: by})


def _fact(arrivals: DataFrame, spec: StarSpec) -> DataFrame:
    """The fact table of those of its columns that ``arrivals`` has."""
    dates = {c: iso_date(F.col(c)) for c in spec.date_columns if c in arrivals.columns}
    renames = {a: b for a, b in spec.renames.items() if a in arrivals.columns}
    return arrivals.withColumns(dates).withColumnsRenamed(renames)


def _star(spark: SparkSession, sf_dir: str, spec: StarSpec, *more: str) -> dict[str, DataFrame]:
    """All dimensions, and a fact of their columns and ``more``."""
    inputs = _star_inputs(spark, sf_dir, *KEY_COLUMNS, more=("depdate", *more))
    inputs["arrivals"] = settle(inputs["arrivals"])
    return star_plan.build_star(inputs, spec)


# --- sources and sinks ----------------------------------------------------


def scan_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(path=f"{sf_dir}/orders.parquet", schema={"o_orderpriority": "string"})
    df = read_source(spark, spec)
    return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"))


def _csv_specs(spark: SparkSession, sf_dir: str, **casts) -> dict[str, SourceSpec]:
    """The five sources as CSV files in the shared folder, and their specs."""
    folder = scratch_folder(spark)
    specs = {}
    for name, raw in standin.RAW.items():
        spec = replace(SPECS[name], path=f"{folder}/{name}.csv")
        raw(spark, sf_dir).write.csv(spec.path, header=True, sep=spec.sep)
        specs[name] = replace(spec, casts=dict(spec.casts) | casts.get(name, {}))
    return specs


def load_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in load_source_specs(spark, _csv_specs(spark, sf_dir)).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and values lost per source, from the pass that parses it; rows after cleaning."""
    wrong = {"arrivals": {"visapost": "int", "entdepd": "float"}, "codes": {"country": "int"}}
    loaded = load_all_observed(spark, _csv_specs(spark, sf_dir, **wrong))
    counts = [
        source.df.agg(
            F.lit(name).alias("source"),
            F.lit(source.n_read).cast("long").alias("n_read"),
            F.lit(source.n_lost).cast("long").alias("n_lost"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for name, source in loaded.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _as_csv(df: DataFrame, columns: dict[str, str], sep: str) -> DataFrame:
    """``df`` written as CSV into the shared folder and scanned by a spec."""
    path = f"{scratch_folder(df.sparkSession)}/table.csv"
    df.select(*columns).write.csv(path, header=True, sep=sep)
    return read_source(df.sparkSession, SourceSpec(path=path, sep=sep, schema=columns))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    columns = {
        "o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "string",
        "o_totalprice": "double", "o_orderdate": "date", "o_orderpriority": "string",
    }
    found = _as_csv(orders, columns, ",")
    return found.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def csv_scan_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "c_custkey": "long", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
        "c_mktsegment": "string",
    }
    return _as_csv(standin.table(spark, sf_dir, "customer"), columns, ";")


def csv_scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan without a schema: every column is text."""
    path = f"{scratch_folder(spark)}/table.csv"
    columns = ["s_suppkey", "s_name", "s_nationkey"]
    standin.table(spark, sf_dir, "supplier").select(*columns).write.csv(path, header=True)
    return read_source(spark, SourceSpec(path=path))


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star_plan.fact_table(_arrivals(spark, sf_dir), STAR)
    name, partitions = SINKS["fact"]
    path = write_table(fact, SinkSpec(scratch_folder(spark), name, partitions))
    return (
        spark.read.parquet(path)
        .groupBy("state_code")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("arrival_date").alias("n_dated"),
            F.min("arrival_date").cast("string").alias("first_arrival"),
            F.max("depdate").cast("string").alias("last_departure"),
            F.sum(F.col("cicid").cast("long")).alias("sum_cicid"),
        )
    )


# --- columns and predicates -----------------------------------------------


def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_arrivals(spark, sf_dir, list(ARRIVALS.casts))
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return operators.cast_columns(as_text, ARRIVALS.casts)


def cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_arrivals(spark, sf_dir, ["visapost", "fltno", "dtadfile", "entdepd"])
    return operators.cast_losses(
        raw, {"visapost": "int", "fltno": "int", "dtadfile": "int", "entdepd": "float"}
    )


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.drop_columns(standin.raw_arrivals(spark, sf_dir), ARRIVALS.drop)


def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_demographics(spark, sf_dir)
    return operators.drop_missing(raw, SPECS["demographics"].dropna)


def dedupe_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.dedupe(standin.raw_airports(spark, sf_dir), ["iata_code"], ["ident"])


def clean_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _source("temperatures", spark, sf_dir)
    return df.withColumn("dt", F.col("dt").cast("string"))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    parsed = parse_date(text)
    return (
        orders.groupBy("o_orderstatus", F.year(parsed).alias("year"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max(parsed).cast("string").alias("last_date"))
    )


def sas_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_arrivals(spark, sf_dir, ["depdate"])
    return raw.groupBy("depdate", iso_date(F.col("depdate")).alias("departure")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def date_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = outside(F.col("dt"), F.lit("1700-01-01").cast("date"), F.lit("2016-01-01").cast("date"))
    return operators.count_where(
        standin.raw_temperatures(spark, sf_dir), {"dt out of range": wrong}
    )


def blank_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("City", "Country")
    return operators.count_where(
        standin.raw_temperatures(spark, sf_dir), {f"{c} blank": is_blank(F.col(c)) for c in columns}
    )


# --- aggregates and profiles ----------------------------------------------


def null_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(operators.null_percent(standin.raw_arrivals(spark, sf_dir)))


def rows_at_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.rows_at_max(standin.raw_demographics(spark, sf_dir), "Median Age")


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.raw_arrivals(spark, sf_dir, ["i94port", "i94mode"]).distinct()


def distinct_key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _arrivals(spark, sf_dir, *dict.fromkeys(sum(KEY_COLUMNS.values(), [])))
    result = None
    for name, keys in dimensions.keys_of_all(arrivals, STAR).items():
        part = keys.agg(F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("n_keys"))
        result = part if result is None else result.unionByName(part)
    return result


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["cicid", "i94port", "i94addr", "occup"]
    return operators.distinct_counts(standin.raw_arrivals(spark, sf_dir, columns), columns)


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.distinct_values(standin.raw_demographics(spark, sf_dir), "Race")


def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.duplicate_count(
        standin.raw_temperatures(spark, sf_dir), TEMPERATURES.dedupe
    )


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_line = operators.key_uniqueness(
        standin.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )
    by_order = operators.key_uniqueness(standin.table(spark, sf_dir, "orders"), ["o_orderkey"])
    return by_line.withColumn("table", F.lit("lineitem")).unionByName(
        by_order.withColumn("table", F.lit("orders"))
    )


def distinct_sketched_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether distinct counts from stored monthly sketches lie within five standard errors."""
    columns = ["cicid", "i94port", "fltno", "occup"]
    raw = settle(standin.raw_arrivals(spark, sf_dir, ["i94yr", "i94mon", *columns]))
    sketches = settle(operators.distinct_sketches(raw, columns, ["i94yr", "i94mon"]))
    found = operators.merged_distinct_counts(sketches, columns)
    exact = operators.distinct_counts(raw, columns).withColumnRenamed("n_distinct", "n_exact")
    error = F.abs(F.col("n_distinct") - F.col("n_exact")) / F.col("n_exact")
    months = sketches.agg(F.count(F.lit(1)).alias("n_months"))
    return (
        found.join(exact, "column")
        .crossJoin(F.broadcast(months))  # one row
        .select("column", "n_months", (error <= 5 * 1.04 / 2**7).alias("within_error"))
    )


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # exact quartiles scan several times: join the tables behind the arrivals once
    raw = settle(standin.raw_arrivals(spark, sf_dir))
    return _rounded(operators.column_profile(raw, exact=True))


def column_profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(operators.column_profile(standin.raw_arrivals(spark, sf_dir)))


def sketched_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketched quartiles lie within the stated error of their ranks."""
    raw = settle(standin.raw_arrivals(spark, sf_dir, list(_NUMERIC)))
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = operators.sketched_quantiles(
        raw.select(*[F.col(c).cast("double").alias(c) for c in _NUMERIC]), _NUMERIC, quartiles, 1_000
    )
    wanted = F.coalesce(*[F.when(F.col("quantile") == q, p) for q, p in quartiles.items()])
    near = (F.col("below") <= wanted + 0.001) & (F.col("upto") >= wanted - 0.001)
    return operators.quantile_ranks(raw, found, list(quartiles)).select(
        "column", "quantile", near.alias("within_error")
    )


def table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.check_tables(standin.sources(spark, sf_dir))


def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_demographics(spark, sf_dir)
    return operators.top_n(raw, [F.col("Median Age").desc(), "Count"], 5)


def avg_all_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    demographics = standin.raw_demographics(spark, sf_dir)
    return _rounded(operators.average_numeric(demographics, ["State Code", "State"]))


def pivot_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(dimensions.city_demographics(_source("demographics", spark, sf_dir)))


def pivot_city_nofill(spark: SparkSession, sf_dir: str) -> DataFrame:
    demographics = _source("demographics", spark, sf_dir)
    return _rounded(dimensions.city_demographics(demographics, zero_fill=False))


# --- joins and the star ---------------------------------------------------


def left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = _arrivals(spark, sf_dir, "i94res").distinct()
    return operators.lookup(used, "i94res", _source("codes", spark, sf_dir), "code")


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_plan.fact_table(_arrivals(spark, sf_dir), STAR)


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir, UNIQUE, "cicid", "airline")
    rounded = {name: _rounded(star[name]) for name in ("country", "demographics")}
    return star_plan.star_join(star | rounded, UNIQUE).select(
        "cicid", "arrival_date", "weekday", "country_code", "country", "temperature_avg",
        "arrival_port", "ident", "municipality", "state_code", "State", "MedianAgeAvg",
        "RaceCountWhiteAvg", "i94mode", "airline",
    )


def star_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_plan.star_counts(_star(spark, sf_dir, STAR))


def star_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star written and read back: rows, and rows that have their key."""
    star = _star(spark, sf_dir, STAR)
    folder = scratch_folder(spark)
    sinks = {name: SinkSpec(folder, table, by) for name, (table, by) in SINKS.items()}
    keys = star_plan.dimension_keys(STAR) | {"fact": STAR.state_key}
    counts = [
        df.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(keys[name]).alias("n_keyed"),
        )
        for name, df in star_plan.write_star(star, sinks).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def star_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A star published, then one refused by its check: the rows of the first stay."""
    star = _star(spark, sf_dir, STAR)
    folder = scratch_folder(spark)
    sinks = {name: SinkSpec(folder, table, by) for name, (table, by) in SINKS.items()}
    published = publish(star, sinks)

    def refuse(staged: dict[str, DataFrame]) -> None:
        star_plan._require_rows(staged, dict.fromkeys(staged, 1))

    try:
        publish({name: df.limit(0) for name, df in star.items()}, sinks, refuse)
        outcome = "published"
    except ValueError:
        outcome = "refused"
    return star_plan.star_counts(published).withColumn("second", F.lit(outcome))


def monthly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrivals in two loads by month, the second one twice: rows per month of the fact,
    rows and keyed rows of the dimensions."""
    arrivals = monthly.by_month(_arrivals(spark, sf_dir))
    sources = {name: settle(_source(name, spark, sf_dir)) for name in standin.RAW if name != "arrivals"}
    folder = scratch_folder(spark)
    sinks = {name: SinkSpec(folder, table, by) for name, (table, by) in SINKS.items()}
    sinks = monthly.monthly_sinks(sinks)
    late = F.coalesce(F.col("i94mon") > 6, F.lit(False))
    for part in (~late, late, late):
        star = monthly.load_months(arrivals.where(part), sources, STAR, sinks, together=True)
    keys = star_plan.dimension_keys(STAR)
    counts = [
        df.groupBy(*([F.lit(None).cast("int").alias(c) for c in monthly.MONTH] if name != "fact" else monthly.MONTH))
        .agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(keys.get(name, STAR.state_key)).alias("n_keyed"),
        )
        for name, df in star.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def state_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals by state where the dimension says ASIA, from the written star."""
    star = _star(spark, sf_dir, STAR, "i94bir")
    folder = scratch_folder(spark)
    sinks = {name: SinkSpec(folder, table, by) for name, (table, by) in SINKS.items()}
    written = publish({name: star[name] for name in ("demographics", "fact")}, sinks)
    rows = star_plan.state_slice(written, STAR, F.col("State") == "ASIA")
    return _rounded(
        rows.groupBy("state_code", "State").agg(
            F.count(F.lit(1)).alias("n_arrivals"), F.avg("i94bir").alias("mean_age")
        )
    )


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per fault, and accepted ones: a cast that fails, and keys without a dimension row."""
    star = _star(spark, sf_dir, STAR, "occup")
    dims = {
        key: (star[name], key)
        for name, key in star_plan.dimension_keys(STAR).items()
        if name in ("country", "demographics")
    }
    split = operators.quarantine(star["fact"], {"occup": "int"}, dims)
    accepted = split.accepted.agg(F.lit("accepted").alias("fault"), F.count(F.lit(1)).alias("n_rows"))
    return split.by_reason().unionByName(accepted)


def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, counted = star_plan.build_counted(_star_inputs(spark, sf_dir, *KEY_COLUMNS, more=("i94bir",)), STAR)
    return star_plan.audit_keys(dims, STAR, counted)


def arrivals_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, counted = _counted("date", STAR, spark, sf_dir)
    return analyses.arrivals_over_time(dims, STAR, counted=counted)


def arrivals_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, counted = _counted("date", STAR, spark, sf_dir)
    return analyses.arrivals_over_time(dims, STAR, by=["weekday"], counted=counted)


def arrivals_vs_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, counted = _counted("demographics", STAR, spark, sf_dir)
    return _rounded(analyses.arrivals_by_state(dims, STAR, counted))


def arrivals_vs_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, counted = _counted("country", STAR, spark, sf_dir)
    return _rounded(analyses.arrivals_by_origin(dims, STAR, counted))


def airport_airline_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, counted = _counted("airport", UNIQUE, spark, sf_dir, "airline")
    return analyses.airports_and_airlines(dims, UNIQUE, counted)


def entry(spark: SparkSession) -> DataFrame:
    """Arrivals per month on the smoke data."""
    return arrivals_by_month(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir)."""
    return {
        "scan_dispatch": scan_dispatch,
        "csv_scan": csv_scan,
        "csv_scan_semicolon": csv_scan_semicolon,
        "csv_scan_text": csv_scan_text,
        "sink_roundtrip": sink_roundtrip,
        "load_sources": load_sources,
        "observed_checks": observed_checks,
        "cast_columns": cast_columns,
        "cast_losses": cast_losses,
        "drop_columns": drop_columns,
        "dropna_subset": dropna_subset,
        "dedupe_subset": dedupe_subset,
        "clean_source": clean_source,
        "parse_dates": parse_dates,
        "sas_dates": sas_dates,
        "null_percent": null_percent,
        "date_out_of_range": date_out_of_range,
        "blank_strings": blank_strings,
        "rows_at_max": rows_at_max,
        "distinct_keys": distinct_keys,
        "distinct_key_sets": distinct_key_sets,
        "distinct_counts": distinct_counts,
        "distinct_sketched_by_month": distinct_sketched_by_month,
        "distinct_values": distinct_values,
        "duplicate_count": duplicate_count,
        "key_uniqueness": key_uniqueness,
        "column_profile": column_profile,
        "column_profile_sketch": column_profile_sketch,
        "sketched_quartiles": sketched_quartiles,
        "table_checks": table_checks,
        "top_n": top_n,
        "left_lookup": left_lookup,
        "avg_all_numeric": avg_all_numeric,
        "pivot_city": pivot_city,
        "pivot_city_nofill": pivot_city_nofill,
        "dim_date": _dimension("date"),
        "dim_country": _dimension("country"),
        "dim_airport": _dimension("airport"),
        "dim_airport_unique": _dimension("airport", UNIQUE),
        "dim_demographics": _dimension("demographics"),
        "fact_table": fact_table,
        "star_join": star_join,
        "star_summary": star_summary,
        "star_roundtrip": star_roundtrip,
        "star_publish": star_publish,
        "monthly_load": monthly_load,
        "state_slice": state_slice,
        "rejected_rows": rejected_rows,
        "fk_audit": fk_audit,
        "arrivals_by_month": arrivals_by_month,
        "arrivals_by_weekday": arrivals_by_weekday,
        "arrivals_vs_demographics": arrivals_vs_demographics,
        "arrivals_vs_temperature": arrivals_vs_temperature,
        "airport_airline_usage": airport_airline_usage,
    } | LLM


# --- oracles --------------------------------------------------------------

_NUMERIC = (
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode", "depdate", "i94bir",
    "i94visa", "count", "biryear", "admnum",
)
_TEXT = (
    "i94port", "i94addr", "dtadfile", "visapost", "occup", "entdepa", "entdepd", "entdepu",
    "matflag", "dtaddto", "gender", "insnum", "airline", "fltno", "visatype",
)


def _profile_sql() -> str:
    rows = [
        f"""select '{c}' "column", count(*) n_rows, count("{c}") n_values,
        round(avg("{c}"), 6) mean, round(stddev_samp("{c}"), 6) stddev,
        round(min("{c}"), 6) "min", round(quantile_disc("{c}", 0.25), 6) q25,
        round(quantile_disc("{c}", 0.5), 6) q50, round(quantile_disc("{c}", 0.75), 6) q75,
        round(max("{c}"), 6) "max", cast(null as varchar) min_text,
        cast(null as varchar) max_text from raw_arrivals"""
        for c in _NUMERIC
    ]
    nothing = ", ".join(
        f'cast(null as double) "{c}"' for c in ("mean", "stddev", "min", "q25", "q50", "q75", "max")
    )
    rows += [
        f"""select '{c}' "column", count(*) n_rows, count("{c}") n_values, {nothing},
        min("{c}") min_text, max("{c}") max_text from raw_arrivals"""
        for c in _TEXT
    ]
    return "\nunion all\n".join(rows)


def _union(template: str, names) -> str:
    return "\nunion all\n".join(template.format(name=name) for name in names)


def _city_sql(zero: str) -> str:
    columns = [f"""round(avg("{m}"), 6) "{m.replace(' ', '')}Avg\"""" for m in MEASURES]
    columns += [
        f"""round(avg(case when "Race" = '{race}' then "Count" {zero} end), 6) "{name}\""""
        for name, race in RACES.items()
    ]
    return f"""select "State Code", "State", "City", {", ".join(columns)}
               from demographics group by 1, 2, 3"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, written the plain way: joins on fact rows,
    window functions for duplicates, one subquery per figure."""
    casts = ", ".join(f'cast(trunc("{c}") as int) "{c}"' for c in ARRIVALS.casts)
    averaged = ", ".join(
        f'round(avg("{c}"), 6) "{c}"' for c in (*MEASURES, "Count")
    )
    table_check = """
        select '{name}' "table", (select count(*) from {name}) n_rows,
               (select count(*) from (select distinct * from {name}) q) n_distinct,
               (select count(*) from {name})
                   - (select count(*) from (select distinct * from {name}) q) n_dup,
               (select count(*) from {name}) >= 10 enough_rows"""
    sources = ("arrivals", "demographics", "temperatures", "airports", "codes")
    audit = """
        select '{dim}' dimension, cast(f.{key} as varchar) "key", count(*) n_rows
        from fact f where not exists (select 1 from {table} d where d.{key} = f.{key})
        group by 2"""
    dims = {
        "date": ("dim_date", "arrival_date"),
        "country": ("dim_country", "country_code"),
        "airport": ("dim_airport", "arrival_port"),
        "demographics": ("dim_demographics", "state_code"),
    }
    views = [view for view, _ in dims.values()]
    return {
        "scan_dispatch": "select o_orderpriority, count(*) n_rows from orders group by 1",
        "sink_roundtrip": with_views(
            """select state_code, count(*) n_rows, count(arrival_date) n_dated,
                      min(arrival_date) first_arrival, max(depdate) last_departure,
                      cast(sum(cicid) as bigint) sum_cicid
               from fact group by 1""",
            "fact",
        ),
        "load_sources": with_views(
            _union("select '{name}' source, count(*) n_rows from {name}", sources), *sources
        ),
        "cast_columns": with_views(f"select {casts} from raw_arrivals", "raw_arrivals"),
        "cast_losses": with_views(
            """select 'visapost' "column", count(visapost) n_lost from raw_arrivals
               union all select 'fltno', 0
               union all select 'dtadfile', 0
               union all select 'entdepd', count(entdepd) from raw_arrivals""",
            "raw_arrivals",
        ),
        "drop_columns": with_views(
            "select * exclude (occup, entdepu, insnum) from raw_arrivals", "raw_arrivals"
        ),
        "dropna_subset": with_views("select * from demographics", "demographics"),
        "dedupe_subset": with_views("select * from airports", "airports"),
        "clean_source": with_views(
            "select * replace (strftime(dt, '%Y-%m-%d') as dt) from temperatures", "temperatures"
        ),
        "parse_dates": """
            select o_orderstatus, cast(year(d) as int) "year", count(*) n_rows,
                   strftime(max(d), '%Y-%m-%d') last_date
            from (select o_orderstatus, case when o_orderstatus <> 'P'
                                             then cast(o_orderdate as date) end d
                  from orders) q group by 1, 2""",
        "sas_dates": with_views(
            f"""select depdate, case when depdate <> 0 then {standin._DATE.format("depdate")} end
                       departure, count(*) n_rows
                from raw_arrivals group by 1, 2""",
            "raw_arrivals",
        ),
        "null_percent": with_views(
            _union(
                """select '{name}' "column",
                          round((count(*) - count("{name}")) * 100.0 / count(*), 6) percent_null
                   from raw_arrivals""",
                (*_NUMERIC, *_TEXT),
            ),
            "raw_arrivals",
        ),
        "date_out_of_range": with_views(
            """select 'dt out of range' "check", count(*) n_rows from raw_temperatures
               where dt < date '1700-01-01' or dt > date '2016-01-01'""",
            "raw_temperatures",
        ),
        "blank_strings": with_views(
            _union(
                """select '{name} blank' "check", count(*) n_rows from raw_temperatures
                   where trim("{name}") = ''""",
                ("City", "Country"),
            ),
            "raw_temperatures",
        ),
        "rows_at_max": with_views(
            """select * from raw_demographics
               where "Median Age" = (select max("Median Age") from raw_demographics)""",
            "raw_demographics",
        ),
        "distinct_keys": with_views(
            "select distinct i94port, i94mode from raw_arrivals", "raw_arrivals"
        ),
        "distinct_key_sets": with_views(
            """select 'date' dimension, count(*) n_keys
               from (select distinct nullif(arrdate, 0) from arrivals) q
               union all select 'country', count(*) from (select distinct i94res from arrivals) q
               union all select 'airport', count(*)
               from (select distinct i94port, i94mode = 1 from arrivals) q
               union all select 'demographics', count(*)
               from (select distinct i94addr from arrivals) q""",
            "arrivals",
        ),
        "distinct_counts": with_views(
            _union(
                """select '{name}' "column", count(*) n_distinct
                   from (select distinct "{name}" from raw_arrivals) q""",
                ("cicid", "i94port", "i94addr", "occup"),
            ),
            "raw_arrivals",
        ),
        "distinct_values": with_views(
            'select distinct "Race" from raw_demographics', "raw_demographics"
        ),
        "duplicate_count": with_views(
            """select (select count(*) from raw_temperatures)
                      - (select count(*) from (select distinct dt, "City", "Country"
                                               from raw_temperatures) q) n_duplicates""",
            "raw_temperatures",
        ),
        "key_uniqueness": """
            select 'lineitem' "table", count(*) n_rows,
                   count(distinct (l_orderkey, l_linenumber)) n_keys,
                   count(*) = count(distinct (l_orderkey, l_linenumber)) is_unique from lineitem
            union all
            select 'orders', count(*), count(distinct o_orderkey),
                   count(*) = count(distinct o_orderkey) from orders""",
        "column_profile": with_views(_profile_sql(), "raw_arrivals"),
        "sketched_quartiles": with_views(
            "\nunion all\n".join(
                f"""select '{c}' "column", '{q}' quantile, true within_error
                    from raw_arrivals having count("{c}") > 0"""
                for c in _NUMERIC
                for q in ("q25", "q50", "q75")
            ),
            "raw_arrivals",
        ),
        "csv_scan": """
            select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                   strftime(o_orderdate, '%Y-%m-%d') o_orderdate, o_orderpriority from orders""",
        "csv_scan_semicolon": """
            select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer""",
        "csv_scan_text": """
            select cast(s_suppkey as varchar) s_suppkey, s_name,
                   cast(s_nationkey as varchar) s_nationkey from supplier""",
        "observed_checks": with_views(
            _union(
                """select '{name}' source, (select count(*) from raw_{name}) n_read, case '{name}'
                          when 'arrivals' then (select count(visapost) + count(entdepd) from raw_arrivals)
                          when 'codes' then (select count(country) from raw_codes) else 0 end n_lost,
                          (select count(*) from {name}) n_rows""",
                sources,
            ),
            *sources,
        ),
        "distinct_sketched_by_month": with_views(
            _union(
                """select '{name}' "column", count(distinct (i94yr, i94mon)) n_months,
                          true within_error from raw_arrivals""",
                ("cicid", "i94port", "fltno", "occup"),
            ),
            "raw_arrivals",
        ),
        "table_checks": with_views(_union(table_check, sources), *sources),
        "top_n": with_views(
            'select * from raw_demographics order by "Median Age" desc, "Count" limit 5',
            "raw_demographics",
        ),
        "left_lookup": with_views(
            "select distinct i94res, country from arrivals left join codes on code = i94res",
            "arrivals",
            "codes",
        ),
        "avg_all_numeric": with_views(
            f'select "State Code", "State", {averaged} from raw_demographics group by 1, 2',
            "raw_demographics",
        ),
        "pivot_city": with_views(_city_sql("else 0"), "demographics"),
        "pivot_city_nofill": with_views(_city_sql(""), "demographics"),
        "dim_date": with_views("select * from dim_date", "dim_date"),
        "dim_country": with_views("select * from dim_country", "dim_country"),
        "dim_airport": with_views("select * from dim_airport", "dim_airport"),
        "dim_airport_unique": with_views("select * from dim_airport_unique", "dim_airport_unique"),
        "dim_demographics": with_views("select * from dim_demographics", "dim_demographics"),
        "fact_table": with_views("select * from fact", "fact"),
        "star_join": with_views(
            """select cicid, f.arrival_date, weekday, f.country_code, country, temperature_avg,
                      f.arrival_port, ident, municipality, f.state_code, "State", "MedianAgeAvg",
                      "RaceCountWhiteAvg", i94mode, airline
               from fact f
               left join dim_date d on d.arrival_date = f.arrival_date
               left join dim_country c on c.country_code = f.country_code
               left join dim_airport_unique a on a.arrival_port = f.arrival_port
               left join dim_demographics s on s.state_code = f.state_code""",
            "fact",
            "dim_airport_unique",
            *views,
        ),
        "star_roundtrip": with_views(
            "\nunion all\n".join(
                f"""select '{name}' "table", count(*) n_rows, count({key}) n_keyed from {view}"""
                for name, view, key in [*[(n, v, k) for n, (v, k) in dims.items()],
                                        ("fact", "fact", "state_code")]
            ),
            *[v for v, _ in dims.values()],
            "fact",
        ),
        "star_summary": with_views(
            "\nunion all\n".join(
                f"""select '{name}' "table", count(*) n_rows, count(*) >= 10 enough_rows
                    from {view}"""
                for name, view in [*[(n, v) for n, (v, _) in dims.items()], ("fact", "fact")]
            ),
            "fact",
            *views,
        ),
        "star_publish": with_views(
            "\nunion all\n".join(
                f"""select '{name}' "table", count(*) n_rows, count(*) >= 10 enough_rows,
                           'refused' "second" from {view}"""
                for name, view in [*[(n, v) for n, (v, _) in dims.items()], ("fact", "fact")]
            ),
            "fact",
            *views,
        ),
        "monthly_load": with_views(
            "\nunion all\n".join(
                [
                    f"""select cast(null as int) i94yr, cast(null as int) i94mon, '{name}' "table",
                               count(*) n_rows, count({key}) n_keyed from {view}"""
                    for name, (view, key) in dims.items()
                ]
                + [
                    """select i94yr, i94mon, 'fact' "table", count(*) n_rows,
                              count(state_code) n_keyed from fact group by 1, 2"""
                ]
            ),
            "fact",
            *views,
        ),
        "state_slice": with_views(
            """select f.state_code, 'ASIA' "State", count(*) n_arrivals,
                      round(avg(i94bir), 6) mean_age
               from fact f
               where exists (select 1 from dim_demographics d
                             where d.state_code = f.state_code and d."State" = 'ASIA')
               group by 1""",
            "fact",
            "dim_demographics",
        ),
        "rejected_rows": with_views(
            """select 'cast occup' fault, count(occup) n_rows from raw_arrivals
               union all
               select 'unknown country_code', count(*) from fact f
               where not exists (select 1 from dim_country d where d.country_code = f.country_code)
               union all
               select 'unknown state_code', count(*) from fact f
               where not exists (select 1 from dim_demographics d where d.state_code = f.state_code)
               union all
               select 'accepted', count(*) from raw_arrivals a
               where occup is null
                 and exists (select 1 from dim_country d where d.country_code = cast(trunc(a.i94res) as int))
                 and exists (select 1 from dim_demographics d where d.state_code = a.i94addr)""",
            "fact",
            "dim_country",
            "dim_demographics",
        ),
        "fk_audit": with_views(
            "\nunion all\n".join(
                audit.format(dim=name, table=view, key=key) for name, (view, key) in dims.items()
            ),
            "fact",
            *views,
        ),
        "arrivals_by_month": with_views(
            """select cast(year(cast(arrival_date as date)) as int) "year",
                      cast(month(cast(arrival_date as date)) as int) "month",
                      count(*) n_arrivals
               from fact group by 1, 2""",
            "fact",
        ),
        "arrivals_by_weekday": with_views(
            """select cast(dayofweek(cast(arrival_date as date)) + 1 as int) weekday,
                      count(*) n_arrivals
               from fact group by 1""",
            "fact",
        ),
        "arrivals_vs_demographics": with_views(
            """select f.*, d.* exclude (state_code)
               from (select state_code, count(*) n_arrivals, round(avg(i94bir), 6) mean_age
                     from fact group by 1) f
               left join dim_demographics d on d.state_code = f.state_code""",
            "fact",
            "dim_demographics",
        ),
        "arrivals_vs_temperature": with_views(
            """select f.country_code, count(*) n_arrivals, country, temperature_avg
               from fact f left join dim_country c on c.country_code = f.country_code
               group by 1, 3, 4""",
            "fact",
            "dim_country",
        ),
        "airport_airline_usage": with_views(
            """select f.arrival_port, airline, count(*) n_arrivals, ident, "type", municipality
               from fact f left join dim_airport_unique a on a.arrival_port = f.arrival_port
               group by 1, 2, 4, 5, 6""",
            "fact",
            "dim_airport_unique",
        ),
    } | LLM_SQL
