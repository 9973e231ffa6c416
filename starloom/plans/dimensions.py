"""Dimension tables of the arrivals star.

Each builder takes the distinct keys that the arrivals use, not the arrivals:
keys are few, so the joins below stay small however many arrivals there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import CALENDAR, MISSING_DATE_ID, date_of_day, sas_day
from starloom.operators import average_numeric, key_sets, lookup, pivot_average
from starloom.plans.arrivals import MEASURES, RACES
from starloom.scratch import settle
from starloom.specs import StarSpec


def key_columns(dimension: str, spec: StarSpec) -> dict[str, Column]:
    """The columns that make up one dimension's keys."""
    if dimension == "date":
        return {"date_day": sas_day(F.col(spec.date))}
    if dimension == "country":
        return {"code_used": F.col(spec.country)}
    if dimension == "airport":
        by_air = F.coalesce(F.col(spec.mode) == spec.air_mode, F.lit(False))
        return {"port": F.col(spec.port), "by_air": by_air}
    return {"state_used": F.col(spec.state)}


DIMENSIONS = ("date", "country", "airport", "demographics")


def keys_of(arrivals: DataFrame, dimension: str, spec: StarSpec) -> DataFrame:
    """The distinct keys of one dimension."""
    columns = key_columns(dimension, spec)
    return arrivals.select(*[c.alias(name) for name, c in columns.items()]).distinct()


def keys_of_all(arrivals: DataFrame, spec: StarSpec) -> dict[str, DataFrame]:
    """The distinct keys of all dimensions from one scan of the arrivals."""
    columns = {d: key_columns(d, spec) for d in DIMENSIONS}
    keys = arrivals.select(
        *[c.alias(name) for per_dim in columns.values() for name, c in per_dim.items()]
    )
    table, picks = key_sets(keys, {d: list(per_dim) for d, per_dim in columns.items()})
    table = settle(table)
    return {d: table.where(picks[d]).select(*columns[d]) for d in DIMENSIONS}


def date_dimension(keys: DataFrame, spec: StarSpec) -> DataFrame:
    """One row per arrival date, and one without a date if any arrival lacks it.

    ``id`` is the day number: unique, and the same in every run.
    """
    dates = keys.withColumn("date", date_of_day(F.col("date_day")))
    return dates.select(
        F.col("date").cast("string").alias(spec.date_key),
        F.coalesce("date_day", F.lit(MISSING_DATE_ID)).cast("long").alias("id"),
        *[function("date").alias(name) for name, function in CALENDAR.items()],
    )


def country_dimension(
    keys: DataFrame, codes: DataFrame, temperatures: DataFrame, spec: StarSpec
) -> DataFrame:
    """Country name and average temperature of each code that has both.

    The temperature table's names are compared in upper case with the code
    table's names as they are. The average is over all cities and dates alike.
    """
    named = lookup(keys, "code_used", codes, "code").distinct()
    averages = average_numeric(temperatures.select("Country", "AverageTemperature"), ["Country"])
    averages = averages.select(
        F.col("Country").alias("measured_country"),
        F.col("AverageTemperature").alias("temperature_avg"),
    )
    joined = named.join(averages, F.upper("measured_country") == F.col("country"))
    return joined.select(
        F.col("code_used").alias(spec.country_key), "country", "temperature_avg"
    ).distinct()


def airport_dimension(keys: DataFrame, airports: DataFrame, spec: StarSpec) -> DataFrame:
    """The airport of each port, where the port is used by air.

    A port used by air and otherwise has two rows, one of them without an
    airport, unless ``unique_ports``. Port codes are compared with IATA codes
    though they are a coding of their own.
    """
    if spec.unique_ports:
        keys = keys.groupBy("port").agg(F.max("by_air").alias("by_air"))
    ports, found = keys.alias("ports"), airports.alias("found")
    matches = (F.col("ports.port") == F.col("found.iata_code")) & F.col("ports.by_air")
    return (
        ports.join(found, matches, "left")
        .select(F.col("ports.port").alias(spec.port_key), "found.*")
        .distinct()
    )


def city_demographics(demographics: DataFrame, zero_fill: bool = True) -> DataFrame:
    """Averages per city, with one column per race."""
    return pivot_average(
        demographics,
        keys=["State Code", "State", "City"],
        pivot="Race",
        value="Count",
        values=RACES,
        measures={name.replace(" ", "") + "Avg": name for name in MEASURES},
        zero_fill=zero_fill,
    )


def demographics_dimension(
    keys: DataFrame, demographics: DataFrame, spec: StarSpec
) -> DataFrame:
    """The mean over its cities, each counting once, for each state in use.

    States unknown to the demographics keep a row without values.
    """
    cities = city_demographics(demographics, spec.zero_fill)
    states = average_numeric(cities, ["State Code", "State"])
    used = keys.where(F.col("state_used").isNotNull())
    joined = lookup(used, "state_used", states, "State Code")
    return joined.withColumnRenamed("state_used", spec.state_key)
