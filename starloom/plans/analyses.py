"""The questions the star answers.

Each one starts from the fact's rows counted per foreign key, then joins a dimension. The
counts come from a table of counted keys (``plans.counted``), from which the dimensions are
built as well, so the arrivals are read once; or else from the fact. Spark does most of
that counting before the shuffle, so neither the size of the fact nor a hot key reaches
the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.counted import ROWS, CountedKeys
from starloom.specs import StarSpec

AGE = "i94bir"


def _per_key(
    star: Mapping[str, DataFrame],
    counted: CountedKeys | None,
    dimension: str,
    keys: Sequence[str],
    measures: Sequence[str] = (),
) -> DataFrame:
    """Rows per key, with ``sum_`` and ``values_`` of the measures."""
    if counted is not None:
        return counted.counts(dimension, by=keys[1:])
    parts = [F.count(F.lit(1)).alias(ROWS)]
    for m in measures:
        parts += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"values_{m}")]
    return star["fact"].groupBy(*keys).agg(*parts)


def arrivals_over_time(
    star: Mapping[str, DataFrame],
    spec: StarSpec,
    by: Sequence[str] = ("year", "month"),
    counted: CountedKeys | None = None,
) -> DataFrame:
    """Arrivals per calendar unit; those without a date are a null unit."""
    per_day = _per_key(star, counted, "date", [spec.date_key]).select(spec.date_key, ROWS)
    dated = per_day.join(star["date"], spec.date_key, "left")
    return dated.groupBy(*by).agg(F.sum(ROWS).alias(ROWS))


def arrivals_by_state(
    star: Mapping[str, DataFrame], spec: StarSpec, counted: CountedKeys | None = None
) -> DataFrame:
    """Arrivals and their mean age per state, with the state's demographics."""
    per_state = _per_key(star, counted, "demographics", [spec.state_key], [AGE])
    age = F.col(f"sum_{AGE}") / F.nullif(F.col(f"values_{AGE}"), F.lit(0))
    per_state = per_state.select(spec.state_key, ROWS, age.alias("mean_age"))
    return per_state.join(star["demographics"], spec.state_key, "left")


def arrivals_by_origin(
    star: Mapping[str, DataFrame], spec: StarSpec, counted: CountedKeys | None = None
) -> DataFrame:
    """Arrivals per country of origin, with its average temperature."""
    per_country = _per_key(star, counted, "country", [spec.country_key])
    return per_country.select(spec.country_key, ROWS).join(star["country"], spec.country_key, "left")


def airports_and_airlines(
    star: Mapping[str, DataFrame], spec: StarSpec, counted: CountedKeys | None = None
) -> DataFrame:
    """Arrivals per port and airline, with the port's airport.

    A port with several rows in the airport dimension would be counted several
    times; build the star with ``unique_ports``.
    """
    per_port = _per_key(star, counted, "airport", [spec.port_key, "airline"])
    airports = star["airport"].select(spec.port_key, "ident", "type", "municipality")
    return per_port.select(spec.port_key, "airline", ROWS).join(airports, spec.port_key, "left")
