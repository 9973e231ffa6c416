"""Specs of the arrivals star.

The column names, types, code values and table names below are fixed values:
they are those of the published source tables and of the star's readers.
"""

from __future__ import annotations

from collections.abc import Mapping

from starloom.specs import RunSpec, SinkSpec, SourceSpec, StarSpec

ARRIVALS_SCHEMA = {
    "cicid": "double",
    "i94yr": "double",
    "i94mon": "double",
    "i94cit": "double",
    "i94res": "double",
    "i94port": "string",
    "arrdate": "double",
    "i94mode": "double",
    "i94addr": "string",
    "depdate": "double",
    "i94bir": "double",
    "i94visa": "double",
    "count": "double",
    "dtadfile": "string",
    "visapost": "string",
    "occup": "string",
    "entdepa": "string",
    "entdepd": "string",
    "entdepu": "string",
    "matflag": "string",
    "biryear": "double",
    "dtaddto": "string",
    "gender": "string",
    "insnum": "string",
    "airline": "string",
    "admnum": "double",
    "fltno": "string",
    "visatype": "string",
}

DEMOGRAPHICS_SCHEMA = {
    "City": "string",
    "State": "string",
    "Median Age": "double",
    "Male Population": "double",
    "Female Population": "double",
    "Total Population": "int",
    "Number of Veterans": "double",
    "Foreign-born": "double",
    "Average Household Size": "double",
    "State Code": "string",
    "Race": "string",
    "Count": "int",
}

TEMPERATURES_SCHEMA = {
    "dt": "date",
    "AverageTemperature": "double",
    "City": "string",
    "Country": "string",
    "Latitude": "string",
    "Longitude": "string",
}

AIRPORTS_SCHEMA = {
    "ident": "string",
    "type": "string",
    "elevation_ft": "double",
    "continent": "string",
    "iso_country": "string",
    "iso_region": "string",
    "municipality": "string",
    "gps_code": "string",
    "iata_code": "string",
    "local_code": "string",
    "coordinates": "string",
}

# The code is text because some codes are padded with spaces; the cast trims.
CODES_SCHEMA = {"code": "string", "country": "string"}

# City measures that the demographics dimension averages.
MEASURES = (
    "Median Age",
    "Male Population",
    "Female Population",
    "Total Population",
    "Number of Veterans",
    "Foreign-born",
    "Average Household Size",
)

# Output column -> value of the Race column.
RACES = {
    "RaceCountHispLatAvg": "Hispanic or Latino",
    "RaceCountWhiteAvg": "White",
    "RaceCountAsianAvg": "Asian",
    "RaceCountBlackAfrAvg": "Black or African-American",
    "RaceCountNativeAvg": "American Indian and Alaska Native",
}

CLEANING = {
    "arrivals": {
        "schema": ARRIVALS_SCHEMA,
        "casts": {
            "cicid": "int",
            "i94yr": "int",
            "i94mon": "int",
            "biryear": "int",
            "arrdate": "int",
            "i94res": "int",
        },
        "drop": ("occup", "entdepu", "insnum"),
    },
    "demographics": {
        "schema": DEMOGRAPHICS_SCHEMA,
        "sep": ";",
        "dropna": (
            "Male Population",
            "Female Population",
            "Number of Veterans",
            "Foreign-born",
            "Average Household Size",
        ),
    },
    "temperatures": {
        "schema": TEMPERATURES_SCHEMA,
        "dropna": ("AverageTemperature",),
        "dedupe": ("dt", "City", "Country"),
    },
    "airports": {
        "schema": AIRPORTS_SCHEMA,
        "dedupe": ("iata_code",),
    },
    "codes": {
        "schema": CODES_SCHEMA,
        "sep": ";",
        "casts": {"code": "int"},
    },
}

SINKS = {
    "date": ("DIM_arrival_date", ("year", "month")),
    "country": ("DIM_origin_country", ()),
    "airport": ("DIM_arrival_airport", ()),
    "demographics": ("DIM_demographics", ()),
    "fact": ("FACT_immigration", ("state_code",)),
}


def arrivals_sources(paths: Mapping[str, str]) -> dict[str, SourceSpec]:
    """Source specs with the usual cleaning; ``paths`` maps source to path."""
    return {name: SourceSpec(path=paths[name], **CLEANING[name]) for name in CLEANING}


def arrivals_run(
    paths: Mapping[str, str], output: str, star: StarSpec | None = None
) -> RunSpec:
    """The whole run from ``paths`` into tables below the folder ``output``."""
    return RunSpec(
        sources=arrivals_sources(paths),
        star=star or StarSpec(),
        sinks={
            table: SinkSpec(path=output, name=name, partition_by=partitions)
            for table, (name, partitions) in SINKS.items()
        },
    )
