from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import NAN, tuples
from starloom.functions import CAST_TYPES, is_blank, is_missing, iso_date, outside, parse_date
from starloom.functions import safe_cast, sas_day


def iso(spark, *numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "d double")
    return [r[0] for r in df.select(iso_date(F.col("d"))).collect()]


def test_day_numbers_become_iso_dates(spark):
    assert iso(spark, 20545.0, 1.0, -1.0) == ["2016-04-01", "1960-01-02", "1959-12-31"]


def test_null_zero_and_nan_are_no_date(spark):
    assert iso(spark, None, 0.0, -0.0, NAN) == [None] * 4


def test_fractions_floor_below_zero_too(spark):
    assert iso(spark, 20545.7, -1.5, -0.5, 0.5) == [
        "2016-04-01", "1959-12-30", "1959-12-31", "1960-01-01",
    ]


def test_a_day_number_out_of_range_is_null(spark):
    df = spark.createDataFrame([(1e12,)], "d double")
    assert df.select(sas_day(F.col("d"))).first()[0] is None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-100_000, 100_000), min_size=1, max_size=200))
def test_iso_date_is_python_date_arithmetic(spark, days):
    day_0 = date.fromisoformat("1960-01-01").toordinal()
    found = iso(spark, *[float(d) for d in days])
    assert [text and date.fromisoformat(text).toordinal() - day_0 for text in found] == [
        d or None for d in days
    ]


TEXT_CASTS = [
    ("2016", "int", 2016),
    ("2016.0", "int", 2016),
    ("2016.9", "int", 2016),
    (" 54", "int", 54),
    (" 0 ", "int", 0),
    ("-3", "int", -3),
    ("1e3", "int", 1000),
    ("", "int", None),
    ("x", "int", None),
    ("1d", "int", None),
    ("99999999999", "int", None),
    ("NaN", "int", None),
    ("9007199254740993", "long", 9007199254740993),
    ("7.5", "long", 7),
    ("2.5", "double", 2.5),
    ("abc", "double", None),
    ("Infinity", "double", float("inf")),
    ("0.5", "float", 0.5),
    ("2016-04-01", "date", date(2016, 4, 1)),
    ("no date", "date", None),
]


@pytest.mark.parametrize("text,to,expected", TEXT_CASTS)
def test_text_casts(spark, text, to, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(safe_cast(F.col("t"), T.StringType(), to)).first()[0] == expected


def test_number_casts_truncate_and_never_fail(spark):
    df = spark.createDataFrame([(2016.7,), (1e20,), (NAN,), (None,)], "d double")
    cast = df.select(safe_cast(F.col("d"), T.DoubleType(), "int"))
    assert [r[0] for r in cast.collect()] == [2016, None, None, None]


def test_str_is_an_alias_of_string(spark):
    df = spark.createDataFrame([(5,)], "n int")
    assert df.select(safe_cast(F.col("n"), T.IntegerType(), "str")).first()[0] == "5"
    assert {"int", "float", "str"} <= set(CAST_TYPES)


def test_unknown_cast_type(spark):
    with pytest.raises(ValueError, match="unknown cast type 'blob'"):
        safe_cast(F.lit("x"), T.StringType(), "blob")


def test_parse_date(spark):
    df = spark.createDataFrame([("2016-04-01",), ("01.04.2016",), (None,)], "t string")
    plain = [r[0] for r in df.select(parse_date(F.col("t"))).collect()]
    formatted = [r[0] for r in df.select(parse_date(F.col("t"), "dd.MM.yyyy")).collect()]
    assert plain == [date(2016, 4, 1), None, None]
    assert formatted == [None, date(2016, 4, 1), None]


def test_predicates(spark):
    df = spark.createDataFrame(
        [(NAN, "x", 1), (None, " ", 5), (1.0, "", 9), (2.0, None, None)], "d double, t string, n int"
    )
    assert df.where(is_missing(df, "d")).count() == 2
    assert df.where(is_missing(df, "t")).count() == 1
    assert df.where(is_blank(F.col("t"))).count() == 2
    assert tuples(df.where(outside(F.col("n"), 1, 5)), "n") == [(9,)]
