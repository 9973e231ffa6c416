import pytest

import rows
from rows import NAN, city, tuples
from starloom import StarSpec
from starloom.operators import clean
from starloom.plans import analyses
from starloom.plans import star as star_plan
from starloom.plans.arrivals import ARRIVALS_SCHEMA, AIRPORTS_SCHEMA, arrivals_sources
from starloom.plans.dimensions import city_demographics

SPEC = StarSpec()
UNIQUE = StarSpec(unique_ports=True)
SOURCES = arrivals_sources(
    {n: "x.csv" for n in ("arrivals", "demographics", "temperatures", "airports", "codes")}
)


@pytest.fixture(scope="module")
def raw(spark):
    def arrival(cicid, **more):
        base = {
            "arrdate": 20545.0, "depdate": 20550.0, "i94res": 101.0, "i94port": "NYC",
            "i94mode": 1.0, "i94addr": "NY", "airline": "AA", "i94bir": 30.0,
        }
        return base | {"cicid": float(cicid)} | more

    return {
        "arrivals": rows.arrivals(
            spark,
            [
                arrival(1),
                arrival(2, arrdate=20545.7, i94mode=2.0, depdate=20545.7),
                arrival(3, arrdate=None, i94port="SEA", i94mode=None, depdate=-1.5),
                arrival(4, arrdate=0.0, i94port=None, i94addr=None, depdate=NAN),
                arrival(5, i94res=0.0, i94addr="ZZ", i94port="XXX", airline="BB", depdate=None),
                arrival(6, i94res=999.0, arrdate=20547.0, i94bir=50.0),
                arrival(6, i94res=999.0, arrdate=20547.0, i94bir=50.0),
                arrival(7, i94res=None, arrdate=20456.0, i94addr="CA"),
            ],
        ),
        "demographics": rows.demographics(
            spark,
            [
                city("NY", "Albany", "White", 60, **{"Median Age": 30.0}),
                city("NY", "Albany", "Asian", 10, **{"Median Age": 30.0}),
                city("NY", "Utica", "White", 100, **{"Median Age": 40.0}),
                city("NY", "Gone", "White", 7, **{"Foreign-born": None}),
                city("CA", "Fresno", "Hispanic or Latino", 5),
                city("CA", "Fresno", "White", 5, State="California"),
            ],
        ),
        "temperatures": rows.temperatures(
            spark,
            [
                {"Country": "Albania", "City": "A", "AverageTemperature": 10.0},
                {"Country": "Albania", "City": "B", "AverageTemperature": 20.0},
                {"Country": "Albania", "City": "B", "AverageTemperature": None},
                {"Country": "Nowhere", "City": "C", "AverageTemperature": 5.0},
            ],
        ),
        "airports": rows.airports(
            spark,
            [
                {"ident": "K2", "iata_code": "NYC", "municipality": "second"},
                {"ident": "K1", "iata_code": "NYC", "municipality": "first"},
                {"ident": "K3", "iata_code": "SEA"},
                {"ident": "K4", "iata_code": None},
                {"ident": "K5", "iata_code": None},
                {"ident": "K6", "iata_code": "LAX"},
            ],
        ),
        "codes": rows.codes(
            spark,
            [
                {"code": "101", "country": "ALBANIA"},
                {"code": " 0 ", "country": "INVALID: STATELESS"},
                {"code": "705", "country": "INVALID: STATELESS"},
            ],
        ),
    }


@pytest.fixture(scope="module")
def sources(raw):
    return {name: clean(df, SOURCES[name]).persist() for name, df in raw.items()}


@pytest.fixture(scope="module")
def star(sources):
    return star_plan.build_star(sources, SPEC)


@pytest.fixture(scope="module")
def unique_star(sources):
    return star_plan.build_star(sources, UNIQUE)


def test_date_dimension(star):
    assert star["date"].dtypes == [
        ("arrival_date", "string"), ("id", "bigint"), ("day", "int"), ("week", "int"),
        ("month", "int"), ("year", "int"), ("weekday", "int"),
    ]
    assert tuples(star["date"]) == [
        ("2016-01-03", 20456, 3, 53, 1, 2016, 1),
        ("2016-04-01", 20545, 1, 13, 4, 2016, 6),
        ("2016-04-03", 20547, 3, 13, 4, 2016, 1),
        (None, -1000000, None, None, None, None, None),
    ]


def test_country_dimension_keeps_codes_with_name_and_temperature(star):
    assert star["country"].dtypes == [
        ("country_code", "int"), ("country", "string"), ("temperature_avg", "double"),
    ]
    assert tuples(star["country"]) == [(101, "ALBANIA", 15.0)]


def test_airport_dimension_has_two_rows_for_a_mixed_port(star):
    assert star["airport"].columns == ["arrival_port", *AIRPORTS_SCHEMA]
    assert tuples(star["airport"], "arrival_port", "ident") == [
        ("NYC", "K1"), ("NYC", None), ("SEA", None), ("XXX", None), (None, None),
    ]


def test_unique_airport_dimension_keeps_the_matched_row(unique_star):
    assert tuples(unique_star["airport"], "arrival_port", "ident") == [
        ("NYC", "K1"), ("SEA", None), ("XXX", None), (None, None),
    ]


def test_cities(sources):
    race = ["RaceCountWhiteAvg", "RaceCountAsianAvg", "RaceCountNativeAvg"]
    cities = city_demographics(sources["demographics"]).where("`State Code` = 'NY'")
    assert tuples(cities, "City", *race) == [
        ("Albany", 30.0, 5.0, 0.0), ("Utica", 100.0, 0.0, 0.0),
    ]
    counted = city_demographics(sources["demographics"], zero_fill=False)
    assert tuples(counted.where("City = 'Albany'"), *race) == [(60.0, 10.0, None)]


def test_demographics_dimension(star):
    dim = star["demographics"]
    assert dim.columns == [
        "state_code", "State", "MedianAgeAvg", "MalePopulationAvg", "FemalePopulationAvg",
        "TotalPopulationAvg", "NumberofVeteransAvg", "Foreign-bornAvg", "AverageHouseholdSizeAvg",
        "RaceCountHispLatAvg", "RaceCountWhiteAvg", "RaceCountAsianAvg", "RaceCountBlackAfrAvg",
        "RaceCountNativeAvg",
    ]
    assert {t for _, t in dim.dtypes[2:]} == {"double"}
    # two spellings of a state give two rows; an unknown one keeps a bare row
    assert tuples(dim, "state_code", "State", "MedianAgeAvg", "RaceCountWhiteAvg") == [
        ("CA", "California", 30.0, 5.0),
        ("CA", "State CA", 30.0, 0.0),
        ("NY", "State NY", 35.0, 65.0),
        ("ZZ", None, None, None),
    ]


def test_fact_table(star):
    fact = star["fact"]
    names = {
        "arrdate": "arrival_date", "i94res": "country_code", "i94port": "arrival_port",
        "i94addr": "state_code",
    }
    kept = [c for c in ARRIVALS_SCHEMA if c not in ("occup", "entdepu", "insnum")]
    assert fact.columns == [names.get(c, c) for c in kept]
    assert tuples(fact, "cicid", "arrival_date", "depdate")[:6] == [
        (1, "2016-04-01", "2016-04-06"),
        (2, "2016-04-01", "2016-04-01"),
        (3, None, "1959-12-30"),
        (4, None, None),
        (5, "2016-04-01", None),
        (6, "2016-04-03", "2016-04-06"),
    ]


def test_single_dimensions_equal_those_of_the_star(sources, star):
    for name in ("date", "country", "airport", "demographics"):
        assert tuples(star_plan.dimension(name, sources, SPEC)) == tuples(star[name])


def test_star_join_needs_unique_keys(star, unique_star, sources):
    with pytest.raises(ValueError, match="arrival_port.* not unique"):
        star_plan.star_join({**unique_star, "airport": star["airport"]}, UNIQUE)
    with pytest.raises(ValueError, match="state_code is not unique"):
        star_plan.star_join(unique_star, UNIQUE)


@pytest.fixture(scope="module")
def joinable(unique_star):
    states = unique_star["demographics"].where("State is null or State <> 'California'")
    return {**unique_star, "demographics": states}


def test_star_join_keeps_every_fact_row(joinable):
    joined = star_plan.star_join(joinable, UNIQUE)
    assert joined.count() == 8
    assert joined.columns[: len(joinable["fact"].columns)] == joinable["fact"].columns
    assert tuples(joined, "cicid", "weekday", "country", "ident", "State")[:5] == [
        (1, 6, "ALBANIA", "K1", "State NY"),
        (2, 6, "ALBANIA", "K1", "State NY"),
        (3, None, "ALBANIA", None, "State NY"),
        (4, None, "ALBANIA", None, None),
        (5, 6, None, None, None),
    ]


def test_key_audit(star):
    assert tuples(star_plan.audit_keys(star, SPEC)) == [
        ("airport", None, 1),
        ("country", "0", 1),
        ("country", "999", 2),
        ("country", None, 1),
        ("date", None, 2),
        ("demographics", None, 1),
    ]


def test_star_counts_and_schemas(spark, star):
    assert tuples(star_plan.star_counts(star, min_rows=5)) == [
        ("airport", 5, True), ("country", 1, False), ("date", 4, False),
        ("demographics", 4, False), ("fact", 8, True),
    ]
    report = star_plan.describe_tables(spark, {"country": star["country"]})
    assert tuples(report) == [
        ("country", 1, "country_code", "int"),
        ("country", 2, "country", "string"),
        ("country", 3, "temperature_avg", "double"),
    ]


def test_analyses(joinable):
    by_month = analyses.arrivals_over_time(joinable, UNIQUE)
    assert tuples(by_month) == [(2016, 1, 1), (2016, 4, 5), (None, None, 2)]
    by_weekday = analyses.arrivals_over_time(joinable, UNIQUE, by=["weekday"])
    assert tuples(by_weekday) == [(1, 3), (6, 3), (None, 2)]
    by_state = analyses.arrivals_by_state(joinable, UNIQUE)
    assert tuples(by_state, "state_code", "n_arrivals", "mean_age", "MedianAgeAvg") == [
        ("CA", 1, 30.0, 30.0), ("NY", 5, 38.0, 35.0), ("ZZ", 1, 30.0, None), (None, 1, 30.0, None),
    ]
    by_origin = analyses.arrivals_by_origin(joinable, UNIQUE)
    assert tuples(by_origin, "country_code", "n_arrivals", "temperature_avg") == [
        (0, 1, None), (101, 4, 15.0), (999, 2, None), (None, 1, None),
    ]
    usage = analyses.airports_and_airlines(joinable, UNIQUE)
    assert tuples(usage, "arrival_port", "airline", "n_arrivals", "ident") == [
        ("NYC", "AA", 5, "K1"), ("SEA", "AA", 1, None), ("XXX", "BB", 1, None), (None, "AA", 1, None),
    ]
