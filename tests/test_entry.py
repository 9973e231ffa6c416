"""Every query against its SQL, on the smallest of the driver's data."""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_only_estimates_lack_an_oracle():
    own = set(spark_entry.queries()) - set(spark_entry.LLM)
    assert own - set(spark_entry.oracle_sql()) == {"column_profile_sketch"}
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = database.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == expected


def test_sketched_profile_differs_in_quartiles_only(spark):
    kept = ["column", "n_rows", "n_values", "mean", "stddev", "min", "max", "min_text", "max_text"]
    queries = spark_entry.queries()
    exact = queries["column_profile"](spark, SF_DIR).select(*kept)
    sketched = queries["column_profile_sketch"](spark, SF_DIR).select(*kept)
    assert sorted(map(repr, exact.collect())) == sorted(map(repr, sketched.collect()))
