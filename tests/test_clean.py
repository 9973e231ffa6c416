import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rows import NAN, tuples
from starloom import SourceSpec
from starloom.functions import row_digests
from starloom.operators import (
    cast_columns,
    cast_losses,
    check_tables,
    clean,
    count_distinct_rows,
    dedupe,
    drop_columns,
    drop_missing,
    require_passed,
    table_check,
)


def test_cast_columns_keeps_order_and_other_columns(spark):
    df = spark.createDataFrame([("1.0", "a", 2.5)], "x string, y string, z double")
    cast = cast_columns(df, {"z": "int", "x": "int"})
    assert cast.dtypes == [("x", "int"), ("y", "string"), ("z", "int")]
    assert tuples(cast) == [(1, "a", 2)]


def test_cast_losses_counts_values_that_turn_null(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("y",)], "t string")
    assert tuples(cast_losses(df, {"t": "int"})) == [("t", 2)]


def test_columns_must_exist(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for call in (
        lambda: cast_columns(df, {"b": "int"}),
        lambda: drop_columns(df, ["b"]),
        lambda: drop_missing(df, ["b"]),
        lambda: dedupe(df, ["b"]),
        lambda: clean(df, SourceSpec(path="some.csv", drop=["b"])),
    ):
        with pytest.raises(ValueError, match="no column b"):
            call()


def test_drop_missing_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert tuples(drop_missing(df, ["x"]), "x") == [(1.0,), (2.0,)]


def test_dedupe_keeps_the_first_in_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")], "k string, o int, v string"
    )
    assert tuples(dedupe(df, ["k"], ["o"])) == [("a", 1, "early"), ("b", 5, "only")]
    assert dedupe(df, ["k"], ["o"]).columns == df.columns


def test_dedupe_takes_one_whole_row(spark):
    df = spark.createDataFrame([("a", None, "z"), ("a", 1, "b")], "k string, o int, v string")
    assert tuples(dedupe(df, ["k"], ["o"])) == [("a", None, "z")]


def test_dedupe_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "k string, v int")
    assert tuples(dedupe(df, ["k"])) == [("x", 3), (None, 1)] or tuples(dedupe(df, ["k"])) == [
        (None, 1), ("x", 3),
    ]


def test_dedupe_on_all_columns_is_distinct(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert tuples(dedupe(df, ["a", "b"])) == [(1, 2), (1, 3)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.integers(0, 3)),
            st.text("ab", max_size=2),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_dedupe_is_the_smallest_row_of_each_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, v string")
    smallest = {}
    for k, o, v in rows:
        rank = (o is not None, o or 0, v)  # nulls first, as Spark sorts
        if k not in smallest or rank < smallest[k][0]:
            smallest[k] = (rank, (k, o, v))
    expected = sorted((row for _, row in smallest.values()), key=repr)
    assert tuples(dedupe(df, ["k"], ["o"])) == expected


def test_dedupe_sends_one_row_per_key_and_task(spark):
    """A key with all rows is reduced before the shuffle."""
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    plan = dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan[plan.index("Exchange") :]
    assert tuples(dedupe(df, ["k"])) == [("hot", 0)]


def test_clean_drops_missing_values_before_duplicates(spark):
    """A row about to vanish must not replace its complete twin."""
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 3.0, 2), ("b", 1.0, 3)], "k string, t double, junk int"
    )
    spec = SourceSpec(path="t.csv", dropna=["t"], dedupe=["k"], drop=["junk"])
    assert tuples(clean(df, spec)) == [("a", 3.0), ("b", 1.0)]


def test_clean_may_order_by_a_dropped_column(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 3)], "k string, v int, o int")
    spec = SourceSpec(path="t.csv", dedupe=["k"], dedupe_order=["o"], drop=["o"])
    assert tuples(clean(df, spec)) == [("a", 2)]


def test_clean_casts_first(spark):
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    spec = SourceSpec(path="t.csv", casts={"n": "int"}, dropna=["n"])
    assert tuples(clean(df, spec)) == [(1,)]


def test_table_check_counts_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, "b")], "x int, y string")
    assert tuples(table_check(df, "t", min_rows=5)) == [("t", 5, 3, 2, True)]
    assert tuples(table_check(df.limit(0), "t")) == [("t", 0, 0, 0, False)]


def odd_rows(spark):
    rows = [
        (1, 0.0, "a", None), (1, -0.0, "a", None), (1, NAN, "a", None), (1, NAN, "a", None),
        (None, 1.0, None, "b"), (None, 1.0, "b", None), (None, 1.0, "b", None), (2, 1.0, "x", "y"),
    ]
    return spark.createDataFrame(rows, "i int, d double, s string, t string")


def one_digest(df):
    return F.lit(1).cast("long"), F.lit(1).cast("long")


@pytest.mark.parametrize("digests", [row_digests, one_digest])
def test_distinct_rows_by_digest_are_exact(spark, digests):
    """Also where all digests collide: then every row is compared in full."""
    df = odd_rows(spark)
    assert count_distinct_rows(df, digests) == (8, df.distinct().count()) == (8, 5)
    assert count_distinct_rows(df.limit(0), digests) == (0, 0)


def test_nested_columns_are_grouped_as_they_are(spark):
    df = spark.createDataFrame([([0.0],), ([-0.0],), (None,), (None,)], "a array<double>")
    assert count_distinct_rows(df) == (4, df.distinct().count())


def test_digest_columns_may_clash(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "_digest_a int, _digest_b int")
    assert count_distinct_rows(df) == (3, 2)


def test_digests_and_not_rows_are_shuffled(spark):
    df = spark.range(10).select(F.col("id"), F.lit("wide").alias("text"))
    first, second = row_digests(df)
    counted = df.withColumns({"x": first, "y": second}).groupBy("x", "y").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "keys=[x#" in plan and "text" not in plan.split("Exchange")[0]


def test_checks_only_report_unless_asked(spark):
    good = spark.range(20).toDF("x")
    checks = check_tables({"good": good, "few": good.where("x < 3")}, {"good": 10, "few": 10})
    assert tuples(checks, "table", "enough_rows") == [("few", False), ("good", True)]
    with pytest.raises(ValueError, match="few: 3 rows, 0 duplicates"):
        require_passed(checks)
    require_passed(check_tables({"good": good}))
