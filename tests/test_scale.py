"""The plans at scale: hot keys, pushed filters, sizes that decide a join."""

import pytest
from pyspark.sql import functions as F

from rows import tuples
from starloom import SinkSpec, StarSpec
from starloom.operators import attach_dimension, key_sets, missing_keys
from starloom.plans.star import dimension
from starloom.scratch import settle
from starloom.sources import write_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_fact(spark, n=60_000):
    """Half of the rows have one key, a sixth none."""
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(0, n, 1, 8).select(key.cast("int").alias("k"), F.col("id").alias("v"))


def dim(spark, n=50):
    return settle(spark.range(n).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("d")))


def test_dimension_columns_must_be_new(spark):
    with pytest.raises(ValueError, match="the fact has column d already"):
        attach_dimension(hot_fact(spark).withColumnRenamed("v", "D"), dim(spark), "k")


def test_small_dimension_is_broadcast(spark):
    joined = attach_dimension(hot_fact(spark), dim(spark), "k")
    assert "BroadcastHashJoin" in plan(joined)
    assert joined.count() == 60_000


def test_large_dimension_is_shuffled_and_hot_keys_are_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20kb",
    )
    joined = attach_dimension(hot_fact(spark), dim(spark), "k")
    rows = joined.collect()
    assert "skew=true" in plan(joined)
    assert len(rows) == 60_000
    assert all(r.d == (None if r.k is None else 2 * r.k) for r in rows)


def test_rows_without_a_key_are_dealt_out(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    fact = hot_fact(spark).withColumn("k", F.when(F.col("v") % 2 == 0, F.col("k")))
    joined = attach_dimension(fact, dim(spark), "k").withColumn("p", F.spark_partition_id())
    parts = joined.where("k is null").groupBy("p").count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2 * min(r["count"] for r in parts)


def test_audit_counts_keys_before_it_joins(spark):
    fact = hot_fact(spark)
    found = missing_keys(fact, {"dim": (dim(spark, 49), "k")})
    assert tuples(found) == [
        ("dim", "49", fact.where("k = 49").count()),
        ("dim", None, fact.where("k is null").count()),
    ]
    assert "partial_count" not in plan(found)  # the fact's keys were counted and written


def test_hot_partition_value_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="100kb")
    df = hot_fact(spark, 200_000)
    path = write_table(df, SinkSpec(str(tmp_path), "t", ["k"]))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert files["k=0"] > 4
    assert min(files.values()) <= 2
    assert spark.read.parquet(path).count() == 200_000


def test_keys_of_all_dimensions_come_from_one_scan(spark, tmp_path):
    hot_fact(spark).write.parquet(str(tmp_path / "f"))
    df = spark.read.parquet(str(tmp_path / "f"))
    table, _ = key_sets(df, {"a": ["k"], "b": ["v"]})
    assert plan(table).count("FileScan") == 1


def test_dimension_scans_its_key_columns_only(spark, tmp_path):
    spark.range(10).selectExpr(
        "cast(20545 as double) arrdate", "'x' i94port", "'y' airline"
    ).write.parquet(str(tmp_path / "arrivals"))
    arrivals = spark.read.parquet(str(tmp_path / "arrivals"))
    dates = dimension("date", {"arrivals": arrivals}, StarSpec())
    assert "ReadSchema: struct<arrdate:double>" in plan(dates)
    assert "Python" not in plan(dates)
