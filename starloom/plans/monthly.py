"""Loads of some months into a star that is already written.

A load replaces the months it has arrivals of, and leaves the others as they are:

1. The dimensions of the new arrivals' keys are built and merged with the written ones; the
   merged tables, small ones, are published together (``sources.publish``).
2. The fact's months are overwritten by partition. Spark moves them in at the end of the job.

Dimensions come first, so no fact row ever lacks one. Each step gives the same tables if it is
run again, after a failure or for a month that is delivered anew. Months are the values of
the fact sink's partition columns; loads into one star run one at a time.

Arrivals of many loads are best stored by month first (``by_month``): the rows of a month are
then brought together once, and a load reads its own months and writes them without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.dimensions import keys_of_all
from starloom.plans.star import build_dimension, dimension_keys, fact_table
from starloom.scratch import scratch_folder, settle_all
from starloom.sources.publish import Files, publish, recover
from starloom.sources.sink import table_path, write_table
from starloom.specs import SinkSpec, StarSpec

MONTH = ("i94yr", "i94mon")


def monthly_sinks(sinks: Mapping[str, SinkSpec]) -> dict[str, SinkSpec]:
    """The sinks of a star that is loaded by months."""
    return dict(sinks) | {"fact": replace(sinks["fact"], partition_by=MONTH)}


def by_month(arrivals: DataFrame) -> DataFrame:
    """``settle`` for arrivals of many months: written by month, so conditions on the month
    choose the files that are read."""
    spark = arrivals.sparkSession
    path = write_table(arrivals, SinkSpec(scratch_folder(spark), "arrivals", MONTH))
    columns = [F.col(f"`{c}`") for c in arrivals.columns]
    return spark.read.schema(arrivals.schema).parquet(path).select(*columns)


def load_months(
    arrivals: DataFrame,
    sources: Mapping[str, DataFrame],
    spec: StarSpec,
    sinks: Mapping[str, SinkSpec],
    together: bool = False,
) -> dict[str, DataFrame]:
    """Load cleaned arrivals of whole months; returns the star as written.

    ``sources`` are the cleaned other sources. The arrivals are read twice, for their keys
    and for the fact: pass written ones. ``together`` says that the rows of a month lie
    together, as in arrivals from ``by_month``; the fact is then written without a shuffle.
    """
    spark = arrivals.sparkSession
    for folder in {sink.path for sink in sinks.values()}:
        recover(spark, folder)
    keys = keys_of_all(arrivals, spec)
    new = settle_all({name: build_dimension(name, keys[name], sources, spec) for name in keys})
    merged = {name: _merged(name, df, spec, sinks[name]) for name, df in new.items()}
    star = publish(merged, sinks)
    fact = fact_table(arrivals, spec)
    path = write_table(fact, sinks["fact"], replace="partitions", gather=not together)
    columns = [F.col(f"`{c}`") for c in fact.columns]
    star["fact"] = spark.read.schema(fact.schema).parquet(path).select(*columns)
    return star


def _merged(name: str, new: DataFrame, spec: StarSpec, sink: SinkSpec) -> DataFrame:
    """A written dimension with the rows of new keys, and the new rows of known ones."""
    spark, path = new.sparkSession, table_path(sink)
    if not Files(spark, path).exists(path):
        return new
    columns = [F.col(f"`{c}`") for c in new.columns]
    old = spark.read.schema(new.schema).parquet(path).select(*columns)
    if name == "airport" and spec.unique_ports:
        # a port may have been used by air in one of the loads only
        rest = [c for c in columns if c is not columns[0]]
        both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        matched = F.col("ident").isNotNull()
        best = F.max_by(F.struct(*rest), F.struct(matched.alias("matched"), F.col("_new")))
        return both.groupBy(columns[0]).agg(best.alias("row")).select(spec.port_key, "row.*")
    if name in ("date", "airport"):  # a row depends on nothing but its key
        return old.unionByName(new).distinct()
    key = dimension_keys(spec)[name]
    return old.join(new.select(key), key, "left_anti").select(*columns).unionByName(new)
