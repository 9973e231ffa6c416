"""Times the plain form of two steps against the form the library uses.

Reads the same settings as ``bench.py`` and prints one JSON line.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import bench
import standin
from starloom import StarSpec
from starloom.operators import average_numeric, table_check
from starloom.plans.dimensions import city_demographics
from starloom.plans.star import dimension
from starloom.scratch import settle

SPEC = StarSpec()


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, runs: int = 3) -> float:
    taken = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def main() -> None:
    spark = bench.session()
    sources = standin.sources(spark, bench.SF_DIR)
    # written once, so that the joins behind the arrivals are not timed
    arrivals = settle(sources["arrivals"])
    demographics = settle(sources["demographics"])

    def demographics_by_fact_rows():
        cities = city_demographics(demographics)
        joined = arrivals.select("i94addr").join(
            cities, F.col("i94addr") == F.col("State Code"), "left"
        )
        run(average_numeric(joined.dropna(subset=["i94addr"]), ["i94addr", "State"]))

    def demographics_by_distinct_states():
        inputs = {"arrivals": arrivals, "demographics": demographics}
        run(dimension("demographics", inputs, SPEC))

    def check_in_two_actions():
        arrivals.count(), arrivals.distinct().count()

    def check_in_one_action():
        table_check(arrivals, "arrivals").collect()

    forms = {
        "demographics joined to fact rows": demographics_by_fact_rows,
        "demographics joined to distinct states": demographics_by_distinct_states,
        "table check in two actions": check_in_two_actions,
        "table check in one action": check_in_one_action,
    }
    print(json.dumps({name: best(action) for name, action in forms.items()}))
    spark.stop()


if __name__ == "__main__":
    main()
