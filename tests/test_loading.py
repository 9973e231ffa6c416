"""Observed loads, staged publication, monthly loads, counted keys and quarantine."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import rows
from rows import tuples
from starloom import SinkSpec, SourceSpec, StarSpec
from starloom.operators import (
    attach_dimension,
    clean,
    distinct_counts,
    distinct_sketches,
    merged_distinct_counts,
    missing_keys,
    quarantine,
    tag_faults,
)
from starloom.plans import analyses, monthly
from starloom.plans import star as star_plan
from starloom.plans.arrivals import SINKS, arrivals_sources
from starloom.plans.counted import count_keys
from starloom.plans.star import run
from starloom.scratch import settle
from starloom.sources import load_observed, publish, recover, write_table
from starloom.sources.publish import JOURNAL, Files
from starloom.specs import RunSpec
from test_scale import plan
from test_sources import paths  # noqa: F401  a fixture

SPEC = StarSpec()


# --- metrics of the loading pass --------------------------------------------


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,d,k\n1,1.5,a\nx,abc,a\n,,b\n4,2,\n")
    return SourceSpec(path=str(path), schema={"i": "int", "d": "double"}, dropna=["k"], dedupe=["k"])


def test_rows_and_losses_come_from_the_parse(spark, csv):
    loaded = load_observed(spark, csv)
    assert (loaded.n_read, loaded.lost, loaded.n_lost) == (4, {"i": 1, "d": 1}, 2)
    assert tuples(loaded.df, "k") == [("a",), ("b",)]


def test_a_text_source_is_scanned_once(spark, csv):
    loaded = load_observed(spark, csv)
    assert "csv" not in plan(loaded.df).lower().replace(csv.path, "")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("parse", "", False)
    try:
        load_observed(spark, csv)
        jobs = tracker.getJobIdsForGroup("parse")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # the header, and the parse itself


def test_empty_and_parquet_sources_are_observed(spark, tmp_path):
    (tmp_path / "e.csv").write_text("i\n")
    empty = load_observed(spark, SourceSpec(path=str(tmp_path / "e.csv"), schema={"i": "int"}))
    assert (empty.n_read, empty.lost) == (0, {"i": 0}) and empty.df.count() == 0
    spark.createDataFrame([("1",), ("x",)], "i string").write.parquet(str(tmp_path / "p.parquet"))
    found = load_observed(spark, SourceSpec(path=str(tmp_path / "p.parquet"), casts={"i": "int"}))
    assert (found.n_read, found.lost) == (2, {"i": 1})
    assert tuples(found.df) == [(1,), (None,)]


def test_missing_columns_are_named_before_the_parse(spark, csv):
    with pytest.raises(ValueError, match="no column z"):
        load_observed(spark, SourceSpec(path=csv.path, schema={"i": "int"}, dedupe=["z"]))


RETRY = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from starloom import SourceSpec
from starloom.sources import scan

spark = (
    SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
    .config("spark.sql.files.maxPartitionBytes", "64").config("spark.sql.files.openCostInBytes", "1")
    .getOrCreate()
)
settle = scan.settle
attempts = spark.sparkContext.accumulator(0)

def failing(df):
    def fail_once(batches):
        yield from batches
        attempts.add(1)
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
    return settle(df.mapInPandas(fail_once, df.schema))

scan.settle = failing
loaded = scan.load_observed(spark, SourceSpec(path={path!r}, schema={{"i": "int"}}))
print("FOUND", loaded.n_read, loaded.n_lost, loaded.df.count())
"""


def test_a_task_that_runs_again_counts_once(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i\n" + "\n".join(["1", "x"] * 100) + "\n")
    code = RETRY.format(root=str(Path(__file__).resolve().parents[1]), path=str(path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, cwd=tmp_path)
    assert "FOUND 200 100 200" in done.stdout, done.stderr[-2000:]
    assert "lost" in done.stderr


# --- publication ------------------------------------------------------------


def two_tables(spark, value):
    return {name: spark.createDataFrame([(value, i) for i in range(3)], "p string, v int") for name in ("a", "b")}


@pytest.fixture
def sinks(tmp_path):
    return {"a": SinkSpec(str(tmp_path / "out"), "a", ["p"]), "b": SinkSpec(str(tmp_path / "out"), "b")}


def test_publication_replaces_all_tables(spark, sinks, tmp_path):
    publish(two_tables(spark, "old"), sinks)
    found = publish(two_tables(spark, "new"), sinks)
    assert {name: tuples(df) for name, df in found.items()} == dict.fromkeys("ab", [("new", i) for i in range(3)])
    assert {p.name for p in (tmp_path / "out").iterdir()} - {f".{JOURNAL}.crc"} == {"a", "b"}


def test_a_failed_check_leaves_the_old_tables(spark, sinks, tmp_path):
    old = publish(two_tables(spark, "old"), sinks)

    def refuse(staged):
        assert tuples(staged["a"])[0][0] == "new"
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        publish(two_tables(spark, "new"), sinks, refuse)
    assert tuples(old["a"]) == tuples(old["b"]) == [("old", i) for i in range(3)]
    assert not recover(spark, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} - {f".{JOURNAL}.crc"} == {"a", "b"}


@pytest.mark.parametrize("moves", range(5))
def test_an_interrupted_publication_is_finished(spark, sinks, tmp_path, monkeypatch, moves):
    """The two tables take four moves: stop after some of them."""
    publish(two_tables(spark, "old"), sinks)
    move, done = Files.move, []

    def stop(self, source, target):
        if not target.endswith(JOURNAL):
            if len(done) == moves:
                raise KeyboardInterrupt
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(Files, "move", stop)
    if moves < 4:
        with pytest.raises(KeyboardInterrupt):
            publish(two_tables(spark, "new"), sinks)
    else:
        publish(two_tables(spark, "new"), sinks)
    monkeypatch.setattr(Files, "move", move)
    assert recover(spark, str(tmp_path / "out")) is (moves < 4)
    for name in "ab":
        assert tuples(spark.read.parquet(str(tmp_path / "out" / name)), "p", "v") == [("new", i) for i in range(3)]
    assert not recover(spark, str(tmp_path / "out"))


def test_strict_run_leaves_the_old_star(spark, paths, tmp_path):  # noqa: F811
    from starloom.plans.arrivals import arrivals_run

    spec = arrivals_run(paths, str(tmp_path / "out"), StarSpec(unique_ports=True))
    star, checks, _ = run(spark, spec)
    before = {name: df.count() for name, df in star.items()}
    assert tuples(checks, "table", "n_read", "n_lost")[0] == ("airports", 1, 0)
    few = {n: SourceSpec(**(vars(s) | {"min_rows": 1})) for n, s in spec.sources.items()}
    strict = RunSpec(few, spec.star, spec.sinks)
    with pytest.raises(ValueError, match="too few rows in"):  # sinks want 10 rows each
        run(spark, strict, strict=True)
    assert {name: df.count() for name, df in star.items()} == before


# --- monthly loads ----------------------------------------------------------


@pytest.fixture(scope="module")
def sources(spark):
    def arrival(i, month, **more):
        base = {
            "cicid": float(i), "i94yr": 2016.0, "i94mon": float(month), "arrdate": 20454.0 + 31 * month,
            "i94res": 101.0, "i94port": "NYC", "i94mode": 2.0, "i94addr": "NY", "i94bir": 20.0 + i,
        }
        return base | more

    specs = arrivals_sources(dict.fromkeys(("arrivals", "demographics", "temperatures", "airports", "codes"), "x.csv"))
    raw = {
        "arrivals": rows.arrivals(spark, [
            arrival(1, 1), arrival(2, 1, i94addr=None, i94bir=None), arrival(3, 2, i94mode=1.0),
            arrival(4, 2, i94res=7.0, i94addr="CA", i94port="SEA"), arrival(5, 3, arrdate=None),
        ]),
        "demographics": rows.demographics(spark, [rows.city("NY", "Utica", "White", 1), rows.city("CA", "Fresno", "Asian", 2)]),
        "temperatures": rows.temperatures(spark, [{"Country": "albania", "AverageTemperature": 3.0}, {"Country": "peru", "AverageTemperature": 9.0}]),
        "airports": rows.airports(spark, [{"ident": "K1", "iata_code": "NYC"}]),
        "codes": rows.codes(spark, [{"code": "101", "country": "ALBANIA"}, {"code": "7", "country": "PERU"}]),
    }
    return {name: settle(clean(df, specs[name])) for name, df in raw.items()}


@pytest.mark.parametrize("unique", [False, True])
def test_monthly_loads_equal_the_whole(spark, sources, tmp_path, unique):
    spec = StarSpec(unique_ports=unique)
    sinks = monthly.monthly_sinks({n: SinkSpec(str(tmp_path), t, by) for n, (t, by) in SINKS.items()})
    arrivals = sources["arrivals"]
    for months in ((1,), (2, 3), (2,), (1,), (2, 3)):  # some of them again
        loaded = monthly.load_months(arrivals.where(F.col("i94mon").isin(*months)), sources, spec, sinks)
    whole = star_plan.build_star(sources, spec)
    for name, df in whole.items():
        assert tuples(loaded[name], *df.columns) == tuples(df, *df.columns), name


def test_a_month_delivered_anew_replaces_its_rows_only(spark, sources, tmp_path):
    sinks = monthly.monthly_sinks({n: SinkSpec(str(tmp_path), t, by) for n, (t, by) in SINKS.items()})
    arrivals = sources["arrivals"]
    monthly.load_months(arrivals, sources, SPEC, sinks)
    fewer = arrivals.where("cicid = 4")
    star = monthly.load_months(fewer, sources, SPEC, sinks)
    assert tuples(star["fact"], "cicid") == [(1,), (2,), (4,), (5,)]


def test_loads_of_months_stored_together_move_no_fact_rows(spark, sources, tmp_path, monkeypatch):
    sinks = monthly.monthly_sinks({n: SinkSpec(str(tmp_path), t, by) for n, (t, by) in SINKS.items()})
    undated = sources["arrivals"].where("cicid = 1").withColumns({"cicid": F.lit(6), "i94mon": F.lit(None).cast("int")})
    arrivals = sources["arrivals"].unionByName(undated)
    stored = monthly.by_month(arrivals)
    assert stored.schema == arrivals.schema
    assert tuples(stored) == tuples(arrivals)
    scans = []

    def seen(df, *args, **how):
        scans.append((plan(df), how["gather"]))
        return write_table(df, *args, **how)

    monkeypatch.setattr(monthly, "write_table", seen)
    late = F.coalesce(F.col("i94mon") > 1, F.lit(False))
    for part in (~late, late, late):
        loaded = monthly.load_months(stored.where(part), sources, SPEC, sinks, together=True)
    assert all("PartitionFilters: [" in text and "PartitionFilters: []" not in text for text, _ in scans)
    assert not any("Exchange" in text or gather for text, gather in scans)
    whole = star_plan.build_star(sources | {"arrivals": arrivals}, SPEC)
    for name, df in whole.items():
        assert tuples(loaded[name], *df.columns) == tuples(df, *df.columns), name


@pytest.mark.parametrize("gather", [True, False])
def test_ungathered_rows_are_written_by_the_tasks_that_have_them(spark, tmp_path, gather):
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option, None)
    df = spark.range(0, 400, 1, 4).selectExpr("id", "id % 2 as k")
    path = write_table(df, SinkSpec(str(tmp_path), "t", ["k"]), gather=gather)
    assert len(list((tmp_path / "t").glob("k=*/*.parquet"))) == (2 if gather else 8)
    assert sorted(tuples(spark.read.parquet(path), "id", "k")) == sorted((i, i % 2) for i in range(400))
    assert spark.conf.get(option, None) == before


def test_more_partition_values_than_writers(spark, tmp_path):
    df = spark.range(0, 4000, 1, 2).selectExpr("id", "id % 90 as k")
    path = write_table(df, SinkSpec(str(tmp_path), "t", ["k"]), gather=False)
    assert sorted(tuples(spark.read.parquet(path), "id", "k")) == [(i, i % 90) for i in range(4000)]


def test_replace_is_table_or_partitions(spark, tmp_path):
    with pytest.raises(ValueError, match="table or partitions"):
        write_table(spark.range(1), SinkSpec(str(tmp_path), "t"), replace="rows")


# --- counted keys -----------------------------------------------------------


def test_analyses_and_audit_are_those_of_the_fact(sources):
    spec = StarSpec(unique_ports=True)
    star = star_plan.build_star(sources, spec)
    dims, counted = star_plan.build_counted(sources, spec, also={"airport": ["airline"]})
    for name, df in dims.items():
        assert tuples(df) == tuples(star[name])
    for analysis in (analyses.arrivals_over_time, analyses.arrivals_by_state,
                     analyses.arrivals_by_origin, analyses.airports_and_airlines):
        from_fact = analysis(star, spec)
        assert tuples(analysis(dims, spec, counted=counted), *from_fact.columns) == tuples(from_fact, *from_fact.columns)
    assert tuples(star_plan.audit_keys(dims, spec, counted)) == tuples(star_plan.audit_keys(star, spec))


def test_counted_keys_scan_the_arrivals_once_and_write_keys(spark, sources, tmp_path, monkeypatch):
    from starloom.plans import counted as module

    written = []

    def seen(df):
        written.append((plan(df), df.count()))
        return settle(df)

    monkeypatch.setattr(module, "settle", seen)
    many = sources["arrivals"].crossJoin(spark.range(200)).drop("id")
    many.write.parquet(str(tmp_path / "arrivals"))
    count_keys(spark.read.parquet(str(tmp_path / "arrivals")), SPEC)
    ((text, n),) = written
    assert text.count("FileScan") == 1 and n <= 15
    assert "airline" not in text  # only the key columns are read


def test_key_columns_may_have_any_name(spark):
    fact = spark.createDataFrame([(1, 2), (None, 3)], "`a b` int, n_rows int")
    dim = spark.createDataFrame([(1,)], "`a b` int")
    other = spark.createDataFrame([(2,)], "n_rows int")
    found = missing_keys(fact, {"d": (dim, "a b"), "e": (other, "n_rows")})
    assert tuples(found) == [("d", None, 1), ("e", "3", 1)]


def test_no_column_of_the_fact_is_overwritten(spark):
    fact = spark.createDataFrame([(1, 7), (None, 8)], "k int, _spread int")
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    assert tuples(attach_dimension(fact, dim, "k")) == [(1, 7, "x"), (None, 8, None)]


# --- quarantine, slices, sketches -------------------------------------------


@pytest.fixture
def faulty(spark):
    df = spark.createDataFrame(
        [("1", "a", 1), ("x", "a", 2), ("2", "zz", 3), ("y", None, 4), (None, "b", 5)], "n string, k string, id int"
    )
    dim = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "code string")
    return df, {"n": "int"}, {"k": (dim, "code")}


def test_faults_are_tagged(faulty):
    df, casts, keys = faulty
    assert tuples(tag_faults(df, casts, keys).where("size(faults) > 0"), "id", "faults") == [
        (2, ["cast n"]), (3, ["unknown k"]), (4, ["cast n", "unknown k"]),
    ]


def test_rows_are_split_in_one_pass(faulty, tmp_path):
    df, casts, keys = faulty
    split = quarantine(df, casts, keys, str(tmp_path / "q"))
    assert tuples(split.accepted) == [(1, "a", 1), (None, "b", 5)]
    assert tuples(split.rejected, "n", "k", "id") == [("2", "zz", 3), ("x", "a", 2), ("y", None, 4)]
    assert tuples(split.by_reason()) == [("cast n", 2), ("unknown k", 2)]
    assert sorted(p.name for p in (tmp_path / "q").iterdir() if p.is_dir()) == ["rejected=false", "rejected=true"]
    assert "rejected" in plan(split.accepted).split("PartitionFilters")[1][:60]


def test_faults_beside_clashing_columns(spark, faulty):
    df, casts, keys = faulty
    df = df.withColumn("_known_k", F.lit(1)).withColumn("rejected", F.lit("r"))
    split = quarantine(df, casts, keys)
    assert split.accepted.columns == df.columns and split.accepted.count() == 2
    assert split.rejected.columns == [*df.columns, "faults"]
    assert quarantine(df.limit(0), casts, keys).rejected.count() == 0


def test_a_slice_reads_the_partitions_of_its_states(spark, sources, tmp_path):
    star = star_plan.build_star(sources, SPEC)
    sinks = {n: SinkSpec(str(tmp_path), t, by) for n, (t, by) in SINKS.items()}
    written = publish({n: star[n] for n in ("demographics", "fact")}, sinks)
    slice_ = star_plan.state_slice(written, SPEC, F.col("State") == "State CA")
    assert tuples(slice_, "cicid", "State") == [(4, "State CA")]
    fact_scan = next(line for line in plan(slice_).splitlines() if "FACT" in line)
    assert "dynamicpruning" in fact_scan


def test_sketches_of_months_give_distinct_counts_of_the_year(spark):
    df = spark.range(0, 30_000, 1, 4).select(
        (F.col("id") % 12).alias("m"), (F.col("id") % 7001).alias("a"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 11).alias("b"),
    )
    sketches = settle(distinct_sketches(df, ["a", "b"], ["m"]))
    found = {r["column"]: r.n_distinct for r in merged_distinct_counts(sketches, ["a", "b"]).collect()}
    exact = {r["column"]: r.n_distinct for r in distinct_counts(df, ["a", "b"]).collect()}
    assert found["b"] == exact["b"] == 12  # null is a value
    assert abs(found["a"] - 7001) <= 5 * 1.04 / 128 * 7001
    assert tuples(merged_distinct_counts(sketches.limit(0), ["a"])) == [("a", 0)]
