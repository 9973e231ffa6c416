import json

import pytest

from rows import tuples
from starloom import RunSpec, SinkSpec, SourceSpec, StarSpec
from starloom.plans import star as star_plan
from starloom.plans.arrivals import ARRIVALS_SCHEMA, CLEANING, arrivals_run
from starloom.scratch import scratch_folder, settle
from starloom.sources import FORMATS, format_of, load_sources, read_source, write_table


def text_file(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_format_by_suffix():
    assert format_of("a/b.csv") == "csv"
    assert format_of("/shared/b.parquet") == "parquet"
    assert format_of("b.orc", {**FORMATS, ".orc": "orc"}) == "orc"
    with pytest.raises(ValueError, match="no source format for suffix '.xyz'"):
        format_of("b.xyz")


def test_unknown_suffix_fails_before_any_read(spark):
    sources = {"a": SourceSpec(path="/nowhere/a.csv"), "b": SourceSpec(path="/nowhere/b.doc")}
    with pytest.raises(ValueError, match="suffix '.doc'"):
        load_sources(spark, sources)


def test_csv_without_schema_is_text(spark, tmp_path):
    path = text_file(tmp_path, "t.csv", "i94yr,name", "2016.0,x")
    df = read_source(spark, SourceSpec(path=path))
    assert df.dtypes == [("i94yr", "string"), ("name", "string")]
    df = load_sources(spark, {"t": SourceSpec(path=path, casts={"i94yr": "int"})})["t"]
    assert tuples(df) == [(2016, "x")]


def test_csv_schema_follows_the_header_by_name(spark, tmp_path):
    path = text_file(tmp_path, "t.csv", "note;b;a", "n;2.5;x", "m;;y")
    spec = SourceSpec(path=path, sep=";", schema={"a": "string", "b": "double"})
    df = read_source(spark, spec)
    assert df.dtypes == [("note", "string"), ("b", "double"), ("a", "string")]
    assert tuples(df) == [("m", None, "y"), ("n", 2.5, "x")]


def test_missing_column_is_named(spark, tmp_path):
    path = text_file(tmp_path, "t.csv", "a", "1")
    with pytest.raises(ValueError, match="t.csv: no column b"):
        read_source(spark, SourceSpec(path=path, schema={"a": "int", "b": "int"}))
    with pytest.raises(ValueError, match="t.csv: no column c"):
        load_sources(spark, {"t": SourceSpec(path=path, dropna=["c"])})


def test_other_formats_by_name(spark, tmp_path):
    path = str(tmp_path / "t.json")
    spark.range(3).toDF("x").write.json(path)
    spec = SourceSpec(path=path, schema={"x": "long"})
    assert read_source(spark, spec, {".json": "json"}).count() == 3


def test_settle_keeps_rows_and_names(spark):
    df = spark.sql("select 1 `State Code`, 'a' `Foreign-bornAvg` union all select null, 'b'")
    settled = settle(df)
    assert settled.dtypes == df.dtypes
    assert tuples(settled) == tuples(df)


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second
    assert not shared or first.startswith(shared)


def test_partitioned_sink_round_trip(spark, tmp_path):
    df = spark.sql(
        "select 'NY' state, 1 x union all select 'CA', 2 union all select null, 3 union all "
        "select 'NY', 4"
    )
    path = write_table(df, SinkSpec(str(tmp_path), "t", ["state"]))
    write_table(df, SinkSpec(str(tmp_path), "t", ["state"]))  # overwrites
    assert path == f"{tmp_path}/t"
    back = spark.read.parquet(path)
    assert tuples(back.select("state", "x")) == tuples(df)
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {
        "state=NY", "state=CA", "state=__HIVE_DEFAULT_PARTITION__",
    }
    assert "PartitionFilters: [isnotnull(state" in (
        back.where("state = 'NY'")._jdf.queryExecution().executedPlan().toString()
    )


def test_sink_columns_must_exist(spark, tmp_path):
    with pytest.raises(ValueError, match="sink t: no column s"):
        write_table(spark.range(1).toDF("x"), SinkSpec(str(tmp_path), "t", ["s"]))


@pytest.fixture
def paths(tmp_path):
    header = list(ARRIVALS_SCHEMA)
    lines = [",".join(header)]
    for i in range(12):
        row = dict.fromkeys(header, "") | {
            "cicid": f"{i}.0", "i94yr": "2016.0", "arrdate": f"{20545 + i % 3}.0",
            "i94res": "101.0", "i94port": "NYC", "i94mode": "1.0", "i94bir": "30.0",
            "i94addr": "NY" if i % 2 else "", "depdate": "20550.0", "airline": "AA",
        }
        lines.append(",".join(row[c] for c in header))
    return {
        "arrivals": text_file(tmp_path, "arrivals.csv", *lines),
        "demographics": text_file(
            tmp_path,
            "demographics.csv",
            ";".join(CLEANING["demographics"]["schema"]),
            "Albany;New York;30.5;10;12;22;1;2;2.5;NY;White;60",
            "Albany;New York;30.5;10;12;22;1;2;2.5;NY;Asian;10",
            "Gone;New York;30.5;;12;22;1;2;2.5;NY;Asian;10",
        ),
        "temperatures": text_file(
            tmp_path,
            "temperatures.csv",
            "dt,AverageTemperature,City,Country,Latitude,Longitude",
            "2000-01-01,10.5,A,Albania,1N,2E",
            "2000-01-01,10.5,A,Albania,1N,2E",
            "2000-02-01,,A,Albania,1N,2E",
        ),
        "airports": text_file(
            tmp_path,
            "airports.csv",
            ",".join(CLEANING["airports"]["schema"]),
            'K1,small_airport,11,NA,US,US-NY,"New York",K1,NYC,N1,"-70.1, 40.2"',
        ),
        "codes": text_file(tmp_path, "codes.csv", "code;country", "101;ALBANIA", " 0 ;NONE, AT ALL"),
    }


def test_whole_run(spark, paths, tmp_path):
    spec = arrivals_run(paths, str(tmp_path / "out"), StarSpec(unique_ports=True))
    star, checks, counts = star_plan.run(spark, spec)
    assert tuples(checks, "table", "n_rows", "n_dup", "enough_rows") == [
        ("airports", 1, 0, False), ("arrivals", 12, 0, True), ("codes", 2, 0, False),
        ("demographics", 2, 0, False), ("temperatures", 1, 0, False),
    ]
    assert tuples(counts, "table", "n_rows") == [
        ("airport", 1), ("country", 1), ("date", 3), ("demographics", 1), ("fact", 12),
    ]
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert written == {
        "DIM_arrival_date", "DIM_origin_country", "DIM_arrival_airport", "DIM_demographics",
        "FACT_immigration",
    }
    assert star["date"].columns[0] == "arrival_date"
    joined = star_plan.star_join(star, spec.star)
    assert joined.count() == 12
    assert tuples(joined.where("cicid = 1"), "country", "coordinates", "RaceCountWhiteAvg") == [
        ("ALBANIA", "-70.1, 40.2", 30.0)
    ]


def test_strict_run_stops_before_writing(spark, paths, tmp_path):
    with pytest.raises(ValueError, match="table checks failed"):
        star_plan.run(spark, arrivals_run(paths, str(tmp_path / "out")), strict=True)
    assert not (tmp_path / "out").exists()


def test_specs_round_trip_as_json(paths, tmp_path):
    spec = arrivals_run(paths, "out", StarSpec(zero_fill=False))
    spec.write_json(tmp_path / "run.json")
    again = RunSpec.read_json(tmp_path / "run.json")
    assert json.dumps(again.to_dict()) == json.dumps(spec.to_dict())
    assert again.star.zero_fill is False


def test_unknown_spec_fields_are_named():
    with pytest.raises(ValueError, match="SourceSpec has no field paht"):
        RunSpec.from_dict({"sources": {"a": {"paht": "x"}}})
    with pytest.raises(ValueError, match="RunSpec has no field sink"):
        RunSpec.from_dict({"sources": {}, "sink": {}})
