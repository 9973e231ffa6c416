"""Source scans chosen by path suffix."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from pathlib import PurePosixPath

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions import safe_cast
from starloom.operators.checks import cast_losses, lost_value
from starloom.operators.clean import cast_columns, clean, require_columns
from starloom.scratch import settle
from starloom.specs import SourceSpec

# Path suffix -> Spark data source. The last one is a third-party source that
# has to be on the session's class path; more can be passed as ``formats``.
FORMATS = {
    ".csv": "csv",
    ".parquet": "parquet",
    ".sas7bdat": "com.github.saurfang.sas.spark",
}


def format_of(path: str, formats: Mapping[str, str] = FORMATS) -> str:
    suffix = PurePosixPath(str(path)).suffix
    if suffix not in formats:
        raise ValueError(
            f"no source format for suffix {suffix!r} of {path} (known: {', '.join(formats)})"
        )
    return formats[suffix]


def read_source(
    spark: SparkSession, spec: SourceSpec, formats: Mapping[str, str] = FORMATS
) -> DataFrame:
    """Scan one source. Declared columns that it lacks raise ``ValueError``."""
    fmt = format_of(spec.path, formats)
    if fmt == "csv":
        return _read_csv(spark, spec)
    df = spark.read.format(fmt).load(spec.path)
    require_columns(df, spec.schema or (), f"source {spec.path}")
    return df


def _read_csv(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """All columns as text, those of declared types cast; ``source_losses`` counts what
    a cast turns into null. Spark's reader would drop such values without a trace."""
    as_text = spark.read.csv(
        spec.path, header=True, sep=spec.sep, inferSchema=spec.infer and not spec.schema
    )
    require_columns(as_text, spec.schema or (), f"source {spec.path}")
    return _typed(as_text, spec)


def _typed(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The columns of declared types, cast from what was read."""
    kinds = {c: t for c, t in (spec.schema or {}).items() if t != "string"}
    return df.withColumns(
        {c: safe_cast(F.col(f"`{c}`"), df.schema[c].dataType, t) for c, t in kinds.items()}
    )


def _raw(spark: SparkSession, spec: SourceSpec, formats: Mapping[str, str]) -> tuple[DataFrame, dict]:
    """A source as it is, and the casts that the spec makes of it."""
    fmt = format_of(spec.path, formats)
    if fmt == "csv":
        raw = spark.read.csv(spec.path, header=True, sep=spec.sep)
        declared = {c: t for c, t in (spec.schema or {}).items() if t != "string"}
    else:
        raw, declared = spark.read.format(fmt).load(spec.path), {}
    return raw, declared | dict(spec.casts or {})


def source_losses(spark: SparkSession, spec: SourceSpec, formats: Mapping[str, str] = FORMATS):
    """Values that the declared types and casts of a source turn into null:
    (column, n_lost), in one pass over the source as it is."""
    return cast_losses(*_raw(spark, spec, formats))


@dataclass(frozen=True)
class Loaded:
    """A cleaned source, and what was seen while it was parsed."""

    df: DataFrame
    n_read: int
    lost: Mapping[str, int]  # per cast column, values that it turned into null

    @property
    def n_lost(self) -> int:
        return sum(self.lost.values())


def load_observed(
    spark: SparkSession, spec: SourceSpec, formats: Mapping[str, str] = FORMATS
) -> Loaded:
    """Scan and clean a source, counting its rows and lost values in the pass that parses it.

    A row-based source is parsed once: the pass casts, counts (``DataFrame.observe``) and writes
    Parquet, and the rest of the cleaning reads that. No shuffle lies below the counts, so
    they are those of the writing tasks, of which Spark takes each once, however often it
    had to run. A Parquet source stays where it is and is counted by a scan of the columns
    to cast.
    """
    raw, casts = _raw(spark, spec, formats)
    if spec.infer and not spec.schema:
        raw = read_source(spark, spec, formats)
    names = list(casts)
    counts = [F.count(F.lit(1)).alias("n_read")]
    counts += [F.count_if(lost_value(raw, c, casts[c])).alias(f"lost_{i}") for i, c in enumerate(names)]
    if format_of(spec.path, formats) == "parquet":
        found = raw.agg(*counts).first().asDict()
        df = clean(read_source(spark, spec, formats), spec)
    else:
        require_columns(raw, [*(spec.schema or ()), *names], f"source {spec.path}")
        seen = Observation()
        parsed = _typed(raw.observe(seen, *counts), spec)
        for step in (spec.dropna, spec.dedupe, spec.dedupe_order, spec.drop):
            require_columns(parsed, step, f"source {spec.path}")
        parsed = settle(cast_columns(parsed, spec.casts) if spec.casts else parsed)
        found = seen.get
        df = clean(parsed, replace(spec, casts={}))
    return Loaded(df, found["n_read"], {c: found[f"lost_{i}"] for i, c in enumerate(names)})


def load_all_observed(
    spark: SparkSession, sources: Mapping[str, SourceSpec], formats: Mapping[str, str] = FORMATS
) -> dict[str, Loaded]:
    """``load_observed`` of every source of a run, as concurrent jobs."""
    for spec in sources.values():
        format_of(spec.path, formats)
    with ThreadPoolExecutor(max(len(sources), 1)) as pool:
        load = inheritable_thread_target(spark)(load_observed)
        loaded = pool.map(lambda spec: load(spark, spec, formats), sources.values())
        return dict(zip(sources, loaded, strict=True))


def load_sources(
    spark: SparkSession,
    sources: Mapping[str, SourceSpec],
    formats: Mapping[str, str] = FORMATS,
) -> dict[str, DataFrame]:
    """Scan and clean every source of a run."""
    for spec in sources.values():
        format_of(spec.path, formats)
    return {
        name: clean(read_source(spark, spec, formats), spec) for name, spec in sources.items()
    }
