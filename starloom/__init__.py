"""Star schemas from raw tabular sources, as Spark DataFrame jobs.

Read the sources from a declarative spec, clean and check them, build
dimensions and a fact table, audit the keys, write partitioned Parquet and
answer the usual star queries.
"""

from starloom.specs import RunSpec, SinkSpec, SourceSpec, StarSpec

__all__ = ["RunSpec", "SinkSpec", "SourceSpec", "StarSpec"]
