"""Reading sources and writing tables."""

from starloom.sources.publish import publish, recover
from starloom.sources.scan import (
    FORMATS,
    Loaded,
    format_of,
    load_all_observed,
    load_observed,
    load_sources,
    read_source,
    source_losses,
)
from starloom.sources.sink import table_path, write_table

__all__ = [
    "FORMATS",
    "Loaded",
    "format_of",
    "load_all_observed",
    "load_observed",
    "load_sources",
    "publish",
    "read_source",
    "recover",
    "source_losses",
    "table_path",
    "write_table",
]
