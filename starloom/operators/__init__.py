"""Operators: functions from DataFrames to DataFrames."""

from starloom.operators.aggregate import average_numeric, key_sets, pivot_average
from starloom.operators.checks import (
    cast_losses,
    check_tables,
    count_distinct_rows,
    lost_value,
    require_passed,
    table_check,
)
from starloom.operators.clean import (
    cast_columns,
    clean,
    dedupe,
    drop_columns,
    drop_missing,
    require_columns,
)
from starloom.operators.join import (
    attach_dimension,
    attach_dimensions,
    lookup,
    mark_known,
    missing_keys,
    missing_of_counted,
)
from starloom.operators.profile import (
    column_profile,
    count_where,
    distinct_counts,
    distinct_sketches,
    distinct_values,
    duplicate_count,
    key_uniqueness,
    merged_distinct_counts,
    null_percent,
    quantile_ranks,
    rows_at_max,
    sketched_quantiles,
    top_n,
)
from starloom.operators.quantiles import exact_quantiles
from starloom.operators.quarantine import Quarantine, quarantine, tag_faults

__all__ = [
    "Quarantine",
    "attach_dimension",
    "attach_dimensions",
    "average_numeric",
    "cast_columns",
    "cast_losses",
    "check_tables",
    "clean",
    "column_profile",
    "count_distinct_rows",
    "count_where",
    "dedupe",
    "distinct_counts",
    "distinct_sketches",
    "distinct_values",
    "drop_columns",
    "drop_missing",
    "duplicate_count",
    "exact_quantiles",
    "key_sets",
    "key_uniqueness",
    "lookup",
    "lost_value",
    "mark_known",
    "merged_distinct_counts",
    "missing_keys",
    "missing_of_counted",
    "null_percent",
    "pivot_average",
    "quantile_ranks",
    "quarantine",
    "require_columns",
    "require_passed",
    "rows_at_max",
    "sketched_quantiles",
    "table_check",
    "tag_faults",
    "top_n",
]
