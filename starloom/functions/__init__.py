"""Column expressions: native Spark functions only, no Python UDF."""

from starloom.functions.casting import CAST_TYPES, safe_cast
from starloom.functions.dates import (
    CALENDAR,
    MISSING_DATE_ID,
    date_of_day,
    iso_date,
    parse_date,
    sas_day,
)
from starloom.functions.digests import can_digest, row_digests
from starloom.functions.names import fresh_name
from starloom.functions.predicates import is_blank, is_missing, outside

__all__ = [
    "CALENDAR",
    "CAST_TYPES",
    "MISSING_DATE_ID",
    "can_digest",
    "date_of_day",
    "fresh_name",
    "is_blank",
    "is_missing",
    "iso_date",
    "outside",
    "parse_date",
    "row_digests",
    "safe_cast",
    "sas_day",
]
