"""Column-level building blocks (all built-in Spark expressions, no Python UDFs)."""

from strata.functions.dates import date_spine, date_spine_between, trunc_to_grain
from strata.functions.keys import surrogate_key
from strata.functions.text import explode_delimited, extract_year

__all__ = [
    "date_spine",
    "date_spine_between",
    "explode_delimited",
    "extract_year",
    "surrogate_key",
    "trunc_to_grain",
]
