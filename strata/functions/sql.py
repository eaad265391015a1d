"""The library's functions for SQL users: temporary SQL functions of the session.

Each is a SQL expression or query that Catalyst inlines, so a query that calls them has the plan of one that spells them out. Fixed
values (key separator, NULL placeholder, year pattern) are those of the Python forms.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.functions.keys import KEY_SEPARATOR, NULL_PLACEHOLDER
from strata.functions.text import YEAR_IN_PARENS

FUNCTIONS = {
    "surrogate_key(parts ARRAY<STRING>) RETURNS STRING":
        f"md5(array_join(transform(parts, p -> coalesce(p, '{NULL_PLACEHOLDER}')), '{KEY_SEPARATOR}'))",
    "extract_year(title STRING) RETURNS STRING":
        f"nullif(regexp_extract(title, r'{YEAR_IN_PARENS}', 1), '')",
    "trunc_to_grain(at TIMESTAMP, grain STRING) RETURNS DATE":
        "to_date(date_trunc(grain, at))",
    "explode_delimited(value STRING, delimiter STRING) RETURNS TABLE(piece STRING)":
        r"SELECT trim(piece) FROM (SELECT explode(split(value, concat(r'\Q', delimiter, r'\E'), -1)) AS piece)",
    "date_spine(first DATE, past DATE) RETURNS TABLE(date_day DATE)":
        "SELECT explode(CASE WHEN past > first THEN sequence(first, date_sub(past, 1)) ELSE CAST(array() AS ARRAY<DATE>) END) AS date_day",
}


def register_functions(spark: SparkSession) -> None:
    """Create the functions in the session (temporary; an earlier one of the same name is replaced)."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
