"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the key macro's output byte for byte so that keys
# built here match keys built by the warehouse models (md5 of the parts joined by
# the separator, NULL parts replaced by the placeholder).
KEY_SEPARATOR = "-"
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex digest over the text form of ``cols``.

    NULL parts are replaced before concatenation (``concat_ws`` would drop them and
    shift the remaining parts). Integers and strings hash identically in Spark and
    in ANSI warehouses; doubles and timestamps have engine-specific text forms and
    should not be keyed on.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_PLACEHOLDER))
        for c in cols
    ]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
