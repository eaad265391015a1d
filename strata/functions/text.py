"""String functions: regex capture and delimiter explode."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR_IN_PARENS = r"\(([0-9]{4})\)"


def extract_year(title: str | Column, pattern: str = YEAR_IN_PARENS) -> Column:
    """First capture of ``pattern`` in ``title``; NULL when there is no match.

    ``regexp_extract`` returns '' on a miss, so the miss is mapped back to NULL.
    """
    c = F.col(title) if isinstance(title, str) else title
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def explode_delimited(
    df: DataFrame,
    column: str,
    delimiter: str,
    out: str,
    keep: list[str] | tuple[str, ...] = (),
    trim: bool = True,
) -> DataFrame:
    """One row per piece of ``column`` split on a literal ``delimiter``.

    Inner-lateral semantics: a NULL input gives no row, '' gives one empty piece,
    empty pieces between or after delimiters are kept. ``trim`` strips spaces only.
    The split is a narrow (per-row) operation: no shuffle.
    """
    pieces = F.split(F.col(column), re.escape(delimiter), -1)
    value = F.explode(pieces)
    exploded = df.select(*keep, value.alias(out))
    if trim:
        exploded = exploded.withColumn(out, F.trim(F.col(out)))
    return exploded
