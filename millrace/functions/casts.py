"""Forgiving casts: a text that does not fit its type becomes NULL, never an error.

They do not depend on the ANSI switch of the session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.contract import DATE_FORMAT, TIMESTAMP_FORMAT
from millrace.functions.text import clean, strip


def whole_number(text: Column, sql_type: str) -> Column:
    """Text to an integer type; a decimal fraction is cut off, so '1.5' gives 1.

    The plain cast settles nearly every row. The pattern only runs where that failed and
    the text holds a point.
    """
    head = F.regexp_extract(text, r"^([+-]?[0-9]+)[.][0-9]*$", 1)
    cut = F.when(F.contains(text, F.lit(".")), head.try_cast(sql_type))
    return F.coalesce(text.try_cast(sql_type), cut)


def typed(text: Column, sql_type: str) -> Column:
    """Clean a raw field and cast it to its contract type."""
    value = clean(text)
    if sql_type == "string":
        return value
    if sql_type == "date":
        return F.try_to_date(value, DATE_FORMAT)
    if sql_type == "timestamp":
        return F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT))
    if sql_type in ("int", "bigint"):
        return whole_number(value, sql_type)
    return value.try_cast(sql_type)


def strict_integer(text: Column) -> Column:
    """Stream rule: only an optional sign and digits make an integer; '1.5' gives NULL."""
    value = strip(text)
    return F.when(value.rlike(r"^[+-]?\d+$"), value.try_cast("bigint"))


def stream_double(text: Column) -> Column:
    """Stream rule for decimals. Type suffixes such as '1d' are not numbers there."""
    value = strip(text)
    return F.when(~value.rlike("[dDfF]$"), value.try_cast("double")).otherwise(
        F.when(value.rlike("(?i)^[+-]?inf$"), value.try_cast("double"))
    )
