"""Keys and calendar expressions shared by fact and dimensions.

Both sides call the same function, so a fact row finds its dimension row without a
lookup join while loading.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(value: Column) -> Column:
    """Surrogate key of one natural key; NULL stays NULL."""
    return F.md5(value.cast("string"))


def day_key(day: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_label(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def weekday_number(day: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(day) - 1


def place_key(feature_id: Column, fullname: Column) -> Column:
    """Natural key of a place: its feature id, or its full name where there is none."""
    return F.coalesce(feature_id, fullname)
