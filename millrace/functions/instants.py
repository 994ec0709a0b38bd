"""Moments of the driver as literals of Spark, whatever the time zone of the machine."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def micros(moment: datetime) -> int:
    """Microseconds since the epoch; a datetime without zone is meant in UTC."""
    zoned = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    return (zoned - _EPOCH) // timedelta(microseconds=1)


def instant(moment: datetime | Column) -> Column:
    """The moment as a time stamp. As a number it never passes through local wall-clock time,
    which names one hour twice where daylight saving ends."""
    return moment if isinstance(moment, Column) else F.timestamp_micros(F.lit(micros(moment)))
