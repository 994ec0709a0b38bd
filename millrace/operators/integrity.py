"""Tests on finished tables. Each returns the failing values with their row counts, so an
empty frame means the test passed.

All of them reduce to one row per distinct value before anything is shuffled or joined; a
value that holds a third of the table crosses the network once per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _value_counts(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    counts = _value_counts(df, column, F.col(column).isNotNull())
    return counts.filter(F.col("row_count") > 1)


def nulls(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of NULLs, or none."""
    return df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("row_count")).filter(
        F.col("row_count") > 0
    )


def unaccepted(df: DataFrame, column: str, accepted: Iterable[object]) -> DataFrame:
    """Values outside the accepted ones; NULL passes."""
    return _value_counts(df, column).filter(~F.col("value").isin(*accepted))


def orphans(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    where: Column | None = None,
) -> DataFrame:
    """Child values that the parent lacks. NULL refers to nothing and passes.

    The child is reduced to its distinct values first, so neither side is skewed in the
    anti-join; Spark broadcasts the parent only when its measured size allows.
    """
    present = F.col(column).isNotNull()
    counts = _value_counts(child, column, present if where is None else present & where)
    known = parent.select(F.col(parent_column).alias("value"))
    return counts.join(known, "value", "left_anti")
