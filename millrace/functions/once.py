"""Keep a costly expression from being worked out several times per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with new columns that later filters refer to instead of repeating them.

    A filter on a computed column is pushed below it by putting the whole expression into
    the filter, once per mention, and a filter shares nothing between its parts. Parsing a
    line then costs a multiple. A filter does not pass a generator, so the columns come out
    of a one-element list.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
