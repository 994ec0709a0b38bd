"""Order per key: each message gets its place among those of its key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# a NULL key is a key like any other
_KEY = ("_none", "_key")


def _keyed(messages: DataFrame) -> DataFrame:
    held = F.coalesce("key", F.lit(b""))
    return messages.withColumn("_none", F.col("key").isNull()).withColumn("_key", held)


def sequenced(
    messages: DataFrame, run: str, order: list[str], after: DataFrame | None = None
) -> DataFrame:
    """Messages with ``position``, counted from 0 within their ``key`` by ``run``, then ``order``.

    ``run`` names a column that cuts time into slices of bounded size, such as the file of a feed.
    Where a run of a key begins is the running sum of counts, one row per key and run; only a run of
    a key is numbered by one task, so a key that holds a third of all messages is spread over its
    runs. ``after (key, next)`` tells where keys go on that were published before. Messages equal in
    ``run`` and ``order`` take any order among themselves; a NULL run comes first.
    """
    keyed = _keyed(messages)
    sizes = keyed.groupBy(*_KEY, run).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*_KEY).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.withColumn("_begin", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if after is not None:
        begins = begins.join(_keyed(after).select(*_KEY, "next"), list(_KEY), "left")
        begins = begins.withColumn("_begin", F.col("_begin") + F.coalesce("next", F.lit(0)))
    begins = begins.select(*_KEY, F.struct(run).alias("_run"), "_begin")
    joined = keyed.withColumn("_run", F.struct(run)).join(begins, [*_KEY, "_run"])
    within = Window.partitionBy(*_KEY, "_run").orderBy(*order)
    position = (F.col("_begin") + F.row_number().over(within) - 1).alias("position")
    return joined.select(*messages.columns, position)
