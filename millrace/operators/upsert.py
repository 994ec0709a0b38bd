"""Row-level changes as pure functions over two frames: the target and a batch.

Both come in two parts, the target rows that stay and the batch rows that go in, so a
writer can leave the former where they are. A batch small enough to be broadcast (Spark
decides by its measured size) means that the target is only read, neither shuffled nor
sorted; a larger one is joined by sort-merge, with the target side split where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_parts(
    target: DataFrame, batch: DataFrame, key: str, recency: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Target rows kept and batch rows taken by a MERGE on ``key``.

    With ``recency`` a matched row is replaced only when the batch row is at least as
    recent; a NULL on either side leaves the target row alone and the batch row out.
    Without it the batch always wins. Rows without a key match nothing: they stay, or go
    in. The batch must hold one row per key, which the quality gate checks.
    """
    columns = target.columns
    rules = [key] if recency is None else [key, recency]
    incoming = batch.select(*[F.col(name).alias(f"_in_{name}") for name in rules])
    same_key = F.col(key) == F.col(f"_in_{key}")
    if recency is None:
        return target.join(incoming, same_key, "left_anti"), batch.select(*columns)
    replaces = F.col(f"_in_{recency}") >= F.col(recency)
    kept = target.join(incoming, same_key & replaces, "left_anti")
    # key and recency of the matched target rows, renamed for the mirror image
    held = target.join(incoming, same_key, "left_semi").select(
        *[F.col(name).alias(f"_held_{name}") for name in rules]
    )
    current = F.coalesce(F.col(recency) >= F.col(f"_held_{recency}"), F.lit(False))
    taken = batch.join(held, (F.col(key) == F.col(f"_held_{key}")) & ~current, "left_anti")
    return kept, taken.select(*columns)


def upsert(
    target: DataFrame, batch: DataFrame, key: str, recency: str | None = None
) -> DataFrame:
    """The target after a MERGE of ``batch``."""
    kept, taken = upsert_parts(target, batch, key, recency)
    return kept.unionByName(taken)


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Drop the target rows whose key is in the batch, then add the whole batch."""
    return upsert(target, batch, key)
