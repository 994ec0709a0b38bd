"""Upkeep of the silver table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.contract import EVENTS
from millrace.operators.compaction import compact
from millrace.sources.tables import ROW_LEVEL_FORMATS, provider_of


def maintain_silver(
    spark: SparkSession, table: str, min_files: int = 2, partition: str = EVENTS.day
) -> list[object]:
    """Compact partitions with too many files; returns the rewritten ones.

    A table format with its own maintenance is left to it.
    """
    if provider_of(spark, table) in ROW_LEVEL_FORMATS:
        raise ValueError(f"{table} has maintenance procedures of its own")
    return compact(spark, table, partition, min_files)
