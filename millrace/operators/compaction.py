"""Small-file compaction of a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import location_of, overwrite_partitions, within


def partition_files(spark: SparkSession, location: str, partition: str) -> DataFrame:
    """Files and bytes per partition, from file metadata alone: no row is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(location)
        .select(partition, "length")
    )
    return files.groupBy(partition).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("byte_count")
    )


def fragmented(files: DataFrame, min_files: int, target_bytes: int) -> DataFrame:
    """Partitions with at least ``min_files`` files and more than their bytes call for."""
    wanted = F.greatest(F.lit(1), F.ceil(F.col("byte_count") / F.lit(target_bytes)))
    return files.filter(
        (F.col("file_count") >= min_files) & (F.col("file_count") > wanted)
    )


def compact(
    spark: SparkSession,
    table: str,
    partition: str,
    min_files: int = 2,
    target_bytes: int = 128 * 1024 * 1024,
) -> list[object]:
    """Rewrite fragmented partitions into files of about ``target_bytes``; returns them.

    Rows of a partition are dealt over as many tasks as its bytes on disk call for, so one that
    holds a third of the table is written by many tasks, and afterwards it has no more files than
    the rule asks for: a second run finds nothing to do.
    """
    found = fragmented(
        partition_files(spark, location_of(spark, table), partition), min_files, target_bytes
    )
    wanted = {row[partition]: max(1, row["byte_count"] // target_bytes) for row in found.collect()}
    if wanted:
        rows = spark.table(table).filter(within(partition, list(wanted)))
        kind = rows.schema[partition].dataType.simpleString()
        # one row for each partition that is rewritten, as many as their values in the filter
        files = spark.createDataFrame(list(wanted.items()), f"_day {kind}, _files long")
        counted = rows.join(F.broadcast(files), F.col(partition).eqNullSafe(F.col("_day")))
        dealt = counted.withColumn("_file", F.pmod(F.xxhash64(*rows.columns), F.col("_files"))).drop("_day", "_files")
        overwrite_partitions(dealt.repartition(sum(wanted.values()), partition, "_file"), table)
    return list(wanted)
