"""The published index of feed files, and what happens to each file on landing."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.contract import TIMESTAMP_FORMAT
from millrace.functions.once import evaluate_once
from millrace.functions.instants import instant
from millrace.functions.text import base_name, words

# --- fixed values: what a file name in the index looks like ---
FILE_PATTERN = r"(?i)([0-9]{14})\.(export|mentions|gkg)\."

STATE_SCHEMA = "feed string, ts timestamp"


def stamp_of(name: Column) -> Column:
    """Time stamp in a file name or address; NULL where there is none or it is no time."""
    return F.try_to_timestamp(F.regexp_extract(name, FILE_PATTERN, 1), F.lit(TIMESTAMP_FORMAT))


def feed_of(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, FILE_PATTERN, 2))


def parse_index(lines: DataFrame, column: str = "value") -> DataFrame:
    """Index lines ``<size> <md5> <address>`` to a typed manifest.

    A line without exactly three parts, without a dated feed name, with a size that is no
    number or with an impossible date is left out; the others stay.
    """
    split = evaluate_once(lines, _parts=words(F.col(column))).filter(F.size("_parts") == 3)
    url = F.get("_parts", F.lit(2))
    entries = evaluate_once(
        split,
        url=url,
        size=F.get("_parts", F.lit(0)).try_cast("bigint"),
        md5=F.get("_parts", F.lit(1)),
        file_ts=stamp_of(url),
        feed=feed_of(url),
        file_name=base_name(url),
    )
    return (
        entries.filter(F.col("size").isNotNull() & F.col("file_ts").isNotNull())
        .select("url", "size", "md5", "file_ts", "feed", "file_name")
        .withColumn("dt", F.to_date("file_ts"))
        .withColumn("hour", F.hour("file_ts"))
    )


def of_feeds(manifest: DataFrame, feeds: Iterable[str]) -> DataFrame:
    return manifest.filter(F.col("feed").isin(*feeds))


def in_window(manifest: DataFrame, start: datetime | Column, end: datetime | Column) -> DataFrame:
    """Files from ``start`` on and before ``end``."""
    moment = F.col("file_ts")
    return manifest.filter((moment >= instant(start)) & (moment < instant(end)))


def oldest_first(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("file_ts", "file_name")


def not_landed(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Files of the manifest that were not landed before."""
    return manifest.join(landed.select("feed", "file_name"), ["feed", "file_name"], "left_anti")


def checksums(files: DataFrame) -> DataFrame:
    """Name and md5 of each file; the content itself is not shuffled."""
    return files.select(
        base_name(F.col("path")).alias("file_name"), F.md5("content").alias("digest")
    )


def verify(manifest: DataFrame, digests: DataFrame, landed: DataFrame) -> DataFrame:
    """The manifest with a status per file: ``skipped``, ``landed`` or ``failed``.

    A file fails alone when it is missing or its checksum differs; an index line without a
    checksum is not checked.
    """
    known = landed.select("feed", "file_name").distinct().withColumn("_known", F.lit(True))
    status = (
        F.when(F.col("_known"), "skipped")
        .when(F.col("digest").isNull(), "failed")
        .when((F.col("md5") == "") | (F.col("md5") == F.col("digest")), "landed")
        .otherwise("failed")
    )
    return (
        manifest.join(known, ["feed", "file_name"], "left")
        .join(digests, "file_name", "left")
        .select(*manifest.columns, status.alias("status"))
    )


def tally(outcome: DataFrame) -> DataFrame:
    """One row: how many files were landed, skipped and failed."""
    return outcome.agg(
        *[
            F.count_if(F.col("status") == status).alias(status)
            for status in ("landed", "skipped", "failed")
        ]
    )


def advance_state(state: DataFrame, landed: DataFrame) -> DataFrame:
    """Newest landed file per feed; a feed never moves back."""
    newest = landed.groupBy("feed").agg(F.max("file_ts").alias("ts"))
    return (
        state.select("feed", "ts")
        .unionByName(newest)
        .groupBy("feed")
        .agg(F.max("ts").alias("ts"))
    )


def newest_batch(files: DataFrame, path: str = "path") -> DataFrame:
    """The rows of the file with the greatest path; dated names sort by time.

    The path is found by a scalar subquery, so it becomes a plain filter on the scan.
    """
    return files.filter(F.col(path) == files.agg(F.max(path)).scalar())
