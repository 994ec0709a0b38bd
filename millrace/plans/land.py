"""Landing: index entries and files to the bronze lines table."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import base_name
from millrace.sources.archive_source import examine, lines_of_files
from millrace.sources.archives import ANY_ARCHIVE, archive_files
from millrace.sources.manifest import STATE_SCHEMA, advance_state, feed_of, not_landed, stamp_of
from millrace.sources.tables import add_columns, balanced, create_table, within

LANDED_DDL = "file_name string, file_ts timestamp, feed string"
FAILED_DDL = "path string, length bigint, changed timestamp, md5 string"
LINES_DDL = "_raw_line string, _source_file string, feed string, dt date, hour int"


def land(
    spark: SparkSession,
    manifest: DataFrame,
    drop: str,
    lines_table: str,
    state_table: str,
    suffix: str = ANY_ARCHIVE,
    chunk: int = 10_000,
) -> dict[str, int]:
    """Check the files in ``drop`` against the manifest and land the new ones as lines.

    Names are compared on the listing alone; only files that are wanted are opened, at
    most ``chunk`` of them in a step. A file with a wrong checksum, or a name that is in ``drop``
    twice, fails alone; it is remembered by path, size, time of change and wanted checksum and
    not opened again until one of them changes. The list of landed files is what makes a re-run skip, so a file is recorded
    last. Returns how many files were landed, skipped and failed.
    """
    create_table(spark, lines_table, LINES_DDL, "feed, dt, hour")
    create_table(spark, f"{lines_table}_files", LANDED_DDL, "feed")
    create_table(spark, f"{lines_table}_failed", FAILED_DDL)
    if "md5" not in spark.table(f"{lines_table}_failed").columns:
        add_columns(spark, f"{lines_table}_failed", "md5 string")
    create_table(spark, state_table, STATE_SCHEMA)
    landed = spark.table(f"{lines_table}_files")
    missing = not_landed(manifest, landed).select("feed", "file_name", "file_ts", "md5").distinct()
    counts = {
        "landed": 0,
        "skipped": manifest.select("feed", "file_name").distinct().count(),
        "failed": missing.count(),
    }
    counts["skipped"] -= counts["failed"]
    listing = archive_files(spark, drop, suffix).select(
        base_name(F.col("path")).alias("file_name"),
        "path",
        "length",
        F.col("modificationTime").alias("changed"),
    )
    once = listing.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
    wanted = missing.join(listing.join(once, "file_name", "left_semi"), "file_name")
    wanted = wanted.join(spark.table(f"{lines_table}_failed"), ["path", "length", "changed", "md5"], "left_anti")
    for files in _chunks(wanted.orderBy("file_name").toLocalIterator(), chunk):
        counts["landed"] += _land_chunk(spark, files, lines_table, state_table)
    counts["failed"] -= counts["landed"]
    return counts


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    while part := list(islice(rows, size)):
        yield part


def _land_chunk(spark: SparkSession, files: list[Row], lines_table: str, state_table: str) -> int:
    """Lines of one chunk of files, then its failures, the marks and the list of landed files.

    Two passes: the first reads every archive to its end for its digest and the checksum of its
    member, the second emits the lines of those that passed. Both are streams; nothing of an
    archive is kept in between, and no line of a bad one is ever seen.
    """
    found = {r["path"]: r for r in examine(spark, [f["path"] for f in files]).collect()}
    good, bad = [], []
    for f in files:
        seen = found[f["path"]]
        passed = seen["readable"] and f["md5"] in ("", seen["digest"])
        (good if passed else bad).append(f)
    if bad:
        rows = [(f["path"], f["length"], f["changed"], f["md5"]) for f in bad]
        spark.createDataFrame(rows, FAILED_DDL).write.mode("append").insertInto(f"{lines_table}_failed")
    if not good:
        return 0
    new = spark.createDataFrame([(f["file_name"], f["file_ts"], f["feed"]) for f in good], LANDED_DDL)
    name = F.col("_source_file")
    lines = lines_of_files(spark, [f["path"] for f in good]).select(
        "_raw_line",
        "_source_file",
        feed_of(name).alias("feed"),
        F.to_date(stamp_of(name)).alias("dt"),
        F.hour(stamp_of(name)).alias("hour"),
    )
    # lines that are there already come from a run that died before recording their file
    days = [r[0] for r in new.select(F.to_date(stamp_of(F.col("file_name")))).distinct().collect()]
    held = spark.table(lines_table).filter(within("dt", days)).select("_source_file").distinct()
    columns = spark.table(lines_table).columns
    fresh = lines.join(held, "_source_file", "left_anti").select(*columns)
    balanced(fresh, "dt").write.mode("append").insertInto(lines_table)
    # one row per feed, read before its own table is overwritten
    state = advance_state(spark.table(state_table), new).collect()
    spark.createDataFrame(state, STATE_SCHEMA).write.insertInto(state_table, overwrite=True)
    recorded = spark.table(f"{lines_table}_files").columns
    new.select(*recorded).write.mode("append").insertInto(f"{lines_table}_files")
    return len(good)
