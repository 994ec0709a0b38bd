"""Zipped, header-less text files to lines.

Python only opens the archive and hands on blocks of text; cutting the block into lines
is done by Arrow, everything after that by Spark.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import base_name, is_blank

# event archives; other feeds are published with other spellings of the suffix
ARCHIVE_SUFFIX = "*.CSV.zip"
ANY_ARCHIVE = "*.[zZ][iI][pP]"
_BLOCK_BYTES = 4 * 1024 * 1024


def text_blocks(archive: bytes) -> Iterator[bytes]:
    """The first member in blocks that end at a line end, without holding all of it."""
    with zipfile.ZipFile(io.BytesIO(archive)) as container:
        members = container.namelist()
        if not members:
            return
        with container.open(members[0]) as member:
            rest = []
            while block := member.read(_BLOCK_BYTES):
                cut = block.rfind(b"\n")
                if cut < 0:
                    rest.append(block)
                    continue
                yield b"".join([*rest, block[:cut]])
                rest = [block[cut + 1 :]]
            if any(rest):
                yield b"".join(rest)


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, archives = batch.column("_source_file"), batch.column("content")
        for name, archive in zip(names, archives, strict=True):
            for block in text_blocks(archive.as_py()):
                text = pa.array([block.decode("utf-8", errors="replace")], pa.large_string())
                lines = pc.split_pattern(text, "\n").flatten().cast(pa.string())
                source = pa.repeat(name, len(lines))
                yield pa.RecordBatch.from_arrays([lines, source], ["_raw_line", "_source_file"])


def archive_files(spark: SparkSession, root: str | list[str], suffix: str = ARCHIVE_SUFFIX) -> DataFrame:
    """Archives below a folder as ``path, length, content`` plus its partition columns.

    The suffix is case-sensitive. With a ``dt=/hour=`` layout the columns ``dt`` and
    ``hour`` appear, and a filter on them prunes the listing.
    """
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(root)
    )


def named_between(files: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Archives whose names lie between two names, both included; none without bounds.

    Decided from the listing: a file outside is not opened, which a filter on a column of
    the file could not do. Dated names make this a window of time.
    """
    if first is None or last is None:
        return files.filter(F.lit(False))
    return files.filter(F.col("_metadata.file_name").between(first, last))


def newest_archive(files: DataFrame) -> DataFrame:
    """The archive with the greatest path; dated names and folders sort by time.

    The path is one value worked out from the listing, and only that file is opened.
    """
    path = files.agg(F.max("path")).first()[0]
    name = path.rsplit("/", 1)[-1] if path else None
    return named_between(files, name, name).filter(F.col("path") == F.lit(path))


def lines_of(files: DataFrame) -> DataFrame:
    """Archive files to ``_raw_line, _source_file``, blank lines left out.

    An archive cannot be split, but it is read as a stream of blocks, so a large one costs
    time and not memory. Many small ones share a task by the usual packing of files.
    """
    named = files.select(base_name(F.col("path")).alias("_source_file"), "content")
    lines = named.mapInArrow(_unzip, "_raw_line string, _source_file string")
    return lines.select(
        F.rtrim("_raw_line", F.lit("\r")).alias("_raw_line"), "_source_file"
    ).filter(~is_blank(F.col("_raw_line")))


def read_archives(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Lines of every archive below ``root``, or of one ``dt=`` partition of it."""
    files = archive_files(spark, root)
    if day is not None:
        # a folder without any archive has no partition columns either
        landed = F.col("dt") == F.lit(day).cast("date") if "dt" in files.columns else F.lit(False)
        files = files.filter(landed)
    return lines_of(files)
