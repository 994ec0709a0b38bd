"""Zipped text files as a Spark data source: ``spark.read`` and ``spark.readStream`` with format ``archives``.

The driver lists names and sizes only. Archives are packed into input partitions by size. Tasks read
an archive as a stream of blocks; neither the archive nor what is in it is ever held whole.

Options: ``path`` (a folder, searched with all below) or ``files`` (JSON list of paths); ``suffix``, a
case-sensitive pattern of names; ``first`` and ``last``, names that bound a window of names, both
included; ``partitionBytes``; ``content``: ``lines`` (default) or ``checks``, which reads archives to the
end and gives their digest and whether they can be unpacked. Names are decided on the listing, so an
archive outside the window is not opened. The window is an option and not a pushed filter because Spark
4.1 keeps the filters of a Python source with the relation: a second query on the same frame would run
with the filters of the first.
"""

from __future__ import annotations

import fnmatch
import hashlib
import io
import json
import time
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from millrace.functions.text import is_blank
from millrace.sources.archives import ARCHIVE_SUFFIX
from millrace.sources.places import place

LINES = "_raw_line string, _source_file string"
CHECKS = "path string, _source_file string, digest string, readable boolean"
_BLOCK = 4 << 20
# opening a file costs about as much as reading so many bytes
_OPENING = 4 << 20
_BROKEN = (zipfile.BadZipFile, EOFError, zlib.error, NotImplementedError, RuntimeError)


# ---- one archive -----------------------------------------------------------------------------


class _Seekable(io.RawIOBase):
    """An open file as the archive reader wants it: a place before the beginning is an ``OSError``."""

    def __init__(self, source: pa.NativeFile) -> None:
        self._source, self._size = source, source.size()

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._source.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self._source.tell(), io.SEEK_END: self._size}[whence]
        if start + offset < 0:
            raise OSError("before the beginning of the file")
        return self._source.seek(start + offset)

    def read(self, size: int | None = -1) -> bytes:
        return self._source.read(None if size is None or size < 0 else size)


def member_blocks(path: str, size: int = _BLOCK) -> Iterator[bytes]:
    """The first member in blocks as they are unpacked; its checksum is tested at the end."""
    system, name = place(path)
    with system.open_input_file(name) as source, zipfile.ZipFile(_Seekable(source)) as container:
        members = container.namelist()
        if members:
            with container.open(members[0]) as member:
                while block := member.read(size):
                    yield block


def whole_lines(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """Blocks cut at line ends; only an unfinished line is carried on."""
    rest: list[bytes] = []
    for block in blocks:
        cut = block.rfind(b"\n")
        if cut < 0:
            rest.append(block)
            continue
        yield b"".join([*rest, block[:cut]])
        rest = [block[cut + 1 :]]
    if any(rest):
        yield b"".join(rest)


def check(path: str) -> tuple[str | None, bool]:
    """md5 of an archive, and whether its first member unpacks to the end with the right checksum.

    A missing file has no digest.
    """
    system, name = place(path)
    digest = hashlib.md5()
    try:
        with system.open_input_stream(name) as source:
            while block := source.read(_BLOCK):
                digest.update(block)
    except FileNotFoundError:
        return None, False
    try:
        for _ in member_blocks(path):
            pass
    except _BROKEN:
        return digest.hexdigest(), False
    return digest.hexdigest(), True


# ---- listing and packing ---------------------------------------------------------------------


@dataclass(frozen=True)
class Found:
    path: str
    name: str
    size: int
    changed: int  # nanoseconds


@dataclass
class Archives(InputPartition):
    paths: list[str]


def listed(options: dict[str, str]) -> list[Found]:
    """The archives that the options name, in order of their paths."""
    if "files" in options:
        out = []
        for path in json.loads(options["files"]):
            system, name = place(path)
            info = system.get_file_info(name)
            out.append(Found(path, path.rsplit("/", 1)[-1], info.size or 0, info.mtime_ns or 0))
        return out
    root = options["path"]
    system, folder = place(root)
    if system.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    found = system.get_file_info(fs.FileSelector(folder, recursive=True))
    suffix = options.get("suffix", ARCHIVE_SUFFIX)
    first, last = options.get("first"), options.get("last")
    prefix = root[: len(root.rstrip("/")) - len(folder.rstrip("/"))] if root.rstrip("/").endswith(folder.rstrip("/")) else ""
    return sorted(
        (
            Found(prefix + i.path, i.base_name, i.size, i.mtime_ns or 0)
            for i in found
            if i.type == fs.FileType.File
            and fnmatch.fnmatchcase(i.base_name, suffix)
            and (first is None or i.base_name >= first)
            and (last is None or i.base_name <= last)
        ),
        key=lambda f: f.path,
    )


def packed(found: Iterable[Found], most: int) -> list[Archives]:
    """Neighbouring archives together up to ``most`` bytes; a larger one is alone."""
    parts: list[Archives] = []
    room = 0
    for f in found:
        cost = f.size + _OPENING
        if not parts or cost > room:
            parts.append(Archives([]))
            room = max(most, cost)
        parts[-1].paths.append(f.path)
        room -= cost
    return parts


def _partitions(found: list[Found], options: dict[str, str]) -> list[Archives]:
    """At least one, since Spark reads a source without partitions as one that has no plan."""
    return packed(found, int(options.get("partitionBytes", 128 << 20))) or [Archives([])]


def _read(partition: Archives, content: str) -> Iterator[pa.RecordBatch]:
    for path in partition.paths:
        name = path.rsplit("/", 1)[-1]
        if content == "checks":
            digest, readable = check(path)
            columns = [pa.array([path]), pa.array([name]), pa.array([digest], pa.string()), pa.array([readable])]
            yield pa.RecordBatch.from_arrays(columns, ["path", "_source_file", "digest", "readable"])
            continue
        for block in whole_lines(member_blocks(path)):
            text = pa.array([block.decode("utf-8", errors="replace")], pa.large_string())
            lines = pc.split_pattern(text, "\n").flatten().cast(pa.string())
            yield pa.RecordBatch.from_arrays([lines, pa.repeat(name, len(lines)).cast(pa.string())], ["_raw_line", "_source_file"])


# ---- the source ------------------------------------------------------------------------------


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Archives]:
        return _partitions(listed(self.options), self.options)

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.options.get("content", "lines"))


class ArchiveStreamReader(DataSourceStreamReader):
    """Archives in order of their time of change, then path; the offset is the last one taken.

    A file counts once ``settle`` seconds (default 2) have passed since its last change, so none of
    the same moment can come after the offset has moved on. What lies between two offsets is found
    again by listing; an archive that is deleted before its batch is committed is an error.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return {"changed": 0, "path": ""}

    def latestOffset(self) -> dict:
        limit = time.time_ns() - int(float(self.options.get("settle", 2)) * 1e9)
        ready = [(f.changed, f.path) for f in listed(self.options) if f.changed <= limit]
        changed, path = max(ready, default=(0, ""))
        return {"changed": changed, "path": path}

    def partitions(self, start: dict, end: dict) -> list[Archives]:
        low, high = ((o["changed"], o["path"]) for o in (start, end))
        found = [f for f in listed(self.options) if low < (f.changed, f.path) <= high]
        return _partitions(found, self.options)

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        return _read(partition, "lines")

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the checkpoint."""


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return CHECKS if self.options.get("content", "lines") == "checks" else LINES

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(dict(self.options))

    def streamReader(self, schema: StructType) -> ArchiveStreamReader:
        return ArchiveStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session; running it again changes nothing."""
    spark.dataSource.register(ArchiveSource)


def _trimmed(lines: DataFrame) -> DataFrame:
    text = F.rtrim("_raw_line", F.lit("\r"))
    return lines.filter(~is_blank(F.col("_raw_line"))).withColumn("_raw_line", text)


def scan(
    spark: SparkSession, root: str, first: str | None = None, last: str | None = None, suffix: str = ARCHIVE_SUFFIX
) -> DataFrame:
    """``_raw_line, _source_file`` of the archives below ``root``, blank lines left out.

    ``first`` and ``last`` bound the names, which makes dated names a window of time. A damaged archive
    is an error if it is opened. No archive at all gives no lines.
    """
    register(spark)
    bounds = {k: v for k, v in (("first", first), ("last", last)) if v is not None}
    return _trimmed(spark.read.format("archives").options(suffix=suffix, **bounds).load(root))


def scan_stream(spark: SparkSession, root: str, suffix: str = ARCHIVE_SUFFIX, settle: float = 2) -> DataFrame:
    """The same as a stream: each archive once, in order of arrival."""
    register(spark)
    reader = spark.readStream.format("archives").option("suffix", suffix).option("settle", str(settle))
    return _trimmed(reader.load(root))


def lines_of_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of the named archives; the caller keeps the list small."""
    register(spark)
    return _trimmed(spark.read.format("archives").option("files", json.dumps(paths)).load())


def examine(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, _source_file, digest, readable`` of the named archives, each read to its end."""
    register(spark)
    reader = spark.read.format("archives").option("content", "checks")
    return reader.option("files", json.dumps(paths)).load()


# ---- the sink --------------------------------------------------------------------------------


class _Digesting:
    """A stream that knows the md5 and the length of what went through it."""

    def __init__(self, out: pa.NativeFile) -> None:
        self._out, self._digest, self.size = out, hashlib.md5(), 0

    def write(self, data: bytes) -> int:
        self._out.write(data)
        self._digest.update(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        self._out.flush()

    def hexdigest(self) -> str:
        return self._digest.hexdigest()


WRITTEN = "_source_file string, size long, digest string"


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """One archive for each ``_source_file`` of ``rows (_source_file, member, line binary)``.

    Members in order of their names, each a text of the lines that carry its name; a row without
    member makes sure that there is an archive, and adds nothing to it. Lazily gives ``_source_file,
    size, digest`` of each archive. It is streamed to a name of its own and moved to its place when
    complete, so nobody sees a part of one and a task may run twice.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        system.create_dir(root, recursive=True)
        name = member = None
        out = container = entry = None

        def finish() -> pa.RecordBatch:
            if entry is not None:
                entry.close()
            container.close()
            out._out.close()
            system.move(f"{root}/.{name}.part", f"{root}/{name}")
            columns = [pa.array([name]), pa.array([out.size]), pa.array([out.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["_source_file", "size", "digest"])

        for batch in batches:
            for n, m, line in zip(*(batch.column(c).to_pylist() for c in ("_source_file", "member", "line"))):
                if n != name:
                    if name is not None:
                        yield finish()
                    name, member, entry = n, None, None
                    out = _Digesting(system.open_output_stream(f"{root}/.{n}.part"))
                    container = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                if m is None:
                    continue
                if m != member:
                    if entry is not None:
                        entry.close()
                    member = m
                    info = zipfile.ZipInfo(m)
                    info.compress_type = zipfile.ZIP_DEFLATED
                    entry = container.open(info, "w", force_zip64=True)
                entry.write((line or b"") + b"\n")
        if name is not None:
            yield finish()

    ordered = rows.repartition("_source_file").sortWithinPartitions("_source_file", F.asc_nulls_first("member"))
    return ordered.select("_source_file", "member", "line").mapInArrow(written, WRITTEN)
