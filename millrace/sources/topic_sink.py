"""A sink for streams that writes topics as files, seen all at once or not at all.

Tasks stage files where no reader looks. The commit of a micro-batch gathers what its tasks staged
and renames one folder into its place; a batch that is there already is left as it is, so one that
is written again after a crash is published once. An abort leaves nothing that can be seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.sources.places import place

# readers pass over names that begin with an underscore
_STAGED = "_staged"
_MESSAGES = pa.schema([("key", pa.binary()), ("value", pa.binary())])


@dataclass
class Staged(WriterCommitMessage):
    """What one task wrote: a folder, and its files by topic."""

    folder: str
    topics: list[str]


class TopicWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"]
        self.run = options["run"]

    def _place(self) -> tuple[fs.FileSystem, str]:
        system, root = place(self.root)
        return system, root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Rows of ``topic, key, value`` to one file a topic, batch by batch."""
        system, root = self._place()
        folder = f"{root}/{_STAGED}/{uuid.uuid4().hex}"
        open_files: dict[str, tuple[pa.NativeFile, pq.ParquetWriter]] = {}
        try:
            for batch in iterator:
                names = batch.column("topic").cast(pa.string())
                rows = pa.table([batch.column(n).cast(pa.binary()) for n in _MESSAGES.names], schema=_MESSAGES)
                for topic in names.unique().to_pylist():
                    if topic not in open_files:
                        system.create_dir(folder, recursive=True)
                        target = system.open_output_stream(f"{folder}/{len(open_files)}.parquet")
                        open_files[topic] = target, pq.ParquetWriter(target, _MESSAGES, compression="zstd")
                    open_files[topic][1].write_table(rows.filter(pc.equal(names, topic)))
            for target, writer in open_files.values():
                writer.close()
                target.close()
        except BaseException:
            if system.get_file_info(folder).type != fs.FileType.NotFound:
                system.delete_dir(folder)
            raise
        return Staged(folder, list(open_files))

    def _drop(self, system: fs.FileSystem, messages: list[Staged | None]) -> None:
        for done in messages:
            if done is not None and system.get_file_info(done.folder).type == fs.FileType.Directory:
                system.delete_dir(done.folder)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        system, root = self._place()
        name = f"batch={self.run}-{batchId}"
        target, gathered = f"{root}/{name}", f"{root}/{_STAGED}/{name}"
        if system.get_file_info(target).type == fs.FileType.NotFound:
            # a commit that died half-way has left a part of this
            if system.get_file_info(gathered).type != fs.FileType.NotFound:
                system.delete_dir(gathered)
            system.create_dir(gathered, recursive=True)
            for done in messages:
                for n, topic in enumerate(done.topics if done is not None else []):
                    system.create_dir(f"{gathered}/topic={topic}", recursive=True)
                    system.move(f"{done.folder}/{n}.parquet", f"{gathered}/topic={topic}/{uuid.uuid4().hex}.parquet")
            system.move(gathered, target)
        self._drop(system, messages)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._drop(self._place()[0], messages)


class TopicSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_files"

    def schema(self) -> str:
        return "topic string, key binary, value binary"

    def streamWriter(self, schema: StructType, overwrite: bool) -> TopicWriter:
        return TopicWriter(dict(self.options))


def start_sink(
    routed: DataFrame, root: str, checkpoint: str, run: str, once: bool = True
) -> StreamingQuery:
    """Write a stream of ``topic, key, value``; ``run`` names its batches below ``root``.

    Topics are names without a slash. The same ``run`` with a new checkpoint publishes nothing twice
    as long as its batches are the same.
    """
    spark: SparkSession = routed.sparkSession
    spark.dataSource.register(TopicSink)
    writer = routed.select("topic", "key", "value").writeStream.format("topic_files")
    writer = writer.option("path", root).option("run", run).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
