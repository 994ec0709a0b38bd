"""Topics: rows of ``key binary, value binary`` on a broker, or as folders of files.

As files, every write is one folder ``<root>/batch=<name>/topic=<topic>/`` that is replaced
as a whole, so a batch written again after a crash does not double anything.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.sources.archives import lines_of, newest_archive
from millrace.streaming.events import stream_events, to_messages

MESSAGE_SCHEMA = "key binary, value binary"
ORDERED_SCHEMA = f"{MESSAGE_SCHEMA}, position bigint"

_MARKS = "topic string, key binary, next bigint"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_ROWS = 4096

# acknowledged by all replicas and free of duplicates on retry, like any safe producer
_BROKER_SINK = {"kafka.enable.idempotence": "true", "kafka.acks": "all", "kafka.linger.ms": "50"}


def publish(
    messages: DataFrame,
    root: str,
    batch: str,
    broker: Mapping[str, str] | None = None,
) -> int:
    """Write messages with a ``topic`` column in one job, however many topics there are.

    Messages with a ``position`` are written in its order: every file holds a stretch of keys, or of
    one key that is too large for a task. A broker keeps no such column. Returns their number, counted while they are written.
    """
    sent = Observation(f"publish-{uuid.uuid4().hex}")
    ordered = "position" in messages.columns and broker is None
    rows = messages.select("topic", "key", "value", *["position"] * ordered).observe(
        sent, F.count(F.lit(1)).alias("messages")
    )
    if ordered:
        sequence = ("topic", "key", "position")
        rows = rows.repartitionByRange(*sequence).sortWithinPartitions(*sequence)
    if broker is not None:
        rows.write.format("kafka").options(**_BROKER_SINK, **broker).save()
    else:
        # static: a topic that an earlier attempt had and this one has not goes with it
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("topic").parquet(f"{root}/batch={batch}")
    if ordered:
        # a row for each key of the batch, read from what was written; a batch that dies before this comes again
        spark = messages.sparkSession
        written = spark.read.schema(f"{ORDERED_SCHEMA}, topic string").parquet(f"{root}/batch={batch}")
        marks = written.groupBy("topic", "key").agg((F.max("position") + 1).alias("next"))
        marks.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/_marks/batch={batch}")
    return int(sent.get["messages"])


def _folder(root: str, topic: str) -> str:
    return f"{root}/batch=*/topic={topic}"


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All messages of a file topic."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(_folder(root, topic))


def read_in_order(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All messages of a topic with positions, each key in the order of its publishing."""
    read = spark.read.schema(ORDERED_SCHEMA).parquet(_folder(root, topic))
    return read.orderBy("key", "position")


def next_positions(spark: SparkSession, root: str, topic: str, batch: str) -> DataFrame:
    """``key, next``: where each key goes on in ``batch``, from the marks of the batches so far.

    What an earlier attempt at that batch left does not count, so it gets the same positions again.
    """
    marks = spark.read.schema(f"{_MARKS}, batch string").option("basePath", f"{root}/_marks")
    others = marks.parquet(f"{root}/_marks/batch=*").filter(
        (F.col("batch") != batch) & (F.col("topic") == topic)
    )
    return others.groupBy("key").agg(F.max("next").alias("next"))


def _messages_of(path: str, content: pa.Buffer) -> Iterator[pa.RecordBatch]:
    """The messages of a file, or one row that names it: a file counts as a whole."""
    wanted = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("fault", pa.string())])
    try:
        file = pq.ParquetFile(pa.BufferReader(content))
        for rows in file.iter_batches(_ROWS, columns=["key", "value"]):
            rows.validate(full=True)
    except (pa.ArrowException, OSError, KeyError) as problem:
        row = {"key": [path.encode()], "value": [b""], "fault": [f"{type(problem).__name__}: {problem}"]}
        yield pa.RecordBatch.from_pydict(row, schema=wanted)
        return
    for rows in file.iter_batches(_ROWS, columns=["key", "value"]):
        columns = [rows.column(name).cast(pa.binary()) for name in ("key", "value")]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(rows.num_rows, pa.string())], schema=wanted)


def _messages_of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield from _messages_of(path.as_py(), content.as_buffer())


def stream_topic(
    spark: SparkSession,
    root: str,
    topic: str,
    max_files: int | None = None,
    broker: Mapping[str, str] | None = None,
    set_aside: bool = False,
) -> DataFrame:
    """The topic as a stream from its beginning; where to resume is in the checkpoint.

    Data that is gone or damaged stops the stream: nothing is passed over without a trace. With
    ``set_aside`` a damaged file becomes one row instead, with its path as ``key`` and what is wrong
    as ``fault``, and the others go on; the gate sends such rows to a topic of their own. A file is
    read to its end before its first message is passed on, so one that breaks off half-way gives none.
    """
    if broker is not None:
        options = {"subscribe": topic, "startingOffsets": "earliest"}
        reader = spark.readStream.format("kafka").options(**{**options, **broker})
        return reader.load().select("key", "value")
    reader = spark.readStream.schema(_FILES if set_aside else MESSAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if set_aside:
        files = reader.format("binaryFile").option("pathGlobFilter", "*.parquet").load(_folder(root, topic))
        return files.select("path", "content").mapInArrow(_messages_of_files, f"{MESSAGE_SCHEMA}, fault string")
    return reader.parquet(_folder(root, topic)).select("key", "value")


def publish_newest(
    files: DataFrame, root: str, batch: str, topic: str, broker: Mapping[str, str] | None = None
) -> int:
    """Send the events of the newest archive, one message per line."""
    lines = lines_of(newest_archive(files))
    messages = to_messages(stream_events(lines)).withColumn("topic", F.lit(topic))
    return publish(messages, root, batch, broker)
