"""The running gate: stream in, dead letters, alerts and counters out."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.topics import publish
from millrace.streaming.gate import gate, gate_counts, routed

STATS_SCHEMA = "batch_id bigint, consumed bigint, valid bigint, dead_lettered bigint, alerts bigint"


class Limit:
    """How many messages a run takes: none begins a batch once ``most`` are consumed."""

    def __init__(self, most: int | None = None) -> None:
        self.most, self.consumed, self.turned_away = most, 0, False

    def reached(self) -> bool:
        return self.most is not None and self.consumed >= self.most


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of what one checkpoint writes: that of the streaming query it belongs to."""
    lines = spark.read.text(f"{checkpoint}/metadata")
    return lines.select(F.get_json_object("value", "$.id")).first()[0]


def start_gate(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    once: bool = True,
    broker: Mapping[str, str] | None = None,
    limit: Limit | None = None,
) -> StreamingQuery:
    """Gate a stream of messages.

    Each micro-batch is one pass without a shuffle: routed messages are written by one job,
    the counters are observed while it runs. Files of a batch carry the id of the run, kept in the
    checkpoint, and its number. They replace an earlier attempt, and the checkpoint moves on only
    afterwards, so a restart neither loses nor doubles a message, and a new checkpoint on the same
    output replaces nothing. With ``once`` all that is there is processed, then it stops. A batch
    that begins beyond the ``limit`` fails before it reads anything; the next run begins with it.
    """
    run: list[str] = []
    limit = limit or Limit()

    def handle(batch: DataFrame, batch_id: int) -> None:
        if limit.reached():
            limit.turned_away = True
            raise RuntimeError(f"{limit.consumed} messages consumed, the limit of this run is {limit.most}")
        if not run:
            run.append(run_id(batch.sparkSession, checkpoint))
        name = f"{run[0]}-{batch_id}"
        seen = Observation(f"gate-{name}")
        gated = gate(batch)
        watched = gated.observe(seen, *gate_counts(gated))
        publish(routed(watched), f"{out}/topics", name, broker)
        counts = seen.get
        names = ("consumed", "valid", "dead_lettered", "alerts")
        row = (batch_id, *[int(counts[name]) for name in names])
        stats = batch.sparkSession.createDataFrame([row], STATS_SCHEMA)
        stats.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/stats/run={name}")
        limit.consumed += row[1]

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_gate(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    timeout: float | None = None,
    broker: Mapping[str, str] | None = None,
    max_messages: int | None = None,
    idle: float | None = None,
) -> int:
    """Run within bounds; returns the messages consumed.

    Without ``idle`` what is there is processed and the run ends; with it the run waits for more and
    ends after so many seconds without any. It ends after ``timeout`` seconds at the latest, and with
    the micro-batch that reaches ``max_messages``: how far beyond it goes is up to what the source puts
    into a batch. Whatever ends a run, the next one on the same checkpoint goes on where it stopped.
    """
    limit = Limit(max_messages)
    query = start_gate(messages, out, checkpoint, once=idle is None, broker=broker, limit=limit)
    began = busy = time.monotonic()
    try:
        while not query.awaitTermination(0.2):
            now, status = time.monotonic(), query.status
            if status["isDataAvailable"] or "Initializing" in status["message"]:
                busy = now
            late = timeout is not None and now - began > timeout
            still = idle is not None and now - busy > idle
            # between batches: a batch that is counted has still to be committed
            full = limit.reached() and not status["isDataAvailable"]
            if late or still or full:
                query.stop()
    except StreamingQueryException:
        if not limit.turned_away:
            raise
    return limit.consumed


def gate_stats(spark: SparkSession, out: str) -> DataFrame:
    """One row: the counters of all batches so far."""
    stats = spark.read.schema(STATS_SCHEMA).parquet(f"{out}/stats/run=*")
    return stats.agg(
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("consumed", "valid", "dead_lettered", "alerts")
        ]
    )
