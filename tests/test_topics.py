"""Topics: order per key, a sink that commits, damaged files set aside."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_root
from millrace.sources.topic_sink import TopicWriter, start_sink
from millrace.sources.topics import next_positions, publish, read_in_order, read_topic, stream_topic
from millrace.streaming.order import sequenced
from millrace.streaming.run import gate_stats, run_gate

GOOD = {"global_event_id": 1, "event_day": "2026-01-01", "quad_class": 2, "goldstein_scale": 1.0}
SENT = "run string, key binary, value binary"


@pytest.fixture
def place(spark):
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def local(place):
    return Path(place.removeprefix("file:"))


def test_positions_follow_runs_and_order_for_hot_and_null_keys(spark):
    rows = [(f"r{n % 7}", (b"hot", None, b"", b"US")[min(n % 9, 3)], b"%03d" % (n * 37 % 100)) for n in range(400)]
    got = sequenced(spark.createDataFrame(rows, SENT), "run", ["value"]).collect()
    by_key = defaultdict(list)
    for r in got:
        by_key[r.key and bytes(r.key), r.key is None].append((r.position, r.run, bytes(r.value)))
    assert len(by_key) == 4 and len(got) == 400
    for (key, none), found in by_key.items():
        wanted = sorted((run, value) for run, k, value in rows if (k is None) == none and (none or k == (key or b"")))
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert [(run, value) for _, run, value in found] == wanted


def test_positions_go_on_and_a_batch_sent_again_gets_the_same(spark, place):
    def send(name, rows):
        after = next_positions(spark, place, "raw", name) if name != "a" else None
        numbered = sequenced(spark.createDataFrame(rows, SENT), "run", ["value"], after)
        publish(numbered.withColumn("topic", F.lit("raw")), place, name)

    send("a", [("1", b"US", b"x"), ("1", None, b"y"), ("2", b"US", b"a")])
    for _ in range(2):
        send("b", [("3", b"US", b"c"), ("3", None, b"d"), ("3", b"FR", b"e")])
    got = [(r.key and bytes(r.key), bytes(r.value), r.position) for r in read_in_order(spark, place, "raw").collect()]
    assert got == [(None, b"y", 0), (None, b"d", 1), (b"FR", b"e", 0), (b"US", b"x", 0), (b"US", b"a", 1), (b"US", b"c", 2)]


def test_nothing_to_number(spark):
    assert sequenced(spark.createDataFrame([], SENT), "run", ["value"]).collect() == []


def batches(*rows, fail=False):
    for topic, value in rows:
        yield pa.RecordBatch.from_pydict({"topic": [topic], "key": [b"k"], "value": [value]})
    if fail:
        raise RuntimeError("task lost")


def test_a_task_that_fails_after_its_write_leaves_nothing(spark, place):
    writer = TopicWriter({"path": place, "run": "r"})
    with pytest.raises(RuntimeError):
        writer.write(batches(("a", b"1"), fail=True))
    done = writer.write(batches(("a", b"1"), ("b", b"2")))
    writer.abort([done, None], 0)
    assert [p for p in local(place).rglob("*") if p.is_file()] == []


def test_a_batch_that_comes_again_is_published_once(spark, place):
    writer = TopicWriter({"path": place, "run": "r"})
    for attempt in range(2):
        tasks = [writer.write(batches(("a", b"1"), ("b", b"2"), ("a", b"3"))), writer.write(batches()), writer.write(batches(("a", b"4")))]
        assert local(place).joinpath("batch=r-0").exists() is (attempt == 1)
        writer.commit(tasks, 0)
    assert sorted(bytes(r.value) for r in read_topic(spark, place, "a").collect()) == [b"1", b"3", b"4"]
    assert [bytes(r.value) for r in read_topic(spark, place, "b").collect()] == [b"2"]
    assert not list(local(place).joinpath("_staged").iterdir())


def test_a_commit_that_died_half_way_is_done_again(spark, place):
    left = local(place) / "_staged" / "batch=r-0" / "topic=a"
    left.mkdir(parents=True)
    (left / "old.parquet").write_bytes(b"half")
    writer = TopicWriter({"path": place, "run": "r"})
    writer.commit([writer.write(batches(("a", b"1")))], 0)
    assert [bytes(r.value) for r in read_topic(spark, place, "a").collect()] == [b"1"]


def test_a_stream_through_the_sink(spark, place):
    rows = spark.createDataFrame([("raw", b"k", b"1"), ("raw", None, b"2")], "topic string, key binary, value binary")
    for n in range(2):
        publish(rows, f"{place}/in", str(n))
        sent = stream_topic(spark, f"{place}/in", "raw").withColumn("topic", F.lit("out"))
        start_sink(sent, f"{place}/out", f"{place}/state", "copy").awaitTermination()
    got = sorted(bytes(r.value) for r in read_topic(spark, f"{place}/out", "out").collect())
    assert got == [b"1", b"1", b"2", b"2"]


def test_one_damaged_file_of_ten_is_named_and_the_others_go_on(spark, place):
    for n in range(9):
        row = [(b"US", json.dumps({**GOOD, "global_event_id": n}).encode())]
        publish(spark.createDataFrame(row, "key binary, value binary").withColumn("topic", F.lit("raw")), f"{place}/in", str(n))
    whole = next((local(place) / "in" / "batch=0").rglob("*.parquet")).read_bytes()
    broken = local(place) / "in" / "batch=9" / "topic=raw"
    broken.mkdir(parents=True)
    # the end of the file, with its description, is in order; the data is not
    (broken / "x.parquet").write_bytes(whole[:4] + b"\0" * 60 + whole[64:])
    raw = stream_topic(spark, f"{place}/in", "raw", max_files=4, set_aside=True)
    assert run_gate(raw, f"{place}/out", f"{place}/state", timeout=120) == 9
    assert run_gate(raw, f"{place}/out", f"{place}/state", timeout=120) == 0
    assert tuple(gate_stats(spark, f"{place}/out").first()) == (9, 9, 0, 0)
    named = read_topic(spark, f"{place}/out/topics", "damaged").collect()
    assert [bytes(r.key).decode().endswith("batch=9/topic=raw/x.parquet") for r in named] == [True]
    assert bytes(named[0].value)
