from __future__ import annotations

import json
import threading
import time
import uuid
import zipfile
from pathlib import Path

import pytest
from helpers import event_line
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from millrace.session import scratch_root
from millrace.sources.archives import archive_files, newest_archive
from millrace.sources.topics import publish, publish_newest, read_topic, stream_topic
from millrace.streaming.events import stream_events, to_messages
from millrace.streaming.gate import gate, routed
from millrace.streaming.run import gate_stats, run_gate

GOOD = {"global_event_id": 1, "event_day": "2026-01-01", "quad_class": 2, "goldstein_scale": 1.0}


def messages(spark, *values, key=b"US"):
    rows = [(key, v if v is None or isinstance(v, bytes) else v.encode()) for v in values]
    return spark.createDataFrame(rows, "key binary, value binary")


def judged(spark, value):
    row = gate(messages(spark, value)).first()
    return row.outcome, list(row.codes), row.topic, row.payload


def test_event_projection(lines_of):
    line = event_line(
        global_event_id="+900", sql_date="20250318", quad_class=" 3 ", goldstein_scale="2e0", action_geo_fullname="Oslo",
        actor1_name=" kim ", num_mentions="8.0", action_geo_lat="59.9", event_root_code="07",
    )
    got = stream_events(lines_of([line])).first().asDict()
    filled = {"global_event_id": 900, "event_day": "2025-03-18", "quad_class": 3, "goldstein_scale": 2.0,
              "action_location": "Oslo", "actor1_name": "kim", "action_lat": 59.9, "event_root_code": "07"}
    assert len(got) == 18 and {k: v for k, v in got.items() if v is not None} == filled


@pytest.mark.parametrize(
    ("text", "number"),
    [("1e3", 1000.0), ("inf", float("inf")), ("1d", None), ("1f", None), ("x", None), ("", None)],
)
def test_stream_numbers(lines_of, text, number):
    assert stream_events(lines_of([event_line(avg_tone=text)])).first().avg_tone == number


def test_short_and_undated_lines_are_events_too(lines_of):
    short = stream_events(lines_of(["7\t2026"])).first()
    assert (short.global_event_id, short.event_day, short.source_url) == (7, None, None)
    odd = stream_events(lines_of([event_line(sql_date="99999999")])).first()
    assert odd.event_day == "9999-99-99"


def test_messages_keep_nulls_and_key_order(lines_of):
    frame = lines_of([
        event_line(global_event_id=1, action_geo_country_code="NO", actor1_country_code="PE"),
        event_line(global_event_id=2, actor1_country_code="PE"),
        event_line(global_event_id=3),
    ])
    rows = {json.loads(r.value)["global_event_id"]: r for r in to_messages(stream_events(frame)).collect()}
    assert {i: r.key and bytes(r.key) for i, r in rows.items()} == {1: b"NO", 2: b"PE", 3: None}
    body = json.loads(rows[1].value)
    assert len(body) == 18
    assert body["event_day"] is None
    assert list(body)[:2] == ["global_event_id", "event_day"]
    assert b" " not in bytes(rows[1].value)


def test_valid_event_goes_nowhere(spark):
    outcome, codes, topic, _ = judged(spark, json.dumps(GOOD))
    assert (outcome, codes, topic) == ("valid", [], None)


@pytest.mark.parametrize(
    "value",
    ["{bad", "[1]", "5", "null", "", None, "{}x", '{"a":1}{"b":2}', "{}}", "{},{}", "{'a':1}",
     '{"goldstein_scale":"x"}', b'{"a":"\xff"}'],
)
def test_undecodable_goes_to_dead_letters_as_it_came(spark, value):
    outcome, _, topic, payload = judged(spark, value)
    assert (outcome, topic) == ("undecodable", "dlq")
    raw = value.encode() if isinstance(value, str) else value
    assert (payload if payload is None else bytes(payload)) == raw


def test_violations_in_fixed_order_and_unknown_keys_survive(spark):
    bad = {"event_day": None, "quad_class": 0, "goldstein_scale": -10.1, "avg_tone": 100.5,
           "action_lat": -90.25, "action_long": 12.5, "more": {"x": [1, "}"]}}
    outcome, codes, topic, payload = judged(spark, json.dumps(bad))
    assert (outcome, topic) == ("invalid", "dlq")
    assert codes == [
        "global_event_id_missing", "event_day_missing", "quad_class_out_of_range",
        "goldstein_out_of_range", "avg_tone_out_of_range", "action_lat_out_of_range",
    ]
    assert json.loads(payload) == {**bad, "_violations": codes}
    assert json.loads(judged(spark, "{}")[3]) == {
        "_violations": ["global_event_id_missing", "event_day_missing"]
    }


@pytest.mark.parametrize(
    ("fields", "codes"),
    [({"action_long": -180.5}, ["action_long_out_of_range"]), ({"action_lat": 90}, []),
     ({"quad_class": None}, []), ({"quad_class": 4.0}, []), ({"event_day": ""}, ["event_day_missing"]),
     ({"global_event_id": 0}, []), ({"avg_tone": float("nan")}, ["avg_tone_out_of_range"])],
)
def test_single_rules(spark, fields, codes):
    assert judged(spark, json.dumps({**GOOD, **fields}))[1] == codes


@pytest.mark.parametrize(
    ("fields", "alert"),
    [({"goldstein_scale": -8.5}, True), ({"goldstein_scale": -8.0}, True), ({"goldstein_scale": -7.99}, False),
     ({"quad_class": 4, "num_mentions": 11}, True), ({"quad_class": 4, "num_mentions": 10}, True),
     ({"quad_class": 4, "num_mentions": 9}, False), ({"quad_class": 4, "num_mentions": None}, False),
     ({"quad_class": 4}, False), ({"quad_class": 3, "num_mentions": 500}, False)],
)
def test_alerts_pass_the_value_through(spark, fields, alert):
    value = json.dumps({**GOOD, **fields})
    outcome, _, topic, payload = judged(spark, value)
    assert (outcome, topic) == (("alert", "alerts") if alert else ("valid", None))
    assert bytes(payload).decode() == value


def test_filter_on_the_outcome_does_not_decode_again(spark):
    plan = routed(gate(messages(spark, json.dumps(GOOD))))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") <= 1


@pytest.fixture
def place(spark):
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def topic_values(spark, root, topic):
    return sorted(bytes(r.value) for r in read_topic(spark, root, topic).collect())


def test_run_and_restart_handle_each_message_once(spark, place):
    source, out, state = f"{place}/in", f"{place}/out", f"{place}/state"
    hot = json.dumps({**GOOD, "goldstein_scale": -8.75})

    def send(batch, *values):
        publish(messages(spark, *values).withColumn("topic", F.lit("raw")), source, batch)

    def run():
        run_gate(stream_topic(spark, source, "raw", max_files=1), out, state, timeout=120)
        return tuple(gate_stats(spark, out).first())

    send("0", json.dumps(GOOD), hot, "{bad")
    assert run() == (3, 2, 1, 1)
    assert run() == (3, 2, 1, 1)
    send("1", hot, json.dumps({**GOOD, "quad_class": 7}))
    assert run() == (5, 3, 2, 2)
    assert topic_values(spark, f"{out}/topics", "alerts") == [hot.encode()] * 2
    dead = topic_values(spark, f"{out}/topics", "dlq")
    assert dead[1] == b"{bad"
    assert json.loads(dead[0])["_violations"] == ["quad_class_out_of_range"]


def test_a_run_stops_at_its_limit_and_the_next_goes_on(spark, place):
    for n in range(4):
        sent = messages(spark, *[json.dumps({**GOOD, "global_event_id": n})] * 3).coalesce(1)
        publish(sent.withColumn("topic", F.lit("raw")), f"{place}/in", str(n))
    raw = stream_topic(spark, f"{place}/in", "raw", max_files=1)
    bounds = {"timeout": 120, "max_messages": 4}
    assert [run_gate(raw, f"{place}/out", f"{place}/state", **bounds) for _ in range(3)] == [6, 6, 0]
    assert tuple(gate_stats(spark, f"{place}/out").first()) == (12, 12, 0, 0)


def test_an_idle_run_waits_for_messages_then_stops(spark, place):
    publish(messages(spark, json.dumps(GOOD)).withColumn("topic", F.lit("raw")), f"{place}/in", "0")

    def later():
        time.sleep(3)
        publish(messages(spark, "{bad").withColumn("topic", F.lit("raw")), f"{place}/in", "1")

    other = threading.Thread(target=later)
    other.start()
    began = time.monotonic()
    raw = stream_topic(spark, f"{place}/in", "raw")
    assert run_gate(raw, f"{place}/out", f"{place}/state", timeout=120, idle=8) == 2
    assert 8 < time.monotonic() - began < 100
    other.join()
    assert tuple(gate_stats(spark, f"{place}/out").first()) == (2, 1, 1, 0)
    assert run_gate(raw, f"{place}/out", f"{place}/state", max_messages=1, idle=1) == 0


def test_a_fault_is_no_limit(spark, place):
    publish(messages(spark, "{}").withColumn("topic", F.lit("raw")), f"{place}/in", "0")
    raw = stream_topic(spark, f"{place}/in", "raw").withColumn("value", F.raise_error(F.lit("broken")).cast("binary"))
    with pytest.raises(StreamingQueryException):
        run_gate(raw, f"{place}/out", f"{place}/state", max_messages=5)


def test_newest_archive_is_published(spark, place, tmp_path):
    for day, ids in (("2026-01-01", (1, 2)), ("2026-01-02", (3, 4, 5))):
        folder = tmp_path / "export" / f"dt={day}" / "hour=00"
        folder.mkdir(parents=True)
        with zipfile.ZipFile(folder / f"{day}.export.CSV.zip", "w") as container:
            lines = [event_line(global_event_id=i) for i in ids]
            container.writestr("x.CSV", "\n".join([*lines, "", "short\trow"]))
    files = archive_files(spark, str(tmp_path / "export"))
    for _ in range(2):
        assert publish_newest(files, place, "0", "raw") == 4
        sent = [json.loads(v)["global_event_id"] for v in topic_values(spark, place, "raw")]
        assert sorted(i for i in sent if i) == [3, 4, 5]
        assert len(sent) == 4


def test_nothing_to_publish(spark, place, tmp_path):
    (tmp_path / "note.txt").write_text("no archive")
    files = archive_files(spark, str(tmp_path))
    assert newest_archive(files).count() == 0
    assert publish_newest(files, place, "0", "raw") == 0


def test_a_new_checkpoint_replaces_nothing(spark, place):
    hot = json.dumps({**GOOD, "goldstein_scale": -8.75})
    for n in (1, 2):
        publish(messages(spark, hot, "{bad").withColumn("topic", F.lit("raw")), f"{place}/in{n}", "0")
        run_gate(stream_topic(spark, f"{place}/in{n}", "raw"), f"{place}/out", f"{place}/state{n}", timeout=120)
    assert tuple(gate_stats(spark, f"{place}/out").first()) == (4, 2, 2, 2)
    assert len(topic_values(spark, f"{place}/out/topics", "dlq")) == 2


def test_a_batch_written_again_loses_topics_it_has_no_more(spark, place):
    publish(messages(spark, "a").withColumn("topic", F.lit("one")), place, "0")
    publish(messages(spark, "b").withColumn("topic", F.lit("two")), place, "0")
    assert topic_values(spark, place, "two") == [b"b"]
    with pytest.raises(AnalysisException):
        topic_values(spark, place, "one")


def test_a_damaged_file_stops_the_stream(spark, place):
    publish(messages(spark, json.dumps(GOOD)).withColumn("topic", F.lit("raw")), f"{place}/in", "0")
    folder = Path(place.removeprefix("file:")) / "in" / "batch=0" / "topic=raw"
    (folder / "part-damaged.parquet").write_bytes(b"not a table")
    with pytest.raises(StreamingQueryException):
        run_gate(stream_topic(spark, f"{place}/in", "raw"), f"{place}/out", f"{place}/state", timeout=120)
