from __future__ import annotations

import datetime as dt
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from helpers import event_line
from pyspark.sql import functions as F

from millrace.operators import star
from millrace.operators.history import advance_history, as_of_join, open_versions
from millrace.operators.integrity import duplicates, nulls, orphans, unaccepted
from millrace.operators.silver import to_silver
from millrace.plans import build_gold as build_gold_module
from millrace.plans.build_gold import build_gold, gold_tests, load_fact, snapshot_actors
from millrace.plans.load_silver import load_silver

T1, T2, T3 = dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 2), dt.datetime(2026, 7, 3)
ATTRS = ", ".join(f"{name} string" for name in ("actor_code", *star.ACTOR_ATTRIBUTES))


def actors(spark, **names):
    return spark.createDataFrame([(c, n, *["x"] * 5) for c, n in names.items()], ATTRS)


def staged_of(lines_of, *events):
    lines = [event_line(**{"sql_date": "20260725", "date_added": "20260725120000", **e}) for e in events]
    return star.stage_events(to_silver(lines_of(lines)))


def test_dim_date(lines_of):
    got = star.dim_date(staged_of(lines_of, {"global_event_id": 1}, {"global_event_id": 2})).collect()
    assert [tuple(r) for r in got] == [
        (20260725, dt.date(2026, 7, 25), 2026, 3, 7, "July", 25, 6, "Saturday", True)
    ]


def test_actor_attributes_take_the_greatest_of_both_roles(lines_of):
    staged = staged_of(
        lines_of,
        {"global_event_id": 1, "actor1_code": "A", "actor1_name": "a", "actor2_code": "B"},
        {"global_event_id": 2, "actor2_code": "A", "actor2_name": "z", "actor2_type1_code": "T"},
        {"global_event_id": 3, "actor1_name": "no code"},
    )
    assert star.actor_mentions(staged).count() == 3
    got = {r.actor_code: r for r in star.actor_attributes(staged).collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].actor_name, got["A"].type_code, got["B"].actor_name) == ("z", "T", None)


def test_geography_key_falls_back_to_name_and_mixes_rows(lines_of):
    staged = staged_of(
        lines_of,
        {"global_event_id": 1, "action_geo_feature_id": "F", "action_geo_type": 4, "action_geo_lat": 1},
        {"global_event_id": 2, "action_geo_feature_id": "F", "action_geo_fullname": "n", "action_geo_type": 1},
        {"global_event_id": 3, "action_geo_fullname": "only", "action_geo_type": 9},
        {"global_event_id": 4},
    )
    got = {r.geo_natural_key: r for r in star.dim_geography(staged).collect()}
    assert set(got) == {"F", "only"}
    assert (got["F"].geo_type_name, got["F"].geo_fullname, got["F"].latitude) == ("World City", "n", 1.0)
    assert got["only"].geo_type_name == "Unknown"


def test_event_types_match_roots_of_any_width(spark, lines_of):
    staged = staged_of(
        lines_of,
        {"global_event_id": 1, "event_code": "010", "event_root_code": "1", "quad_class": 1},
        {"global_event_id": 2, "event_code": "190", "event_root_code": "19", "quad_class": 4},
        {"global_event_id": 3, "event_code": "999", "event_root_code": "99", "quad_class": 4},
        {"global_event_id": 4, "event_code": "190", "event_root_code": "19", "quad_class": 3},
    )
    dim = star.dim_cameo_event(staged, star.event_roots(spark))
    found = {(r.event_code, r.root_description, r.quad_class) for r in dim.collect()}
    assert found == {
        ("010", "Make Public Statement", 1),
        ("190", "Fight", 4),
        ("190", "Fight", 3),
        ("999", None, 4),
    }
    assert [(r.row_count) for r in duplicates(dim, "cameo_key").collect()] == [2]


def test_history_of_two_batches(spark):
    first = open_versions(actors(spark, same="s", changed="old", gone="g", filled=None), F.lit(T1))
    second = actors(spark, same="s", changed="new", filled="value", born="b")
    both = advance_history(first, second, F.lit(T2))
    rows = {(r.actor_code, r.actor_name, r.valid_from, r.valid_to) for r in both.collect()}
    assert rows == {
        ("same", "s", T1, None),
        ("changed", "old", T1, T2),
        ("changed", "new", T2, None),
        ("gone", "g", T1, None),
        ("filled", None, T1, T2),
        ("filled", "value", T2, None),
        ("born", "b", T2, None),
    }
    assert both.select("scd_id").distinct().count() == 7
    again = advance_history(both, second, F.lit(T3))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in both.collect()}
    assert star.dim_actor(both).count() == 5


def test_as_of_includes_start_and_excludes_end(spark):
    first = open_versions(actors(spark, a="old"), F.lit(T1))
    history = advance_history(first, actors(spark, a="new"), F.lit(T2))
    second = dt.timedelta(seconds=1)
    facts = [(1, "a", T1 - second), (2, "a", T1), (3, "a", T2 - second), (4, "a", T2),
             (5, "a", T3), (6, "other", T3), (7, None, T3), (8, "a", None)]
    frame = spark.createDataFrame(facts, "id int, code string, at timestamp")
    got = {r.id: r.actor_name for r in as_of_join(frame, history, "code", "at").collect()}
    assert got == {1: None, 2: "old", 3: "old", 4: "new", 5: "new", 6: None, 7: None, 8: None}


def test_as_of_equals_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    start = dt.datetime(2026, 1, 1)
    versions = []
    for key in ["hot", *map(str, range(10))]:
        cuts = sorted(rng.sample(range(60 * 24 * 20), 40 if key == "hot" else 3))
        moments = [start + dt.timedelta(minutes=m) for m in cuts]
        ends = [*moments[1:], None if key != "3" else moments[-1] + dt.timedelta(hours=5)]
        versions += [(key, f"{key}-{i}", *["x"] * 5, "id", b, b, e)
                     for i, (b, e) in enumerate(zip(moments, ends, strict=True))]
    history = spark.createDataFrame(
        versions, ATTRS + ", scd_id string, updated_at timestamp, valid_from timestamp, valid_to timestamp"
    )
    facts = [(i, rng.choice(["hot"] * 10 + list(map(str, range(12)))),
              start + dt.timedelta(minutes=rng.randrange(60 * 24 * 25))) for i in range(3000)]
    frame = spark.createDataFrame(facts, "id int, code string, at timestamp")
    want = {
        i: next((v[1] for v in versions if v[0] == c and v[8 + 1] <= at and (v[10] is None or at < v[10])), None)
        for i, c, at in facts
    }
    rows = as_of_join(frame, history, "code", "at").collect()
    assert len(rows) == len(facts)
    assert {r.id: r.actor_name for r in rows} == want


def test_incremental_fact(spark, schema, lines_of):
    name = f"{schema}.fact"

    def load(*events, **options):
        load_fact(spark, staged_of(lines_of, *events), name, **options)
        return {r.event_key: r.avg_tone for r in spark.table(name).collect()}

    first = {"global_event_id": 1, "avg_tone": 1}
    undated = {"global_event_id": 2, "avg_tone": 2, "date_added": ""}
    assert load(first, undated) == {1: 1.0}
    later = {"global_event_id": 3, "avg_tone": 3, "date_added": "20260725120001"}
    equal = {"global_event_id": 4, "avg_tone": 4}
    older = {"global_event_id": 5, "avg_tone": 5, "date_added": "20260725110000"}
    assert load(first, undated, later, equal, older) == {1: 1.0, 3: 3.0}
    again = {"global_event_id": 1, "avg_tone": 9, "date_added": "20260725130000", "sql_date": "20260801"}
    assert load(again) == {1: 9.0, 3: 3.0}
    assert spark.table(name).count() == 2
    late = {"global_event_id": 6, "avg_tone": 6, "date_added": "20260725123000"}
    assert 6 not in load(late)
    assert load(late, lookback=dt.timedelta(hours=1))[6] == 6.0
    assert load(first, later, full_refresh=True) == {1: 1.0, 3: 3.0}


@pytest.fixture
def silver(spark, schema, lines_of):
    name = f"{schema}.events"
    lines = [
        event_line(global_event_id=i, sql_date=f"202607{i % 5 + 1:02}", date_added="20260725120000",
                   quad_class=i % 4 + 1, event_code=f"0{i % 4 + 1}0", event_root_code=f"0{i % 4 + 1}",
                   actor1_code=f"A{i % 7}", actor1_name="n", actor2_code="" if i % 3 else f"B{i % 4}",
                   action_geo_fullname=f"place {i % 6}")
        for i in range(1, 101)
    ]
    load_silver(spark, lines_of(lines), name)
    return name


def test_gold_builds_and_passes_its_tests(spark, schema, silver, lines_of):
    gold = f"{schema}_gold"
    assert set(build_gold(spark, silver, gold, T1).values()) == {0}
    assert spark.table(f"{gold}.fact_events").count() == 100
    more = event_line(global_event_id=500, sql_date="20260709", date_added="20260726120000",
                      quad_class=1, actor1_code="A1", actor1_name="renamed")
    load_silver(spark, lines_of([more]), silver)
    assert set(build_gold(spark, silver, gold, T2).values()) == {0}
    assert spark.table(f"{gold}.fact_events").count() == 101
    versions = spark.table(f"{gold}.snap_dim_actor").filter("actor_code = 'A1'")
    assert {(r.actor_name, r.valid_from, r.valid_to) for r in versions.collect()} == {
        ("n", T1, T2),
        ("renamed", T2, None),
    }
    before = spark.table(f"{gold}.snap_dim_actor").count()
    build_gold(spark, silver, gold, T3)
    assert spark.table(f"{gold}.snap_dim_actor").count() == before
    assert spark.table(f"{gold}.dim_actor").filter("is_current").count() == 11
    spark.sql(f"DROP TABLE {gold}.dim_date")
    spark.table(f"{gold}.fact_events").limit(0).select("date_key").write.saveAsTable(f"{gold}.dim_date")
    broken = gold_tests(spark, silver, gold)["relationships_fact_events_date_key"]
    assert broken.agg(F.sum("row_count")).first()[0] == 101
    spark.sql(f"DROP NAMESPACE {gold} CASCADE")


def test_integrity_counts(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert [tuple(r) for r in orphans(child, "k", parent, "id").collect()] == [("x", 2)]
    assert orphans(child, "k", parent, "id", where=F.col("k") != "x").count() == 0
    assert {tuple(r) for r in duplicates(child, "k").collect()} == {("a", 2), ("x", 2)}
    assert nulls(child, "k").first().row_count == 1
    assert nulls(child.filter("k = 'a'"), "k").count() == 0
    assert {r.value for r in unaccepted(child, "k", ["a", "b"]).collect()} == {"x"}


DOUBLED_HOUR = """
import sys
from datetime import datetime, timezone
from pyspark.sql import functions as F
from millrace.functions.instants import instant, micros
from millrace.operators import star
from millrace.plans.build_gold import load_fact
from millrace.session import build_session
spark = build_session("dst", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions=2,
                      spark__sql__warehouse__dir=sys.argv[1] + "/w")
lines = ["2025-11-02 05:30:00", "2025-11-02 06:00:00", "2025-11-02 06:30:00"]
def staged(n):
    rows = [(k, t) for k, t in enumerate(lines[:n])]
    frame = spark.createDataFrame(rows, "global_event_id long, t string")
    wanted = {"sql_date": "date", "actor1_code": "string", "actor2_code": "string", "action_geo_feature_id": "string",
              "action_geo_fullname": "string", "event_code": "string", "is_root_event": "int", "quad_class": "int",
              "source_url": "string", "goldstein_scale": "double", "num_mentions": "int", "num_sources": "int",
              "num_articles": "int", "avg_tone": "double"}
    frame = frame.select("global_event_id", F.to_timestamp("t").alias("date_added"),
        *[F.lit("2025-11-02" if k == "date" else None).cast(k).alias(c) for c, k in wanted.items()])
    return frame
for n in (1, 2, 3):
    load_fact(spark, staged(n), "fact_dst")
    assert spark.table("fact_dst").count() == n, (n, spark.table("fact_dst").count())
naive, aware = datetime(2025, 11, 2, 5, 30), datetime(2025, 11, 2, 5, 30, tzinfo=timezone.utc)
assert micros(naive) == micros(aware) == spark.range(1).select(F.unix_micros(instant(naive))).first()[0]
print("fine")
"""


def test_no_event_is_lost_in_the_doubled_hour(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    env = {**os.environ, "TZ": "America/New_York", "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", DOUBLED_HOUR, str(tmp_path)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_snapshots_of_one_second_keep_all_versions(spark, schema):
    table = f"{schema}.snap"
    for k in range(4):
        moment = T1 + dt.timedelta(milliseconds=100 * k)
        for _ in range(2):  # each also run again
            snapshot_actors(spark, actors(spark, a=f"name {k}"), table, moment)
    rows = spark.table(table).collect()
    assert len(rows) == len({r.scd_id for r in rows}) == 4
    assert sorted(r.actor_name for r in rows) == [f"name {k}" for k in range(4)]


def test_a_snapshot_reads_no_closed_days_before_the_last_one(spark, schema, monkeypatch):
    table = f"{schema}.snap"
    for k in range(4):
        snapshot_actors(spark, actors(spark, a=f"name {k}", b="same"), table, T1 + dt.timedelta(days=k))
    days = {r[0] for r in spark.table(table).select("ended_on").distinct().collect()}
    assert days == {None, *((T1 + dt.timedelta(days=k)).date() for k in (1, 2, 3))}
    seen = []
    real = build_gold_module.advance_history
    monkeypatch.setattr(build_gold_module, "advance_history", lambda h, *rest: seen.append(h.inputFiles()) or real(h, *rest))
    # a run that dies after its closed versions were added is healed by one of another day
    monkeypatch.setattr(build_gold_module, "overwrite_partitions", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        snapshot_actors(spark, actors(spark, a="late", b="same"), table, T1 + dt.timedelta(days=4))
    monkeypatch.undo()
    snapshot_actors(spark, actors(spark, a="late", b="same"), table, T1 + dt.timedelta(days=5))
    assert len(seen) == 1
    rows = spark.table(table).filter("actor_code = 'a'").collect()
    assert len({r.valid_from for r in rows}) == len(rows) == 5
    assert [r.actor_name for r in rows if r.valid_to is None] == ["late"]
