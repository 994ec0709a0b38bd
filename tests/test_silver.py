from __future__ import annotations

import datetime as dt

import pytest
from helpers import event_line

from millrace.contract import EVENTS
from millrace.operators.quality import SILVER_CHECKS, Check, QualityError, check_frame, hold_back
from millrace.operators.silver import to_silver, type_lines
from millrace.plans.load_silver import SchemaDriftError, load_silver

DAY = "20250318"


def event(key, added=f"{DAY}120000", **fields):
    values = {"sql_date": DAY, "quad_class": 1, **fields}
    return event_line(global_event_id=key, date_added=added, **values)


def test_types_and_empty_fields(lines_of):
    line = event(71, f"{DAY}094501", num_articles="12", goldstein_scale="-4.25", event_code=" 0871")
    got = to_silver(lines_of([(line, "march.zip")])).first()
    assert (got.global_event_id, got.num_articles, got.goldstein_scale) == (71, 12, -4.25)
    assert (got.sql_date, got.date_added) == (dt.date(2025, 3, 18), dt.datetime(2025, 3, 18, 9, 45, 1))
    assert (got.event_code, got.avg_tone, got.actor2_code) == ("0871", None, None)
    assert got._source_file == "march.zip" and got._ingested_at is not None


def test_column_order_is_the_contract(lines_of):
    assert to_silver(lines_of([event(1)])).columns == [
        *EVENTS.names,
        "_source_file",
        "_ingested_at",
    ]


@pytest.mark.parametrize(
    ("text", "value"),
    [("7", 7), ("+7", 7), ("-7", -7), ("1.5", 1), ("-1.9", -1), ("1.", 1), ("abc", None),
     ("1e3", None), ("1.5.5", None), ("1,5", None), ("99999999999", None), ("NaN", None)],
)
def test_integer_rule(lines_of, text, value):
    assert type_lines(lines_of([event(1, num_mentions=text)])).first().num_mentions == value


@pytest.mark.parametrize("text", ["2025031", "20250230", "18.03.2025", "today", "020250318"])
def test_bad_date_is_null(lines_of, text):
    assert type_lines(lines_of([event(1, sql_date=text)])).first().sql_date is None


def test_newest_wins_and_ties_are_settled(lines_of):
    older, newer = event(1, f"{DAY}083000", avg_tone=1), event(1, f"{DAY}084500", avg_tone=9)
    undated = event(1, "", avg_tone=5)
    assert to_silver(lines_of([older, newer, undated])).first().avg_tone == 9
    tied = [(event(2, avg_tone=1), "a.zip"), (event(2, avg_tone=2), "b.zip")]
    for rows in (tied, tied[::-1]):
        got = to_silver(lines_of(rows)).collect()
        assert [(r._source_file, r.avg_tone) for r in got] == [("b.zip", 2.0)]
    same_file = [event(3, avg_tone=1), event(3, avg_tone=2)]
    assert {to_silver(lines_of(o)).first().avg_tone for o in (same_file, same_file[::-1])} == {2.0}


def test_rows_without_key_are_dropped(lines_of):
    got = to_silver(lines_of([event(""), event("x"), event(2)])).collect()
    assert [r.global_event_id for r in got] == [2]


def test_a_hot_key_is_cut_down_before_the_shuffle(lines_of):
    hot = [event(1, f"{DAY}12{i // 60:02}{i % 60:02}") for i in range(2000)]
    frame = to_silver(lines_of(hot + [event(k) for k in range(2, 500)]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert frame.count() == 499


QUALITY = (
    "global_event_id bigint, sql_date date, quad_class int, goldstein_scale double, "
    "avg_tone double, num_articles int, action_geo_lat double, action_geo_long double"
)
FINE = (dt.date(2025, 3, 18), 3, -6.5, -2.75, 44, -33.9, 151.2)


def failed(rows):
    return {r["check_name"]: r["failures"] for r in rows if not r["passed"]}


def test_clean_rows_pass(spark):
    rows = hold_back(spark.createDataFrame([(k, *FINE) for k in range(5)], QUALITY))
    assert failed(rows) == {} and len(rows) == len(SILVER_CHECKS)


def test_errors_stop_and_warnings_do_not(spark):
    rows = [(8, *FINE), (8, *FINE), (8, *FINE), (None, None, 0, *FINE[2:])]
    table = spark.createDataFrame(rows, QUALITY)
    assert failed(check_frame(table).collect()) == {
        "global_event_id: not null": 1, "global_event_id: unique": 2, "sql_date: not null": 1, "quad_class: in set": 1,
    }
    with pytest.raises(QualityError, match="'quad_class: in set': 1"):
        hold_back(table)
    odd = [(1, FINE[0], 2, 10.5, -100.5, -1, 90.5, 180.5), (2, *FINE)]
    warned = hold_back(spark.createDataFrame(odd, QUALITY))
    assert set(failed(warned)) == {c.label() for c in SILVER_CHECKS if c.severity == "warn"}


def test_suite_edges(spark):
    empty = spark.createDataFrame([], QUALITY)
    assert failed(hold_back(empty)) == {}
    assert check_frame(empty, []).count() == 0
    with pytest.raises(ValueError, match="unknown kind"):
        hold_back(empty, [Check("odd", "sql_date")])
    nan = spark.createDataFrame([(float("nan"),), (None,), (7.0,), (-7.0,)], "x double")
    assert check_frame(nan, [Check("between", "x", low=-7, high=7)]).first()["failures"] == 1


def test_drift_stops_above_the_limit_and_keeps_the_evidence(spark, schema, lines_of):
    good, bad = [event(i) for i in range(95)], [f"bad {i}" for i in range(6)]
    at_limit = load_silver(spark, lines_of(good + bad[:5]), f"{schema}.events")
    assert (at_limit.total, at_limit.malformed, at_limit.distribution) == (100, 5, {1: 5})
    assert (at_limit.events, at_limit.table_events) == (95, 95)
    assert spark.table(f"{schema}.events").count() == 95
    with pytest.raises(SchemaDriftError, match="6 of 100"):
        load_silver(spark, lines_of(good[:94] + bad), f"{schema}.other")
    assert spark.table(f"{schema}.other_rejects").count() == 6
    assert not spark.catalog.tableExists(f"{schema}.other")


def test_rejects_are_not_doubled_by_a_rerun(spark, schema, lines_of):
    frame = lines_of([event(i) for i in range(60)] + ["bad", "bad"])
    for _ in range(2):
        load_silver(spark, frame, f"{schema}.events")
    held = spark.table(f"{schema}.events_rejects")
    assert held.columns == [
        "_raw_line", "_field_count", "_expected_count", "_source_file", "_quarantined_at", "_file_day",
    ]
    assert held.count() == 2


def test_empty_batch_and_error_check_write_nothing(spark, schema, lines_of):
    assert load_silver(spark, lines_of([]), f"{schema}.events").total == 0
    with pytest.raises(QualityError):
        load_silver(spark, lines_of([event(1, quad_class=9)]), f"{schema}.events")
    assert not spark.catalog.tableExists(f"{schema}.events")
