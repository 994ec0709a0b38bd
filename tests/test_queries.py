"""Every registered query against its SQL, as the driver does it."""

from __future__ import annotations

import duckdb
import pytest
from helpers import SF

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare
from millrace.feed import feed_lines
from millrace.operators.lines import (
    conformant,
    field_count_distribution,
    malformed_rate,
    with_fields,
)
from millrace.operators.silver import to_silver, type_lines
from millrace.oracle import ORACLE
from millrace.queries import QUERIES


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    problems, _ = compare(spark, oracle, name, SF)
    assert problems == []


def test_entry(spark):
    got = {r.quad_class: r.event_count for r in entry(spark).collect()}
    assert set(got) == {1, 2, 3, 4}


def test_feed_has_the_planned_faults(spark):
    """Counts that were worked out for this feed beforehand, at the scale they are for."""
    feed = feed_lines(spark, "/root/testdata/sf0.01").persist()
    spread = {r._field_count: r.line_count for r in field_count_distribution(feed).collect()}
    assert spread == {60: 114, 61: 10763, 62: 123}
    assert malformed_rate(field_count_distribution(feed)).first().malformed == 237
    typed = type_lines(conformant(feed))
    assert typed.filter("global_event_id is null").count() == 137
    assert to_silver(conformant(feed)).count() == 9660
    texts = with_fields(conformant(feed)).filter("_fields[31] = '1.5'")
    assert texts.count() == 153
    assert typed.filter("date_added is null").count() == 0
    feed.unpersist()
