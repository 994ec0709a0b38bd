from __future__ import annotations

import pytest
from helpers import SF

from millrace import feed
from millrace.operators.lines import conformant
from millrace.operators.silver import to_silver


@pytest.fixture
def unlanded(monkeypatch):
    """Landed tables of this test only."""
    monkeypatch.setattr(feed, "_LANDED", {})


def test_lines_are_narrow_when_brought_to_their_day(spark, unlanded, monkeypatch):
    below, landed = {}, feed.landed

    def watched(session, sf_dir, step, build, partition=None):
        plan = build()._jdf.queryExecution().optimizedPlan().toString()
        below[step] = plan.partition("RebalancePartitions")[2]
        return landed(session, sf_dir, step, build, partition)

    monkeypatch.setattr(feed, "landed", watched)
    got = feed.silver_events(spark, SF)
    assert "_raw_line" in below["silver"] and "actor1_name" not in below["silver"]
    want = to_silver(conformant(feed.bronze_lines(spark, SF))).drop("_ingested_at")
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == want.count()


def test_partitioned_landing_does_not_sort(spark, unlanded):
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []

    def build():
        seen.append(int(spark.conf.get(key)))
        return spark.range(1000).selectExpr("id", "cast(id % 200 as int) as part")

    before = spark.conf.get(key)
    out = feed.landed(spark, SF, "many-parts", build, "part")  # more folders than files may be open
    assert seen[0] > 0 and spark.conf.get(key) == before
    assert out.distinct().count() == 1000 and out.where("part = 7").count() == 5
