"""The plans that make the difference at scale."""

from __future__ import annotations

import pytest
from helpers import SF
from pyspark.sql import functions as F

from millrace.feed import bronze_lines, silver_events
from millrace.operators import quality, silver, star
from millrace.operators.lines import conformant
from millrace.operators.upsert import upsert_parts
from millrace.plans.build_gold import load_fact
from millrace.session import scratch_root
from millrace.sources.tables import rebuild


def plan_of(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    kind = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(kind)


@pytest.fixture
def staged(spark):
    return star.stage_events(silver_events(spark, SF))


def test_newest_line_is_found_before_and_after_the_one_shuffle(spark):
    plan = plan_of(silver.to_silver(conformant(bronze_lines(spark, SF))), "simple")
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_uniqueness_needs_no_further_shuffle_by_key(spark):
    events = silver.to_silver(conformant(bronze_lines(spark, SF)))
    plan = plan_of(quality.check_frame(events), "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange SinglePartition") == 1


def test_fact_limit_reaches_the_scan_and_needs_no_shuffle(staged):
    plan = plan_of(star.fact_events(staged))
    assert "GreaterThan(date_added,1900-01-01" in plan
    assert "Exchange" not in plan
    assert "actor1_name" not in plan


def test_dimensions_read_only_their_columns(staged):
    assert "ReadSchema: struct<>" in plan_of(star.dim_date(staged))
    actors = plan_of(star.actor_attributes(staged))
    assert actors.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "HashAggregate" in actors
    assert "source_url" not in actors


def test_event_roots_are_broadcast_by_their_known_size(spark, staged):
    plan = plan_of(star.dim_cameo_event(staged, star.event_roots(spark)))
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan


def test_small_batch_leaves_the_target_unshuffled(spark):
    target = silver_events(spark, SF)
    path = f"{scratch_root(spark)}/plan-batch"
    target.filter(F.col("quad_class") == 4).write.mode("overwrite").parquet(path)
    kept, _ = upsert_parts(target, spark.read.parquet(path), "global_event_id", "date_added")
    plan = plan_of(kept, "simple")
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_a_large_batch_is_joined_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = silver_events(spark, SF)
        batch = target.withColumn("avg_tone", F.lit(0.5))
        kept, taken = upsert_parts(target, batch, "global_event_id", "date_added")
        assert "SortMergeJoin" in plan_of(kept, "simple")
        assert (kept.count(), taken.count()) == (0, target.count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_days_of_a_filtered_dimension_prune_the_fact(spark, staged, schema):
    load_fact(spark, staged, f"{schema}.fact")
    rebuild(star.dim_date(staged), f"{schema}.dates")
    dates = spark.table(f"{schema}.dates").filter("day_of_month <= 7")
    plan = plan_of(star.on_days(spark.table(f"{schema}.fact"), dates))
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "date_key" in line)
    assert "dynamicpruning" in scan
    all_days = star.fact_events(staged).join(star.dim_date(staged).filter("day_of_month <= 7").select("date_key"), "date_key")
    assert star.on_days(spark.table(f"{schema}.fact"), dates).count() == all_days.count()
