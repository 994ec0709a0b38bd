from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from helpers import event_line
from pyspark.sql import functions as F

from millrace.contract import EVENTS
from millrace.operators.compaction import compact, partition_files
from millrace.operators.upsert import delete_insert, upsert
from millrace.plans.load_silver import load_silver
from millrace.plans.maintain import maintain_silver
from millrace.sources import tables
from millrace.sources.tables import (
    add_columns,
    balanced,
    create_table,
    location_of,
    merge_newest,
    named_source,
    provider_of,
    read_reference_csv,
    rebuild,
    replace_by_key,
    rows_near,
)

D1, D2, D3 = dt.date(2026, 7, 1), dt.date(2026, 7, 2), dt.date(2026, 7, 3)
DDL = "k bigint, r int, v string, day date"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def target(spark, schema):
    name = f"{schema}.t"
    create_table(spark, name, DDL, "day")
    start = [(1, 5, "t1", D1), (2, 5, "t2", D1), (3, None, "t3", D1), (4, 5, "t4", D2), (9, 1, "t9", D3)]
    spark.createDataFrame(start, DDL).write.insertInto(name)
    return name


def test_upsert_guard_with_all_null_cases(spark):
    old = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 5), (9, 1)], "k int, r int")
    new = spark.createDataFrame([(1, 5), (2, 4), (3, 7), (4, None), (5, None)], "k int, r int")
    old, new = old.withColumn("side", F.lit("t")), new.withColumn("side", F.lit("s"))
    assert rows_of(upsert(old, new, "k", "r").select("k", "side")) == [
        (1, "s"), (2, "t"), (3, "t"), (4, "t"), (5, "s"), (9, "t"),
    ]
    assert rows_of(upsert(old, new, "k").select("k", "side")) == [
        (1, "s"), (2, "s"), (3, "s"), (4, "s"), (5, "s"), (9, "t"),
    ]


def test_rows_without_key_match_nothing(spark):
    old = spark.createDataFrame([(None, 1), (1, 1)], "k int, r int")
    new = spark.createDataFrame([(None, 2), (1, 2)], "k int, r int")
    assert rows_of(upsert(old, new, "k", "r")) == [(1, 2), (None, 1), (None, 2)]
    assert rows_of(delete_insert(old, new, "k")) == [(1, 2), (None, 1), (None, 2)]


def test_merge_rewrites_only_touched_days(spark, target):
    untouched = partition_files(spark, location_of(spark, target), "day")
    batch = spark.createDataFrame([(1, 6, "s1", D1), (5, 1, "s5", D2)], DDL)
    before = {r._file for r in _files(spark, target, D3)}
    merge_newest(spark, target, batch, "k", "r", "day")
    assert rows_of(spark.table(target).select("k", "v")) == [
        (1, "s1"), (2, "t2"), (3, "t3"), (4, "t4"), (5, "s5"), (9, "t9"),
    ]
    assert {r._file for r in _files(spark, target, D3)} == before
    assert untouched is not None


def _files(spark, table, day):
    rows = spark.table(table).filter(F.col("day") == F.lit(day))
    return rows.select(F.col("_metadata.file_path").alias("_file")).distinct().collect()


def test_row_that_moves_leaves_no_copy(spark, target):
    batch = spark.createDataFrame([(9, 2, "moved", D1)], DDL)
    merge_newest(spark, target, batch, "k", "r", "day")
    assert rows_of(spark.table(target).filter("k = 9").select("v", "day")) == [("moved", D1)]
    assert spark.table(target).filter(F.col("day") == F.lit(D3)).count() == 0
    assert spark.table(target).count() == 5


def test_row_that_swaps_days_with_another(spark, target):
    batch = spark.createDataFrame([(9, 2, "a", D2), (4, 6, "b", D3)], DDL)
    merge_newest(spark, target, batch, "k", "r", "day")
    assert rows_of(spark.table(target).filter("k in (4, 9)").select("k", "day")) == [
        (4, D3), (9, D2),
    ]


def test_late_row_stays_where_it_was(spark, target):
    """An older batch row for another day neither moves the row nor adds one."""
    batch = spark.createDataFrame([(9, 0, "late", D2)], DDL)
    merge_newest(spark, target, batch, "k", "r", "day")
    assert rows_of(spark.table(target).filter("k = 9").select("v", "day")) == [("t9", D3)]
    assert spark.table(target).count() == 5


def test_merge_is_healed_by_a_rerun_after_a_crash(spark, target):
    """The run died after the emptied day was dropped and before the overwrite."""
    batch = spark.createDataFrame([(9, 2, "moved", D1)], DDL)
    spark.sql(f"ALTER TABLE {target} DROP PARTITION (day = '{D3}')")
    for _ in range(2):
        merge_newest(spark, target, batch, "k", "r", "day")
        assert rows_of(spark.table(target).filter("k = 9").select("v", "day")) == [("moved", D1)]
        assert spark.table(target).count() == 5


def test_null_day_is_a_partition_like_others(spark, target):
    batch = spark.createDataFrame([(7, 1, "s7", None), (1, 9, "s1", None)], DDL)
    merge_newest(spark, target, batch, "k", "r", "day")
    assert rows_of(spark.table(target).filter("day is null").select("k")) == [(1,), (7,)]
    back = spark.createDataFrame([(7, 2, "b7", D2), (1, 10, "b1", D2)], DDL)
    merge_newest(spark, target, back, "k", "r", "day")
    assert spark.table(target).filter("day is null").count() == 0
    assert spark.table(target).count() == 6


def test_empty_batch_changes_nothing(spark, target):
    before = rows_of(spark.table(target))
    merge_newest(spark, target, spark.createDataFrame([], DDL), "k", "r", "day")
    assert rows_of(spark.table(target)) == before


def test_replace_by_key_deletes_and_inserts(spark, target):
    batch = spark.createDataFrame([(2, 0, "s2", D2), (6, 0, "s6", D1)], DDL)
    replace_by_key(spark, target, batch, "k", "day")
    assert rows_of(spark.table(target).filter("k in (2, 6)").select("k", "v", "day")) == [
        (2, "s2", D2), (6, "s6", D1),
    ]
    assert spark.table(target).count() == 6


def test_silver_load_twice_keeps_contract_columns(spark, schema, lines_of):
    lines = lines_of(
        event_line(global_event_id=i, sql_date=f"202607{i % 28 + 1:02}", quad_class=1,
                   date_added="20260724120000", actor1_name=f"n{i}")
        for i in range(200)
    )
    name = f"{schema}.events"
    load_silver(spark, lines, name)
    contract = sorted(EVENTS.names)
    first = rows_of(spark.table(name).select(*contract))
    load_silver(spark, lines, name)
    assert rows_of(spark.table(name).select(*contract)) == first
    assert spark.table(name).columns[-1] == "sql_date"


def test_a_wider_contract_loads_into_the_same_table(spark, schema, lines_of):
    def line(key, **more):
        return event_line(global_event_id=key, sql_date="20250318", quad_class=1, date_added="20250318064500", **more)

    load_silver(spark, lines_of([line(1), line(2)]), f"{schema}.events")
    wide = replace(EVENTS, columns=(*EVENTS.columns, ("tone_source", "string")))
    load_silver(spark, lines_of([line(2) + "\tmodel", line(3) + "\tpanel"]), f"{schema}.events", contract=wide)
    rows = spark.table(f"{schema}.events").collect()
    assert {r.global_event_id: r.tone_source for r in rows} == {1: None, 2: "model", 3: "panel"}


def test_compaction_rewrites_fragmented_days_only(spark, target):
    for i in range(4):
        spark.createDataFrame([(100 + i, 1, "x", D2)], DDL).write.insertInto(target)
    spark.createDataFrame([(200, 1, "x", D3)], DDL).coalesce(1).write.insertInto(
        target, overwrite=False
    )
    spark.sql(f"ALTER TABLE {target} DROP PARTITION (day = '{D1}')")
    single = dt.date(2026, 7, 9)
    spark.createDataFrame([(300, 1, "x", single)], DDL).coalesce(1).write.insertInto(target)
    kept = {r._file for r in _files(spark, target, single)}
    before = rows_of(spark.table(target))
    done = compact(spark, target, "day")
    assert sorted(done) == [D2, D3]
    assert rows_of(spark.table(target)) == before
    assert {r._file for r in _files(spark, target, single)} == kept
    assert len(_files(spark, target, D2)) == 1
    assert maintain_silver(spark, target, partition="day") == []


@pytest.mark.parametrize("advisory", ["1k", "4k", "64m"])
def test_compaction_settles_at_any_advisory_size(spark, target, advisory):
    wide = spark.range(4000).select(
        F.col("id").alias("k"), F.lit(1).alias("r"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(D1).alias("day")
    )
    for _ in range(3):
        wide.write.mode("append").insertInto(target)
    before = spark.table(target).count()
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    try:
        assert compact(spark, target, "day", target_bytes=200_000)
        assert [compact(spark, target, "day", target_bytes=200_000) for _ in range(2)][-1] == []
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.table(target).count() == before


def test_small_table_helpers(spark, schema, tmp_path):
    (tmp_path / "codes.csv").write_text("event_root_code,label\n01,One\n20,Twenty\n")
    codes = read_reference_csv(spark, str(tmp_path), "event_root_code string, label string")
    assert rows_of(codes) == [("01", "One"), ("20", "Twenty")]
    rebuild(codes, f"{schema}.codes")
    rebuild(codes, f"{schema}.codes")
    assert named_source(spark, "codes", schema).count() == 2
    assert provider_of(spark, f"{schema}.codes") == "parquet"
    add_columns(spark, f"{schema}.codes", "extra int")
    assert spark.table(f"{schema}.codes").filter("extra is null").count() == 2


def _rows_scanned(df):
    """Rows that left the scan, after row groups were ruled out and before the filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.getClass().getName() else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_a_lookup_of_100_keys_reads_as_much_of_a_target_ten_times_larger(spark, schema):
    keys = spark.range(100).select(F.xxhash64("id").alias("k"))
    read = {}
    for files in (4, 40):
        name = f"{schema}.keyed_{files}"
        create_table(spark, name, "k bigint, v string, d int", "d", lookup="k")
        rows = spark.range(files * 2000).select(
            F.xxhash64("id").alias("k"), F.lit("v").alias("v"), F.floor(F.col("id") / 2000).cast("int").alias("d")
        )
        balanced(rows, "d").write.insertInto(name)
        near = rows_near(spark.table(name), keys, "k").select("k", "d")
        assert near.count() == 100
        read[files] = _rows_scanned(near)
    assert read[4] == read[40] == 2000


@pytest.mark.parametrize("most", [0, 1000])
def test_merge_is_the_same_by_key_values_and_by_key_range(spark, schema, monkeypatch, most):
    monkeypatch.setattr(tables, "LOOKUP_KEYS", most)
    name = f"{schema}.merged"
    create_table(spark, name, "k bigint, v string, d int", "d", lookup="k")
    spark.sql(f"insert into {name} values (1, 'a', 1), (2, 'b', 1), (3, 'c', 2), (null, 'n', 2)")
    batch = spark.createDataFrame([(1, "moved", 3), (3, "new", 2), (9, "added", 4)], "k bigint, v string, d int")
    tables.merge_partitions(spark, name, batch.persist(), "k", "d")
    assert {tuple(r) for r in spark.table(name).collect()} == {
        (1, "moved", 3), (2, "b", 1), (3, "new", 2), (None, "n", 2), (9, "added", 4)
    }
    assert tables.merge_partitions(spark, name, batch.limit(0), "k", "d") == []
