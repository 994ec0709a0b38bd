"""Silver table to the star schema, with tests on the finished tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import EVENT_ROOT_SCHEMA
from millrace.functions.instants import instant, micros
from millrace.operators import star
from millrace.operators.history import advance_history, open_versions
from millrace.operators.integrity import duplicates, nulls, orphans, unaccepted
from millrace.session import tune
from millrace.sources.tables import (
    create_table,
    named_source,
    overwrite_partitions,
    read_reference_csv,
    rebuild,
    replace_by_key,
)

FACT_PARTITION = "date_key"
HISTORY_PARTITION = "ended_on"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def load_fact(
    spark: SparkSession,
    staged: DataFrame,
    table: str,
    full_refresh: bool = False,
    lookback: timedelta = timedelta(0),
) -> None:
    """Add events newer than the newest loaded so far; re-published ones replace their row.

    The fact is partitioned by day, so a load rewrites the days it touches and not the table. The
    batch is written as a table first and read from there by every step, the mark included: an event
    that arrives during the load is left to the next one. The mark is kept in a table of its own,
    ``<table>_mark``, as microseconds: the fact is not read for it, and it never becomes a local time
    of the driver. It is written last; a load that dies before is repeated by the next. ``lookback``
    lowers the limit for late files; a full refresh is built beside the table and takes its place
    when complete.
    """
    if full_refresh and spark.catalog.tableExists(table):
        fresh = f"{table}_fresh"
        for name in (fresh, f"{fresh}_mark"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        load_fact(spark, staged, fresh)
        for old, new in ((f"{table}_mark", f"{fresh}_mark"), (table, fresh)):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
            spark.sql(f"ALTER TABLE {new} RENAME TO {old}")
        return
    mark = f"{table}_mark"
    create_table(spark, table, _ddl(star.fact_events(staged)), FACT_PARTITION, lookup="event_key")
    create_table(spark, mark, "loaded_micros bigint")
    loaded = spark.table(mark).agg(F.max("loaded_micros")).first()[0]
    if loaded is None:  # a fact from before there was a mark, or none
        loaded = star.high_water(spark.table(table)).select(F.unix_micros("loaded_until")).first()[0]
    since = max(loaded - lookback // timedelta(microseconds=1), micros(star.FLOOR))
    rebuild(star.fact_events(staged, F.timestamp_micros(F.lit(since))), f"{table}_batch")
    try:
        batch = spark.table(f"{table}_batch")
        replace_by_key(spark, table, batch, "event_key", FACT_PARTITION)
        newest = batch.agg(F.unix_micros(F.max("date_added")).alias("m")).first()["m"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}_batch")
    if newest is not None and newest > loaded:
        spark.createDataFrame([(newest,)], "loaded_micros bigint").write.insertInto(mark, overwrite=True)


def open_actors(spark: SparkSession, table: str) -> DataFrame:
    """The versions of the actor history that have no end: one partition, the others are not read."""
    return spark.table(table).filter(F.col(HISTORY_PARTITION).isNull())


def snapshot_actors(
    spark: SparkSession, attributes: DataFrame, table: str, as_of: datetime
) -> None:
    """Advance the actor history: the open part is read and replaced, closed versions are added.

    Closed versions are partitioned by the day they ended, so a snapshot never reads the years
    before. What it does read of them are the days since the last complete snapshot, kept in
    ``<table>_mark`` and written last: a run that died in between left its closed versions there.
    """
    moment = instant(as_of)
    shape = open_versions(attributes, moment).withColumn(HISTORY_PARTITION, F.to_date("valid_to"))
    create_table(spark, table, _ddl(shape), HISTORY_PARTITION)
    create_table(spark, f"{table}_mark", "snapshot_day date")
    day = F.to_date(moment)
    done = spark.table(f"{table}_mark").agg(F.max("snapshot_day")).first()[0]
    moved = advance_history(open_actors(spark, table).drop(HISTORY_PARTITION), attributes, moment)
    moved = moved.withColumn(HISTORY_PARTITION, F.to_date("valid_to"))
    columns = spark.table(table).columns
    version = ["actor_code", "valid_from"]
    known = spark.table(table).filter(F.col(HISTORY_PARTITION).isNotNull())
    if done is not None:
        known = known.filter(F.col(HISTORY_PARTITION) >= F.lit(done))
    closed = moved.filter(F.col(HISTORY_PARTITION).isNotNull())
    closed = closed.join(known.select(*version), version, "left_anti").select(*columns)
    closed.write.mode("append").insertInto(table)
    overwrite_partitions(moved.filter(F.col(HISTORY_PARTITION).isNull()), table)
    spark.range(1).select(day.alias("snapshot_day")).write.insertInto(f"{table}_mark", overwrite=True)


def build_gold(
    spark: SparkSession,
    silver: str,
    schema: str,
    as_of: datetime,
    full_refresh: bool = False,
    seed: str | None = None,
) -> dict[str, int]:
    """Build every gold table from the silver table and test them; returns failures.

    ``seed`` is a CSV file, or a folder of some, with header and the columns of
    ``EVENT_ROOT_SCHEMA``; it becomes the table ``event_roots``. Without it the built-in roots are used.

    Names of the tables: ``int_actor_attributes``, ``snap_dim_actor``, ``dim_actor``,
    ``dim_date``, ``dim_geography``, ``dim_cameo_event``, ``fact_events``.
    """
    tune(spark)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {schema}")
    staged = star.stage_events(named_source(spark, silver))
    staged.createOrReplaceTempView("stg_events")

    def at(name: str) -> str:
        return f"{schema}.{name}"

    rebuild(star.actor_attributes(staged), at("int_actor_attributes"))
    snapshot_actors(
        spark, spark.table(at("int_actor_attributes")), at("snap_dim_actor"), as_of
    )
    rebuild(star.dim_actor(open_actors(spark, at("snap_dim_actor"))), at("dim_actor"))
    rebuild(star.dim_date(staged), at("dim_date"))
    rebuild(star.dim_geography(staged), at("dim_geography"))
    roots = star.event_roots(spark)
    if seed is not None:
        rebuild(read_reference_csv(spark, seed, EVENT_ROOT_SCHEMA), at("event_roots"))
        roots = named_source(spark, "event_roots", schema)
    rebuild(star.dim_cameo_event(staged, roots), at("dim_cameo_event"))
    load_fact(spark, staged, at("fact_events"), full_refresh)
    return run_gold_tests(spark, silver, schema)


def gold_tests(spark: SparkSession, silver: str, schema: str) -> dict[str, DataFrame]:
    """The failing rows of every test on source and gold tables, by test name."""
    tables = {
        name: spark.table(f"{schema}.{name}")
        for name in ("dim_date", "dim_actor", "dim_geography", "dim_cameo_event", "fact_events")
    }
    tables["events"] = spark.table(silver)
    # --- fixed values: keys, required columns, references between the tables ---
    keys = [
        ("events", "global_event_id"),
        ("dim_date", "date_key"),
        ("dim_actor", "actor_key"),
        ("dim_geography", "geo_key"),
        ("dim_cameo_event", "cameo_key"),
        ("fact_events", "event_key"),
    ]
    references = [
        ("date_key", "dim_date", "date_key"),
        ("actor1_key", "dim_actor", "actor_key"),
        ("actor2_key", "dim_actor", "actor_key"),
        ("action_geo_key", "dim_geography", "geo_key"),
        ("cameo_key", "dim_cameo_event", "cameo_key"),
    ]
    tests = {f"unique_{t}_{c}": duplicates(tables[t], c) for t, c in keys}
    tests |= {f"not_null_{t}_{c}": nulls(tables[t], c) for t, c in keys}
    tests["not_null_dim_actor_actor_code"] = nulls(tables["dim_actor"], "actor_code")
    tests["accepted_values_dim_cameo_event_quad_class"] = unaccepted(
        tables["dim_cameo_event"], "quad_class", (1, 2, 3, 4)
    )
    for column, parent, parent_column in references:
        tests[f"relationships_fact_events_{column}"] = orphans(
            tables["fact_events"], column, tables[parent], parent_column
        )
    return tests


def run_gold_tests(spark: SparkSession, silver: str, schema: str) -> dict[str, int]:
    """Number of failing values per test; 0 is a pass."""
    return {name: df.count() for name, df in gold_tests(spark, silver, schema).items()}
