"""One query per operator group over the test tables; ``oracle.py`` holds the SQL for each.

Inputs are whole tables. Planted faults are part of the inputs (see ``feed.py`` and the SQL
texts here, which both engines run); what is under test is written once with this package
and once in plain SQL.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.feed import bronze_days, bronze_lines, landed, silver_events, table
from millrace.operators import history, integrity, lines, quality, silver, star, upsert
from millrace.operators.compaction import compact
from millrace.plans.build_gold import build_gold, load_fact, snapshot_actors
from millrace.plans.land import land
from millrace.plans.load_silver import load_silver
from millrace.session import scratch_root, tune
from millrace.sources import archive_source, manifest, tables, topics
from millrace.sources.archives import ANY_ARCHIVE
from millrace.sources.places import place
from millrace.sources.topic_sink import start_sink
from millrace.streaming import gate as gating
from millrace.streaming.events import stream_events, to_messages
from millrace.streaming.order import sequenced
from millrace.streaming.run import gate_stats, run_gate

# the second batch of the two-batch scenarios starts here
SPLIT_FILE = "20240115000000.export.CSV.zip"
SPLIT_DAY = date(2024, 1, 15)
FIRST_SNAPSHOT = datetime(2024, 1, 10)
SECOND_SNAPSHOT = datetime(2024, 1, 20)

WINDOW_START = datetime(2024, 1, 5)
WINDOW_END = datetime(2024, 1, 20)

# archives of these hours are written badly on purpose
CUT_OFF_HOUR, WRONG_SUM_HOUR, TWICE_HOUR = "03", "05", "09"

FEED_STATE = [
    ("export", datetime(2024, 1, 10)),
    ("mentions", datetime(2030, 1, 1)),
    ("other", datetime(2020, 1, 1)),
]

# index lines with every fault a line can have, one line per event
INDEX_SQL = """
select case event_id % 50
    when 1 then concat('17 ', md5(cast(event_id as string)))
    when 2 then concat('1 2 3 ', address)
    when 3 then concat('17 ', md5(cast(event_id as string)), ' http://h/none.txt')
    when 4 then concat('many ', md5(cast(event_id as string)), ' ', address)
    when 5 then concat('17 ', md5(cast(event_id as string)),
      ' http://h/20241345000000.export.CSV.zip')
    when 6 then concat('  17', chr(9), md5(cast(event_id as string)), '   ', address, ' ')
    else concat(cast(1000 + event_id as string), ' ', md5(cast(event_id as string)), ' ', address)
  end as value
from (
  select event_id, concat('http://h/',
    substr(replace(replace(replace(cast(ts as string), '-', ''), ':', ''), ' ', ''), 1, 14),
    case event_id % 4 when 0 then '.export.CSV.zip' when 1 then '.mentions.CSV.zip'
      when 2 then '.gkg.csv.zip' else '.EXPORT.CSV.zip' end) as address
  from {events}
) addressed
"""

# files with their checksums as published: right, wrong or none
FILES_SQL = """
select concat('doc-', cast(doc_id as string), '.txt') as file_name, source as feed, text,
  case when doc_id % 11 = 0 then md5(concat(text, '.')) when doc_id % 13 = 0 then ''
    else md5(text) end as md5,
  lang = 'en' as known
from {documents}
"""

# a batch for the orders table: matched rows (newer, equal, older, undated) and new rows
ORDERS_BATCH_SQL = """
select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice + 1 as o_totalprice,
  case o_orderkey % 5 when 0 then o_orderdate + interval '1' day when 1 then o_orderdate
    when 2 then o_orderdate - interval '1' day when 3 then cast(null as timestamp)
    else o_orderdate + interval '1' hour end as o_orderdate, o_orderpriority
from {orders} where o_orderstatus = 'F'
union all
select -1 - o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
from {orders} where o_orderstatus = 'P'
"""

# stream messages with every fault the gate knows
MESSAGES_SQL = """
select cast(event_id as string) as message_key,
  case event_id % 29
    when 1 then '{{bad' when 2 then '[1]' when 3 then '5' when 4 then 'null' when 5 then ''
    when 6 then cast(null as string)
    when 7 then replace(good, '"goldstein_scale":', '"goldstein_scale":"x","was":')
    when 8 then replace(good, '"avg_tone":', '"avg_tone":-250.5,"was":')
    when 9 then replace(good, '"action_lat":', '"action_lat":100,"was":')
    when 10 then replace(good, '"action_long":', '"action_long":-180.5,"was":')
    when 11 then replace(good, '"event_day":', '"event_day":"","was":')
    when 12 then replace(good, '"global_event_id":', '"global_event_id":null,"was":')
    when 13 then replace(good, '"quad_class":', '"quad_class":9,"was":')
    when 14 then '{{}}' when 15 then concat(good, ' x')
    when 16 then replace(good, '"num_mentions":', '"num_mentions":null,"was":')
    else good end as body
from (
  select event_id, concat('{{"global_event_id":', cast(event_id as string),
    ',"event_day":"2024-01-01","quad_class":', cast(event_id % 4 + 1 as string),
    ',"goldstein_scale":', cast(event_id % 23 - 11 as string),
    ',"num_mentions":', cast(event_id % 25 as string),
    ',"avg_tone":', cast(event_id % 200 - 99 as string),
    ',"action_lat":', cast(user_id % 90 as string),
    ',"action_long":', cast(-(user_id % 180) as string), '}}') as good
  from {events}
) well_formed
"""


def _sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in names})


def _at(moment: datetime) -> Column:
    """A time stamp of the session's own clock, whatever its time zone."""
    return F.lit(str(moment)).cast("timestamp")


def _plain_time(df: DataFrame) -> DataFrame:
    """Time stamps without zone, as the oracle has them."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


# --- inputs shared by the queries -------------------------------------------------------


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.parse_index(_sql(spark, sf_dir, INDEX_SQL, "events"))


def _conformant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.conformant(bronze_lines(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, batch: str = "all") -> DataFrame:
    """Silver of the whole feed, of the files before the split, or of those after it."""
    if batch == "all":
        return silver_events(spark, sf_dir)
    before = F.col("_source_file") < SPLIT_FILE
    rows = _conformant(spark, sf_dir).filter(before if batch == "first" else ~before)
    return silver.to_silver(rows).drop("_ingested_at")


def _staged(spark: SparkSession, sf_dir: str, batch: str = "all") -> DataFrame:
    return star.stage_events(_silver(spark, sf_dir, batch))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_events(_staged(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actor history after a snapshot of each batch, as a landed table."""
    return landed(spark, sf_dir, "actor-history", lambda: _two_snapshots(spark, sf_dir))


def land_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed actor history, for a bench that times landing apart."""
    return _history(spark, sf_dir)


def _two_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = star.actor_attributes(_staged(spark, sf_dir, "first"))
    second = star.actor_attributes(_staged(spark, sf_dir, "second"))
    start = history.open_versions(first, _at(FIRST_SNAPSHOT))
    return history.advance_history(start, second, _at(SECOND_SNAPSHOT))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, MESSAGES_SQL, "events").select(
        F.col("message_key").cast("binary").alias("key"),
        F.col("body").cast("binary").alias("value"),
    )


def _scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/millrace-{uuid.uuid4().hex}"


def _scratch_schema(spark: SparkSession) -> str:
    """A schema of its own for a query that changes tables."""
    schema = f"millrace_{uuid.uuid4().hex}"
    spark.sql(f"CREATE NAMESPACE {schema} LOCATION '{scratch_root(spark)}/{schema}'")
    return schema


# --- landing ----------------------------------------------------------------------------


# the feed as members of archives: bad bytes, blank lines, a second member, an archive without any
ARCHIVE_ROWS_SQL = """
select _source_file, '1.CSV' as member, encode(_raw_line, 'UTF-8') as line from {feed}
  where length(_raw_line) % 7 <> 0
union all
select _source_file, '1.CSV', concat(encode(_raw_line, 'UTF-8'), unhex('FF0D')) from {feed}
  where length(_raw_line) % 7 = 0
union all
select distinct _source_file, '1.CSV', encode('  ', 'UTF-8') from {feed}
union all
select distinct _source_file, '2.CSV', encode('not a line', 'UTF-8') from {feed}
union all
select '20240131999999.export.CSV.zip', cast(null as string), cast(null as binary)
"""


def _archives(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    feed = bronze_lines(spark, sf_dir)
    return spark.sql(ARCHIVE_ROWS_SQL, feed=feed if where is None else feed.filter(where))


def _written(rows: DataFrame, folder: str) -> DataFrame:
    """Archives of ``rows`` in ``folder``, and what is known of them as a table."""
    known = archive_source.write_archives(rows, folder)
    spark = rows.sparkSession
    path = f"{_scratch(spark)}-written"
    known.write.parquet(path)
    return spark.read.schema(archive_source.WRITTEN).parquet(path)


def _copies(files: DataFrame, folder: str, share: float = 1.0) -> DataFrame:
    """The first ``share`` of each archive put into another folder, by tasks; their sizes and digests."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                system, root = place(folder)
                system.create_dir(root, recursive=True)
                name, part = path.rsplit("/", 1)[-1], content[: int(len(content) * share)]
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write(part)
                columns = [pa.array([name]), pa.array([len(part)]), pa.array([hashlib.md5(part).hexdigest()])]
                yield pa.record_batch(columns, ["_source_file", "size", "digest"])

    spark = files.sparkSession
    path = f"{_scratch(spark)}-copied"
    files.select("path", "content").mapInArrow(put, archive_source.WRITTEN).write.parquet(path)
    return spark.read.schema(archive_source.WRITTEN).parquet(path)


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as archives and read back from the split on, past a damaged one before it."""
    folder = f"{_scratch(spark)}/archives"
    _written(_archives(spark, sf_dir), folder)
    system, root = place(folder)
    with system.open_output_stream(f"{root}/00000000000000.export.CSV.zip") as damaged:
        damaged.write(b"no archive")
    return archive_source.scan(spark, folder, first=SPLIT_FILE)


def archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by archive after three runs of one checkpoint, with archives added after the first."""
    home = _scratch(spark)
    early = F.col("_source_file") < SPLIT_FILE
    for batch in (early, ~early, F.lit(False)):
        _written(_archives(spark, sf_dir, batch), f"{home}/drop")
        lines = archive_source.scan_stream(spark, f"{home}/drop", settle=0)
        run = lines.writeStream.format("parquet").option("checkpointLocation", f"{home}/state")
        query = run.trigger(availableNow=True).start(f"{home}/lines")
        query.awaitTermination()
    held = spark.read.schema(archive_source.LINES).parquet(f"{home}/lines")
    return held.groupBy("_source_file").agg(F.count(F.lit(1)).alias("line_count"))


def landing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines, with the tallies of two runs over good archives and three kinds of bad ones."""
    home, name = _scratch(spark), F.col("_source_file")
    hour = F.substring(name, 9, 2)
    feed = _archives(spark, sf_dir).filter("member IS NOT NULL")
    whole = _written(feed.filter(hour != CUT_OFF_HOUR), f"{home}/drop/whole")
    _written(feed.filter(hour == CUT_OFF_HOUR), f"{home}/apart")
    binary = spark.read.format("binaryFile").option("pathGlobFilter", ANY_ARCHIVE)
    cut = _copies(binary.load(f"{home}/apart"), f"{home}/drop/cut", 0.7)
    twice = binary.load(f"{home}/drop/whole").filter(F.col("path").rlike(f"/[0-9]{{8}}{TWICE_HOUR}[^/]*$"))
    _copies(twice, f"{home}/drop/twice")
    said = F.when(hour == WRONG_SUM_HOUR, F.md5(name.cast("binary"))).otherwise(F.col("digest"))
    line = F.concat_ws(" ", F.col("size").cast("string"), said, F.concat(F.lit("http://h/"), name))
    index = manifest.parse_index(whole.unionByName(cut).select(line.alias("value")))
    schema = _scratch_schema(spark)
    runs = [land(spark, index, f"{home}/drop/*", f"{schema}.lines", f"{schema}.marks") for _ in range(2)]
    tallies = [F.lit("/".join(str(run[k]) for k in ("landed", "skipped", "failed"))) for run in runs]
    landed_lines = spark.table(f"{schema}.lines")
    return landed_lines.withColumns({"first_run": tallies[0], "second_run": tallies[1]})


def index_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_manifest(spark, sf_dir))


def index_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = manifest.of_feeds(_manifest(spark, sf_dir), ["export", "gkg"])
    files = manifest.in_window(files, _at(WINDOW_START), _at(WINDOW_END))
    return _plain_time(manifest.oldest_first(files))


def index_not_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _manifest(spark, sf_dir)
    landed = files.filter(F.col("file_ts") < _at(WINDOW_START))
    return _plain_time(manifest.not_landed(files, landed).select(*files.columns))


def _outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _sql(spark, sf_dir, FILES_SQL, "documents")
    published = files.select("feed", "file_name", "md5")
    stored = files.select(
        F.concat(F.lit("/drop/"), "file_name").alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    landed = files.filter("known")
    return manifest.verify(published, manifest.checksums(stored), landed)


def checksum_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcome(spark, sf_dir)


def landing_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tally(_outcome(spark, sf_dir))


def feed_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = [(feed, str(moment)) for feed, moment in FEED_STATE]
    state = spark.createDataFrame(held, "feed string, ts string").select(
        "feed", F.col("ts").cast("timestamp").alias("ts")
    )
    return _plain_time(manifest.advance_state(state, _manifest(spark, sf_dir)))


def newest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the newest file; its day is a literal, so other days are not scanned."""
    days = bronze_days(spark, sf_dir)
    newest = days.agg(F.max("dt")).first()[0]
    return manifest.newest_batch(days.filter(F.col("dt") == F.lit(newest)).drop("dt"), "_source_file")


def day_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver rows of one landed day, as a rerun of that day works them out."""
    lines_of_day = bronze_days(spark, sf_dir).filter(F.col("dt") == F.lit(SPLIT_DAY)).drop("dt")
    typed = silver.to_silver(lines.conformant(lines_of_day)).drop("_ingested_at")
    return _plain_time(typed)


def contract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.raw_frame(bronze_lines(spark, sf_dir))


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.rejects(bronze_lines(spark, sf_dir))


def reject_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.field_count_distribution(lines.rejects(bronze_lines(spark, sf_dir)))


def malformed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.malformed_rate(lines.field_count_distribution(bronze_lines(spark, sf_dir)))


def typed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(silver.type_lines(_conformant(spark, sf_dir)))


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = silver.to_silver(_conformant(spark, sf_dir))
    return _plain_time(newest.drop("_ingested_at"))


def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_frame(_silver(spark, sf_dir))


def quality_suite_before_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_frame(silver.type_lines(_conformant(spark, sf_dir)))


def silver_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table after loading the two batches one after the other."""
    name = f"{_scratch_schema(spark)}.events"
    feed = bronze_lines(spark, sf_dir)
    for batch in (F.col("_source_file") < SPLIT_FILE, F.col("_source_file") >= SPLIT_FILE):
        load_silver(spark, feed.filter(batch), name, keep_lines=False)
    return _plain_time(spark.table(name).drop("_ingested_at"))


def archives_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table after a load from archives under a folder, before and after more of them came."""
    name, folder = f"{_scratch_schema(spark)}.events", f"{_scratch(spark)}/archives"
    feed = bronze_lines(spark, sf_dir).select(
        "_source_file", F.lit("1.CSV").alias("member"), F.encode("_raw_line", "UTF-8").alias("line")
    )
    for first, part in ((None, F.col("_source_file") < SPLIT_FILE), (SPLIT_FILE, F.col("_source_file") >= SPLIT_FILE)):
        _written(feed.filter(part), folder)
        load_silver(spark, archive_source.scan(spark, folder, first=first), name)
    return _plain_time(spark.table(name).drop("_ingested_at"))


def rejects_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine after the same lines were loaded twice."""
    name = f"{_scratch_schema(spark)}.events_rejects"
    feed = bronze_lines(spark, sf_dir)
    for _ in range(2):
        tables.replace_rejects(lines.rejects(feed), feed, name)
    return spark.table(name).drop("_quarantined_at", "_file_day")


def upsert_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    batch = _sql(spark, sf_dir, ORDERS_BATCH_SQL, "orders")
    return _plain_time(upsert.upsert(orders, batch, "o_orderkey", "o_orderdate"))


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    batch = _sql(spark, sf_dir, ORDERS_BATCH_SQL, "orders")
    return _plain_time(upsert.upsert(orders, batch, "o_orderkey"))


# --- gold -------------------------------------------------------------------------------


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_staged(spark, sf_dir))


def fact_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_fact(spark, sf_dir))


def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact of the first batch, then everything newer than its newest row."""
    loaded = star.fact_events(_staged(spark, sf_dir, "first"))
    limit = star.high_water(loaded).scalar()
    batch = star.fact_events(_staged(spark, sf_dir), limit)
    return _plain_time(upsert.delete_insert(loaded, batch, "event_key"))


def fact_table_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after an incremental load of each batch."""
    name = f"{_scratch_schema(spark)}.fact_events"
    for batch in ("first", "all"):
        load_fact(spark, _staged(spark, sf_dir, batch), name)
    return _plain_time(spark.table(name))


def actor_history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot table after a snapshot of each batch, the second one run twice."""
    name = f"{_scratch_schema(spark)}.snap_dim_actor"
    for batch, moment in (("first", FIRST_SNAPSHOT), ("second", SECOND_SNAPSHOT), ("second", SECOND_SNAPSHOT)):
        snapshot_actors(spark, star.actor_attributes(_staged(spark, sf_dir, batch)), name, moment)
    return _plain_time(spark.table(name).drop("ended_on"))


def actor_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.actor_mentions(_staged(spark, sf_dir))


def actor_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.actor_attributes(_staged(spark, sf_dir))


def actor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_two_snapshots(spark, sf_dir))


def actor_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(star.dim_actor(_history(spark, sf_dir)))


def actor_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _staged(spark, sf_dir).select("global_event_id", "actor1_code", "date_added")
    return _plain_time(
        history.as_of_join(facts, _history(spark, sf_dir), "actor1_code", "date_added")
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(_staged(spark, sf_dir))


def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_geography(_staged(spark, sf_dir))


def dim_cameo_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_cameo_event(_staged(spark, sf_dir), star.event_roots(spark))


def star_rollup_by_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir)
    attributes = star.actor_attributes(staged)
    return star.star_rollup(
        star.fact_events(staged),
        star.dim_date(staged),
        star.dim_actor(history.open_versions(attributes, _at(FIRST_SNAPSHOT))),
        star.dim_geography(staged),
        star.dim_cameo_event(staged, star.event_roots(spark)),
    )


def star_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star rollup of one month's weekends, on the written fact that is partitioned by day."""
    schema, staged = _scratch_schema(spark), _staged(spark, sf_dir)
    load_fact(spark, staged, f"{schema}.fact_events")
    tables.rebuild(star.dim_date(staged), f"{schema}.dim_date")
    dates = spark.table(f"{schema}.dim_date").filter("year = 2024 AND month = 1 AND is_weekend")
    return star.star_rollup(
        star.on_days(spark.table(f"{schema}.fact_events"), dates),
        dates,
        star.dim_actor(history.open_versions(star.actor_attributes(staged), _at(FIRST_SNAPSHOT))),
        star.dim_geography(staged),
        star.dim_cameo_event(staged, star.event_roots(spark)),
    )


def gold_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every gold table and failing values of every test after the build was run twice."""
    schema, place = _scratch_schema(spark), _scratch(spark)
    tables.rebuild(_silver(spark, sf_dir), f"{schema}.events")
    star.event_roots(spark).write.csv(place, header=True)
    for moment in (FIRST_SNAPSHOT, SECOND_SNAPSHOT):
        failures = build_gold(spark, f"{schema}.events", schema, moment, seed=place)
    tested = spark.createDataFrame(list(failures.items()), "name string, n bigint")
    names = ("dim_actor", "dim_cameo_event", "dim_date", "dim_geography", "fact_events", "event_roots")
    for name in names:
        counted = tables.named_source(spark, name, schema).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        tested = tested.unionByName(counted)
    return tested


def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.duplicates(
        silver.type_lines(_conformant(spark, sf_dir)), "global_event_id"
    )


def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.nulls(silver.type_lines(_conformant(spark, sf_dir)), "global_event_id")


def test_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.unaccepted(_fact(spark, sf_dir), "quad_class", (1, 2, 3))


def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the whole fact that the date dimension of the first batch does not have."""
    known = star.dim_date(_staged(spark, sf_dir, "first"))
    return integrity.orphans(
        _fact(spark, sf_dir), "date_key", known, "date_key", where=F.col("date_key").isNotNull()
    )


# --- streaming --------------------------------------------------------------------------


def stream_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_events(bronze_lines(spark, sf_dir))


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = to_messages(stream_events(bronze_lines(spark, sf_dir)))
    return sent.select(
        F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("body")
    )


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gating.gate(_messages(spark, sf_dir)).select(
        F.col("key").cast("string").alias("message_key"),
        "outcome",
        F.when(F.col("outcome") != "undecodable", F.array_join("codes", ",")).alias("codes"),
    )


def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is sent on: dead letters as they came or with their codes, alerts unchanged."""
    return gating.routed(gating.gate(_messages(spark, sf_dir))).select(
        "topic", F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("body")
    )


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters after the messages went through a topic and a running stream."""
    place = _scratch(spark)
    sent = _messages(spark, sf_dir).withColumn("topic", F.lit("raw"))
    topics.publish(sent, f"{place}/in", "0")
    run_gate(topics.stream_topic(spark, f"{place}/in", "raw"), f"{place}/out", f"{place}/state")
    return gate_stats(spark, f"{place}/out")


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters after a run that stopped at its message limit and one that stopped when idle."""
    place = _scratch(spark)
    sent = _messages(spark, sf_dir).withColumn("topic", F.lit("raw"))
    topics.publish(sent.repartition(4), f"{place}/in", "0")
    raw = topics.stream_topic(spark, f"{place}/in", "raw", max_files=1)
    first = run_gate(raw, f"{place}/out", f"{place}/state", max_messages=1)
    second = run_gate(raw, f"{place}/out", f"{place}/state", idle=1)
    both = gate_stats(spark, f"{place}/out")
    return both.withColumn("limited", (F.lit(first) >= 1) & (F.lit(second) >= 1) & (F.lit(first + second) == F.col("consumed")))


def topic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by place after two batches, the second published twice, read back in order."""
    place = _scratch(spark)
    feed = bronze_lines(spark, sf_dir)
    for name, part in (("a", F.col("_source_file") < SPLIT_FILE), ("b", F.col("_source_file") >= SPLIT_FILE), ("b", F.col("_source_file") >= SPLIT_FILE)):
        rows = stream_events(feed.filter(part), "_source_file")
        sent = to_messages(rows, "_source_file")
        after = None if name == "a" else topics.next_positions(spark, place, "raw", name)
        numbered = sequenced(sent, "_source_file", ["value"], after).withColumn("topic", F.lit("raw"))
        topics.publish(numbered, place, name)
    return topics.read_in_order(spark, place, "raw").select(
        F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("body"), "position"
    )


def topic_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sink shows of the routes after the same batches came twice."""
    place = _scratch(spark)
    topics.publish(_messages(spark, sf_dir).withColumn("topic", F.lit("raw")), f"{place}/in", "0")
    for attempt in (1, 2):
        sent = gating.routed(gating.gate(topics.stream_topic(spark, f"{place}/in", "raw")))
        start_sink(sent, f"{place}/out", f"{place}/state-{attempt}", "gate").awaitTermination()
    found = [
        topics.read_topic(spark, f"{place}/out", name).select(
            F.lit(name).alias("topic"),
            F.col("key").cast("string").alias("message_key"),
            F.col("value").cast("string").alias("body"),
        )
        for name in (gating.DEAD_LETTERS, gating.ALERTS)
    ]
    return found[0].unionByName(found[1])


def stream_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters after a run and a restart over a topic with a damaged file, which is named once."""
    place_of = _scratch(spark)
    sent = _messages(spark, sf_dir).withColumn("topic", F.lit("raw"))
    topics.publish(sent.repartition(4), f"{place_of}/in", "0")
    system, root = place(f"{place_of}/in/batch=1/topic=raw")
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/broken.parquet") as out:
        out.write(b"PAR1 and no more")
    raw = topics.stream_topic(spark, f"{place_of}/in", "raw", max_files=2, set_aside=True)
    for _ in range(2):
        run_gate(raw, f"{place_of}/out", f"{place_of}/state")
    named = topics.read_topic(spark, f"{place_of}/out/topics", gating.DAMAGED)
    named = named.agg(F.count_if(F.col("key").cast("string").endswith("broken.parquet")).alias("damaged_files"))
    return gate_stats(spark, f"{place_of}/out").join(named)


# --- upkeep -----------------------------------------------------------------------------


def compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day after compaction of a fragmented table, which a second run leaves alone."""
    name = f"{_scratch_schema(spark)}.lines"
    feed = bronze_lines(spark, sf_dir).withColumn("day", F.substring("_source_file", 1, 8))
    tables.create_table(spark, name, "_raw_line string, _source_file string, day string", "day")
    for batch in (feed.filter(F.col("_source_file") < SPLIT_FILE), feed):
        batch.write.mode("append").insertInto(name)
    compact(spark, name, "day")
    settled = not compact(spark, name, "day")
    held = spark.table(name).groupBy("day").agg(F.count(F.lit(1)).alias("row_count"))
    return held.withColumn("settled", F.lit(settled))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to fact to a first answer: events and mean tone per quad class."""
    tone = F.sum(F.col("avg_tone").cast("decimal(18,4)"))
    return (
        _fact(spark, sf_dir)
        .groupBy("quad_class")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.round(F.try_divide(tone.cast("double"), F.count("avg_tone")), 3).alias("mean_tone"),
        )
    )


_QUERIES = (
    archive_scan,
    archive_stream,
    landing_run,
    index_parse,
    index_window,
    index_not_landed,
    checksum_status,
    landing_tally,
    feed_checkpoint,
    newest_batch,
    day_reprocess,
    contract_fields,
    contract_rejects,
    reject_distribution,
    malformed_rate,
    typed_clean,
    latest_per_key,
    quality_suite,
    quality_suite_before_dedup,
    silver_loaded,
    archives_to_silver,
    rejects_loaded,
    upsert_newest,
    upsert_orders,
    stage_events,
    fact_full,
    fact_incremental,
    fact_table_loaded,
    actor_union,
    actor_attributes,
    actor_history,
    actor_history_table,
    actor_current,
    actor_as_of,
    dim_date,
    dim_geography,
    dim_cameo_event,
    star_rollup_by_root,
    star_month,
    gold_built,
    test_unique,
    test_not_null,
    test_accepted,
    test_relationships,
    stream_projection,
    stream_messages,
    stream_gate,
    stream_routes,
    stream_stats,
    stream_bounded,
    topic_order,
    topic_sink,
    stream_set_aside,
    compact_partitions,
    flagship,
)


def _prepared(
    query: Callable[[SparkSession, str], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


QUERIES = {query.__name__: _prepared(query) for query in _QUERIES}
