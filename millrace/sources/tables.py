"""Saved tables: create, read, rewrite the touched partitions, append to quarantine."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import EVENTS, REJECTS_DDL, Contract
from millrace.operators.upsert import upsert, upsert_parts

# table formats that carry out row-level changes themselves
ROW_LEVEL_FORMATS = ("iceberg", "delta", "hudi")

# a batch of at most so many keys looks them up by value; they are literals of one filter
LOOKUP_KEYS = 1000

# files that one task of a partitioned write may hold open; balanced rows meet few folders
OPEN_FILES = 64

# Some 20 bits a key. A file that holds none of 100 keys is read in vain once in a hundred times.
_KEY_FILTERS = {
    "parquet.bloom.filter.enabled#{key}": "true",
    "parquet.bloom.filter.fpp#{key}": "0.0001",
    # the size follows the number of keys in a row group, up to this many bytes
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(8 << 20),
}


def named_source(spark: SparkSession, table: str, *path: str) -> DataFrame:
    """A table by its name below an optional catalog and schema, read lazily."""
    return spark.table(".".join([*path, table]))


def read_reference_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A reference file with header and explicit types, so codes keep their zeros."""
    return spark.read.schema(schema).csv(path, header=True)


def create_table(
    spark: SparkSession,
    table: str,
    ddl: str,
    partition: str | None = None,
    provider: str = "parquet",
    lookup: str | None = None,
) -> None:
    """Create namespace and table where they are missing.

    The partition column goes last, as it does in a file-based table anyway. Parquet files of the
    table carry bloom filters on the column ``lookup``, whoever writes them.
    """
    if "." in table:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    by = f"PARTITIONED BY ({partition})" if partition else ""
    settings = _KEY_FILTERS if lookup and provider == "parquet" else {}
    pairs = ", ".join(f"'{name.format(key=lookup)}' = '{value}'" for name, value in settings.items())
    options = f"OPTIONS ({pairs})" if pairs else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {provider} {options} {by}")


def create_silver(
    spark: SparkSession, table: str, contract: Contract = EVENTS, provider: str = "parquet"
) -> None:
    """The silver table of a contract; a table of a narrower contract gets the new columns."""
    create_table(spark, table, contract.silver_ddl, contract.day, provider, contract.key)
    held = set(spark.table(table).columns)
    if new := [f"{name} {kind}" for name, kind in contract.columns if name not in held]:
        add_columns(spark, table, ", ".join(new))


def add_columns(spark: SparkSession, table: str, ddl: str) -> None:
    """A new upstream column: existing rows read NULL, no file is rewritten."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")


def provider_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    found = rows.filter(F.lower("col_name") == "provider").select("data_type").first()
    return (found[0] if found else "").lower()


def location_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return rows.filter(F.col("col_name") == "Location").select("data_type").first()[0]


def balanced(df: DataFrame, partition: str) -> DataFrame:
    """Group rows by partition for writing; a partition too large for one task is split
    and small ones share a task, both by measured size."""
    return df.hint("rebalance", partition)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _dynamic_overwrite(spark: SparkSession) -> AbstractContextManager[None]:
    return _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")


def open_writers(spark: SparkSession) -> AbstractContextManager[None]:
    """A partitioned write inside keeps a file open for each partition a task meets.

    So rows are not sorted, and spilled, only to be written folder by folder. Beyond
    ``OPEN_FILES`` in one task Spark sorts what is left.
    """
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Spark writes them beside the table and swaps them in when the job has succeeded, so
    ``df`` may read from the table it replaces.
    """
    spark = df.sparkSession
    with _dynamic_overwrite(spark):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def rebuild(df: DataFrame, table: str) -> None:
    """Full refresh of a table."""
    df.write.mode("overwrite").saveAsTable(table)


def within(partition: str, values: list[object]) -> Column:
    """Filter on literal partition values, NULL included, that prunes the scan."""
    known = [v for v in values if v is not None]
    tests = [F.col(partition).isin(known)] if known else []
    if len(known) < len(values):
        tests.append(F.col(partition).isNull())
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _partition_spec(partition: str, value: object) -> str:
    if value is None:
        return f"{partition} = NULL"
    if isinstance(value, (int, float)):
        return f"{partition} = {value}"
    return f"{partition} = '{value}'"


def rows_near(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``target`` that may have a key of ``batch``, by a filter that the files can answer.

    Up to ``LOOKUP_KEYS`` distinct keys, counted first, become literals: row groups whose limits or
    bloom filters rule them all out are not read, however many the target has. More keys would
    leave few files out; those are looked for within the range of the keys.
    """
    keys = batch.filter(F.col(key).isNotNull()).select(key).distinct().limit(LOOKUP_KEYS + 1).collect()
    if len(keys) <= LOOKUP_KEYS:
        return target.filter(F.col(key).isin([row[0] for row in keys]))
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return target.filter(F.col(key).between(F.lit(low), F.lit(high)))


def merge_partitions(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    key: str,
    partition: str,
    recency: str | None = None,
) -> list[object]:
    """MERGE ``batch`` into the partitions it touches, by rewriting just those.

    Touched are the partitions of the batch and those that hold a row with a key of the
    batch, since a row may move. The values collected are partition values, one per
    touched partition. Only key and partition columns are read to find them, and only in files
    that ``rows_near`` cannot rule out. Rows that stay are written
    back by the task that read them; only the batch is shuffled.

    A partition that loses its last row cannot be emptied by an overwrite. It is dropped
    first: all its rows are in the batch and come back with the overwrite, and should the
    run die in between, the same batch run again puts them in as new rows.

    ``batch`` is read several times and must not change in between: pass a table or a
    persisted frame.
    """
    target = spark.table(table)
    held = rows_near(target, batch, key)
    pairs = held.select(F.col(key).alias("k"), F.col(partition).alias("p")).join(
        batch.select(F.col(key).alias("k"), F.col(partition).alias("into")), "k"
    )
    homes = pairs.select("p", (~F.col("p").eqNullSafe(F.col("into"))).alias("moves"))
    arrivals = batch.select(F.col(partition).alias("p"), F.lit(False).alias("moves"))
    touched = arrivals.unionByName(homes).groupBy("p").agg(F.max("moves").alias("moves"))
    found = touched.collect()
    days = [row["p"] for row in found]
    if not days:
        return days

    emptied: list[object] = []
    if any(row["moves"] for row in found):
        after = upsert(target.filter(within(partition, days)), batch, key, recency)
        left = {row[0] for row in after.select(partition).distinct().collect()}
        emptied = [day for day in days if day not in left]
    for day in emptied:
        spec = _partition_spec(partition, day)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")

    remaining = [day for day in days if day not in emptied]
    kept, taken = upsert_parts(
        spark.table(table).filter(within(partition, remaining)), batch, key, recency
    )
    overwrite_partitions(kept.unionByName(balanced(taken, partition)), table)
    return days


def merge_newest(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    key: str = EVENTS.key,
    recency: str | None = EVENTS.recency,
    partition: str = EVENTS.day,
) -> None:
    """MERGE guarded by recency: natively where the format can, else by partition."""
    if provider_of(spark, table) in ROW_LEVEL_FORMATS:
        same = F.expr(f"{table}.{key} = batch.{key}")
        guard = F.expr(f"batch.{recency} >= {table}.{recency}") if recency else None
        merge = batch.alias("batch").mergeInto(table, same)
        merge.whenMatched(guard).updateAll().whenNotMatched().insertAll().merge()
        return
    merge_partitions(spark, table, batch, key, partition, recency)


def replace_by_key(
    spark: SparkSession, table: str, batch: DataFrame, key: str, partition: str
) -> None:
    """Delete and insert by key within the touched partitions."""
    merge_newest(spark, table, batch, key, None, partition)


def file_day(source: Column) -> Column:
    """The day a dated file name begins with, as digits, else ``undated``."""
    day = F.regexp_extract(F.coalesce(source, F.lit("")), "^[0-9]{8}", 0)
    return F.when(day == "", "undated").otherwise(day)


def replace_rejects(rejects: DataFrame, lines: DataFrame, table: str) -> None:
    """Put the rejects of a batch in the place of all that the quarantine holds of its files.

    A re-run, or a file published again, therefore leaves one copy, also of lines that are NULL.
    The table is partitioned by day of the file, and only the days of the batch are read and
    rewritten; a day that loses its last reject is dropped.
    """
    spark = rejects.sparkSession
    create_table(spark, table, REJECTS_DDL, "_file_day")
    files = lines.select("_source_file").distinct()
    days = [r[0] for r in files.select(file_day(F.col("_source_file"))).distinct().collect()]
    columns = spark.table(table).columns
    held = spark.table(table).filter(within("_file_day", days))
    same = held["_source_file"].eqNullSafe(files["_source_file"])
    fresh = rejects.withColumn("_quarantined_at", F.current_timestamp()).withColumn(
        "_file_day", file_day(F.col("_source_file"))
    )
    after = held.join(files, same, "left_anti").select(*columns).unionByName(fresh.select(*columns))
    left = {r[0] for r in after.select("_file_day").distinct().collect()}
    overwrite_partitions(balanced(after, "_file_day"), table)
    for day in {r[0] for r in held.select("_file_day").distinct().collect()} - left:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_partition_spec('_file_day', day)})")
