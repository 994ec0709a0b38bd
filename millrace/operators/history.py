"""Slowly changing history (type 2) and the point-in-time join that reads it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.star import ACTOR_ATTRIBUTES

HISTORY_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _version_id(key: Column, since: Column) -> Column:
    return F.md5(F.concat_ws("|", key, F.date_format(since, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def open_versions(
    attributes: DataFrame, as_of: Column, key: str = "actor_code"
) -> DataFrame:
    """Every row as a version that starts now and has no end."""
    return attributes.select(
        "*",
        _version_id(F.col(key), as_of).alias("scd_id"),
        as_of.alias("updated_at"),
        as_of.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def advance_history(
    history: DataFrame,
    attributes: DataFrame,
    as_of: Column,
    key: str = "actor_code",
    compared: Sequence[str] = ACTOR_ATTRIBUTES,
) -> DataFrame:
    """History after one snapshot of the current attributes.

    A new key opens a version, a changed one closes its version and opens another, an
    unchanged one is kept, and a key that is no longer there stays open. Values are
    compared null-safe. Closed versions pass through without a join; the open ones meet
    the snapshot on a key that is unique on both sides.
    """
    columns = [key, *compared, *HISTORY_COLUMNS]
    closed = history.filter(F.col("valid_to").isNotNull()).select(*columns)
    current = history.filter(F.col("valid_to").isNull()).select(
        F.col(key).alias("k"), F.struct(*columns).alias("old")
    )
    snapshot = open_versions(attributes.select(key, *compared), as_of, key).select(
        F.col(key).alias("k"), F.struct(*columns).alias("new")
    )
    unchanged = F.lit(True)
    for name in compared:
        unchanged = unchanged & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    ended = F.col("old").withField("valid_to", as_of).withField("updated_at", as_of)
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull() | unchanged, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    moved = current.join(snapshot, "k", "full").select(F.inline(versions))
    return closed.unionByName(moved)


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    moment: str,
    key: str = "actor_code",
    compared: Sequence[str] = ACTOR_ATTRIBUTES,
    slot: str = "DAY",
) -> DataFrame:
    """Each fact row with the version valid at its moment: start included, end excluded.

    The rows of one key are never compared with all its versions. Time is cut into slots;
    a fact meets the versions that begin in its own slot and the one version carried in
    from before. The carry is worked out on one row per key and slot. The final join is on
    key and slot, its fact side can be split where one slot of one key is hot, and every
    fact finds one version at most.
    """
    payload = [*compared, "valid_from", "valid_to"]
    started = history.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.date_trunc(slot, "valid_from").alias("_slot"),
        F.struct(*payload).alias("_version"),
    )
    last_started = started.groupBy("_key", "_slot").agg(
        F.max_by("_version", F.col("_version.valid_from")).alias("_last"),
        F.lit(False).alias("_asked"),
    )
    facts = facts.withColumn("_slot", F.date_trunc(slot, F.col(moment)))
    asked = (
        facts.filter(F.col(fact_key).isNotNull() & F.col("_slot").isNotNull())
        .select(F.col(fact_key).alias("_key"), "_slot")
        .distinct()
    )
    nothing = F.lit(None).cast(last_started.schema["_last"].dataType)
    timeline = (
        last_started.unionByName(
            asked.select("_key", "_slot", nothing.alias("_last"), F.lit(True).alias("_asked"))
        )
        .groupBy("_key", "_slot")
        .agg(F.first("_last", ignorenulls=True).alias("_last"), F.max("_asked").alias("_asked"))
    )
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        timeline.withColumn("_version", F.last("_last", ignorenulls=True).over(before))
        .filter(F.col("_asked") & F.col("_version").isNotNull())
        .select("_key", "_slot", "_version")
    )
    candidates = carried.unionByName(started).withColumnRenamed("_slot", "_version_slot")
    at = F.col(moment)
    valid = (at >= F.col("_version.valid_from")) & (
        F.col("_version.valid_to").isNull() | (at < F.col("_version.valid_to"))
    )
    same_slot = (F.col(fact_key) == F.col("_key")) & (F.col("_slot") == F.col("_version_slot"))
    joined = facts.join(candidates, same_slot & valid, "left")
    return joined.drop("_slot", "_version_slot", "_key").select(
        *[c for c in facts.columns if c != "_slot"], "_version.*"
    )
