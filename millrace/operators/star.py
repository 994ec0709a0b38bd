"""Silver events to the star schema. Every function takes and returns a DataFrame."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import EVENT_ROOT_SCHEMA, EVENT_ROOTS, GEO_TYPE_NAMES, GEO_TYPE_OTHER
from millrace.functions.instants import instant
from millrace.functions.keys import (
    day_key,
    day_label,
    hash_key,
    month_label,
    place_key,
    weekday_number,
)

ACTOR_ATTRIBUTES = (
    "actor_name",
    "country_code",
    "known_group_code",
    "ethnic_code",
    "religion_code",
    "type_code",
)

# the fact takes everything newer than this on its first load
FLOOR = datetime(1900, 1, 1)

_STAGED_AS_IS = (
    "is_root_event",
    "event_code",
    "event_base_code",
    "event_root_code",
    "quad_class",
    "goldstein_scale",
    "num_mentions",
    "num_sources",
    "num_articles",
    "avg_tone",
    "action_geo_type",
    "action_geo_fullname",
    "action_geo_country_code",
    "action_geo_adm1_code",
    "action_geo_lat",
    "action_geo_long",
    "action_geo_feature_id",
    "date_added",
    "source_url",
)


def stage_events(silver: DataFrame) -> DataFrame:
    """The columns the star needs, with parallel names for the two actors."""
    renamed = {"religion1_code": "religion_code", "type1_code": "type_code"}
    parts = (
        "code",
        "name",
        "country_code",
        "known_group_code",
        "ethnic_code",
        "religion1_code",
        "type1_code",
    )
    actors = [
        F.col(f"actor{role}_{part}").alias(f"actor{role}_{renamed.get(part, part)}")
        for role in (1, 2)
        for part in parts
    ]
    return silver.select(
        "global_event_id", "sql_date", "fraction_date", *actors, *_STAGED_AS_IS
    )


def actor_mentions(staged: DataFrame) -> DataFrame:
    """Both actor roles stacked; rows without an actor code are left out.

    The two roles come out of one scan (an array of two structs), not out of a union of
    two scans.
    """
    roles = [
        F.struct(
            F.col(f"actor{role}_code").alias("actor_code"),
            F.col(f"actor{role}_name").alias("actor_name"),
            *[F.col(f"actor{role}_{a}").alias(a) for a in ACTOR_ATTRIBUTES[1:]],
        )
        for role in (1, 2)
    ]
    return staged.select(F.inline(F.array(*roles))).filter(F.col("actor_code").isNotNull())


def actor_attributes(staged: DataFrame) -> DataFrame:
    """One row per actor code with the greatest value of each attribute.

    A maximum over text is aggregated by sorting. Grouping by all columns first is a hash
    aggregation, so what gets sorted is the small set of combinations instead of two rows
    per event, and an actor in a third of all events leaves each task a few times only. The
    filter on the count keeps Spark from dropping that step as redundant.
    """
    combinations = (
        actor_mentions(staged)
        .groupBy("actor_code", *ACTOR_ATTRIBUTES)
        .agg(F.count(F.lit(1)).alias("_mentions"))
        .filter(F.col("_mentions") > 0)
    )
    return combinations.groupBy("actor_code").agg(
        *[F.max(name).alias(name) for name in ACTOR_ATTRIBUTES]
    )


def dim_date(staged: DataFrame) -> DataFrame:
    """One row per event date; the calendar columns are computed after the distinct."""
    day = F.col("sql_date")
    return (
        staged.filter(day.isNotNull())
        .select("sql_date")
        .distinct()
        .select(
            day_key(day).alias("date_key"),
            day.alias("full_date"),
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            month_label(day).alias("month_name"),
            F.dayofmonth(day).alias("day_of_month"),
            weekday_number(day).alias("day_of_week"),
            day_label(day).alias("day_name"),
            weekday_number(day).isin(0, 6).alias("is_weekend"),
        )
    )


def dim_geography(staged: DataFrame) -> DataFrame:
    """One row per place, each attribute the greatest seen (they may mix events)."""
    attributes = {
        "geo_type": "action_geo_type",
        "geo_fullname": "action_geo_fullname",
        "country_code": "action_geo_country_code",
        "adm1_code": "action_geo_adm1_code",
        "latitude": "action_geo_lat",
        "longitude": "action_geo_long",
        "feature_id": "action_geo_feature_id",
    }
    natural = place_key(F.col("action_geo_feature_id"), F.col("action_geo_fullname"))
    texts = ("geo_fullname", "country_code", "adm1_code", "feature_id")
    numbers = [name for name in attributes if name not in texts]
    # numbers are reduced by hash together with the distinct texts, see actor_attributes
    combinations = (
        staged.select(
            natural.alias("geo_natural_key"),
            *[F.col(source).alias(name) for name, source in attributes.items()],
        )
        .filter(F.col("geo_natural_key").isNotNull())
        .groupBy("geo_natural_key", *texts)
        .agg(*[F.max(name).alias(name) for name in numbers])
    )
    places = combinations.groupBy("geo_natural_key").agg(
        *[F.max(name).alias(name) for name in attributes]
    )
    label = F.lit(GEO_TYPE_OTHER)
    for code, name in GEO_TYPE_NAMES.items():
        label = F.when(F.col("geo_type") == code, name).otherwise(label)
    return places.select(
        hash_key(F.col("geo_natural_key")).alias("geo_key"),
        "geo_natural_key",
        "geo_type",
        label.alias("geo_type_name"),
        "geo_fullname",
        "country_code",
        "adm1_code",
        "latitude",
        "longitude",
        "feature_id",
    )


def event_roots(spark: SparkSession) -> DataFrame:
    """The reference table of event roots (20 fixed rows).

    Made from an Arrow table it is a local relation whose size Spark knows, so a join
    broadcasts it by the usual threshold.
    """
    names = [column.split()[0] for column in EVENT_ROOT_SCHEMA.split(", ")]
    columns = dict(zip(names, zip(*EVENT_ROOTS, strict=True), strict=True))
    return spark.createDataFrame(pa.table(columns), EVENT_ROOT_SCHEMA)


def dim_cameo_event(staged: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct event codes with root and quad class labels.

    Codes are made distinct before the join, and the roots carry a known size, so Spark
    broadcasts them by its own threshold. A code seen with two quad classes stays two
    rows; the key test reports it.
    """
    codes = (
        staged.filter(F.col("event_code").isNotNull())
        .select("event_code", "event_base_code", "event_root_code", "quad_class")
        .distinct()
    )
    labels = roots.select(
        F.col("event_root_code").alias("_root"), "root_description", "quad_class_name"
    )
    return codes.join(
        labels, F.lpad("event_root_code", 2, "0") == F.col("_root"), "left"
    ).select(
        hash_key(F.col("event_code")).alias("cameo_key"),
        "event_code",
        "event_base_code",
        "event_root_code",
        "root_description",
        "quad_class",
        "quad_class_name",
    )


def dim_actor(history: DataFrame) -> DataFrame:
    """Current version of every actor."""
    return history.filter(F.col("valid_to").isNull()).select(
        hash_key(F.col("actor_code")).alias("actor_key"),
        "actor_code",
        *ACTOR_ATTRIBUTES,
        "valid_from",
        "valid_to",
        F.lit(True).alias("is_current"),
    )


def fact_events(staged: DataFrame, loaded_until: datetime | Column = FLOOR) -> DataFrame:
    """Fact rows added strictly after ``loaded_until``; keys need no lookup join.

    The limit is a literal, so it is pushed into the scan. Rows without ``date_added``
    never enter.
    """
    place = place_key(F.col("action_geo_feature_id"), F.col("action_geo_fullname"))
    return staged.filter(F.col("date_added") > instant(loaded_until)).select(
        F.col("global_event_id").alias("event_key"),
        day_key(F.col("sql_date")).alias("date_key"),
        hash_key(F.col("actor1_code")).alias("actor1_key"),
        hash_key(F.col("actor2_code")).alias("actor2_key"),
        hash_key(place).alias("action_geo_key"),
        hash_key(F.col("event_code")).alias("cameo_key"),
        "is_root_event",
        "quad_class",
        "source_url",
        "goldstein_scale",
        "num_mentions",
        "num_sources",
        "num_articles",
        "avg_tone",
        "date_added",
    )


def high_water(fact: DataFrame) -> DataFrame:
    """One row: the newest ``date_added`` in the fact, or the floor."""
    newest = F.coalesce(F.max("date_added"), instant(FLOOR))
    return fact.agg(newest.alias("loaded_until"))


def on_days(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The facts of the days in ``dates``, a filtered date dimension.

    On a fact that is partitioned by day the days become a filter of the scan at run time, so
    other partitions are not read.
    """
    return fact.join(dates.select("date_key"), "date_key", "left_semi")


def star_rollup(
    fact: DataFrame,
    dates: DataFrame,
    actors: DataFrame,
    places: DataFrame,
    event_types: DataFrame,
) -> DataFrame:
    """Events and mean tone by month, first actor's country, place country and root label.

    The fact is reduced to one row per combination of keys before it meets a dimension, so
    an actor or place that holds a third of the events joins as few rows. Which side is
    broadcast is left to Spark, which goes by measured size and splits a skewed side. Tone
    is summed as a decimal: the result does not depend on the order of rows.
    """
    tone = F.col("avg_tone").cast("decimal(18,4)")
    reduced = fact.groupBy("date_key", "actor1_key", "action_geo_key", "cameo_key").agg(
        F.count(F.lit(1)).alias("n"), F.count("avg_tone").alias("toned"), F.sum(tone).alias("tone")
    )
    joined = (
        reduced.join(dates.select("date_key", "year", "month"), "date_key", "left")
        .join(
            event_types.select("cameo_key", "root_description", "quad_class_name"),
            "cameo_key",
            "left",
        )
        .join(
            places.select(
                F.col("geo_key").alias("action_geo_key"), F.col("country_code").alias("place_country")
            ),
            "action_geo_key",
            "left",
        )
        .join(
            actors.select(
                F.col("actor_key").alias("actor1_key"), F.col("country_code").alias("actor_country")
            ),
            "actor1_key",
            "left",
        )
    )
    labels = ("year", "month", "root_description", "quad_class_name", "actor_country", "place_country")
    return joined.groupBy(*labels).agg(
        F.sum("n").alias("event_count"),
        F.round(F.try_divide(F.sum("tone").cast("double"), F.sum("toned")), 6).alias("mean_tone"),
    )
