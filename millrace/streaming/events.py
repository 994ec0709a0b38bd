"""The stream event: eighteen fields of the contract, its key and its JSON form.

The rules differ from the batch path on purpose: every kind of white space is stripped,
'1.5' is not an integer, the day is sliced and not checked against the calendar, and a line
of any width is accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import stream_double, strict_integer
from millrace.functions.text import strip
from millrace.operators.lines import field, with_fields

# --- fixed values: fields of a stream event in wire order, their kind, their source ---
EVENT_FIELDS = (
    ("global_event_id", "integer", "global_event_id"),
    ("event_day", "day", "sql_date"),
    ("actor1_name", "text", "actor1_name"),
    ("actor2_name", "text", "actor2_name"),
    ("actor1_country_code", "text", "actor1_country_code"),
    ("actor2_country_code", "text", "actor2_country_code"),
    ("event_code", "text", "event_code"),
    ("event_root_code", "text", "event_root_code"),
    ("quad_class", "integer", "quad_class"),
    ("goldstein_scale", "decimal", "goldstein_scale"),
    ("num_mentions", "integer", "num_mentions"),
    ("avg_tone", "decimal", "avg_tone"),
    ("action_country_code", "text", "action_geo_country_code"),
    ("action_location", "text", "action_geo_fullname"),
    ("action_lat", "decimal", "action_geo_lat"),
    ("action_long", "decimal", "action_geo_long"),
    ("date_added", "text", "date_added"),
    ("source_url", "text", "source_url"),
)


def _sliced_day(raw: Column) -> Column:
    text = strip(raw)
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(F.char_length(text) == 8, dashed)


_KINDS = {
    "integer": strict_integer,
    "decimal": stream_double,
    "text": strip,
    "day": _sliced_day,
}


def stream_events(lines: DataFrame, *keep: str) -> DataFrame:
    """One event per line; columns to ``keep`` go along."""
    return with_fields(lines).select(
        *keep,
        *[_KINDS[kind](field(source)).alias(name) for name, kind, source in EVENT_FIELDS],
    )


def country_key(event: DataFrame) -> Column:
    """Country of the action, else of the first actor, else NULL."""
    codes = [event["action_country_code"], event["actor1_country_code"]]
    return F.coalesce(*[F.nullif(code, F.lit("")) for code in codes]).cast("binary")


def to_messages(events: DataFrame, *keep: str) -> DataFrame:
    """Events as messages: country key and compact JSON value, NULL fields included.

    Columns to ``keep`` stay beside the message, outside its value.
    """
    names = [name for name in events.columns if name not in keep]
    body = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return events.select(country_key(events).alias("key"), body.cast("binary").alias("value"), *keep)
