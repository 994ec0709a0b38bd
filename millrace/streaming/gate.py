"""Per-message gate: decode, check, route. One plan for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEAD_LETTERS = "dlq"
ALERTS = "alerts"
DAMAGED = "damaged"

# Only the fields the gate looks at are decoded. The key is read as text, because any
# non-null value will do; whole numbers are read as doubles, so 4.0 counts as 4.
_CHECKED = (
    "global_event_id string, event_day string, quad_class double, goldstein_scale double, "
    "num_mentions double, avg_tone double, action_lat double, action_long double"
)

# The decoder stops after the first complete value and would let anything follow it, so the
# text is read as the only element of a list inside an object with an end mark.
_ENVELOPE = f"message array<struct<{_CHECKED.replace(' ', ':').replace(',:', ',')}>>, end int, _corrupt string"

# --- fixed values: alert limits and valid ranges ---
ALERT_GOLDSTEIN = -8.0
ALERT_MENTIONS = 10
QUAD_CLASSES = (1, 2, 3, 4)
RANGES = {
    "goldstein_scale": (-10.0, 10.0, "goldstein_out_of_range"),
    "avg_tone": (-100.0, 100.0, "avg_tone_out_of_range"),
    "action_lat": (-90.0, 90.0, "action_lat_out_of_range"),
    "action_long": (-180.0, 180.0, "action_long_out_of_range"),
}


def violations(event: str = "event") -> Column:
    """Codes of the broken rules in fixed order; empty when the event passes."""

    def of(name: str) -> Column:
        return F.col(f"{event}.{name}")

    codes = [
        F.when(of("global_event_id").isNull(), "global_event_id_missing"),
        F.when(F.coalesce(of("event_day"), F.lit("")) == "", "event_day_missing"),
        F.when(~of("quad_class").isin(*QUAD_CLASSES), "quad_class_out_of_range"),
        *[
            F.when(~of(name).between(low, high), code)
            for name, (low, high, code) in RANGES.items()
        ],
    ]
    return F.array_compact(F.array(*codes))


def is_high_impact(event: str = "event") -> Column:
    """Very hostile, or a material conflict that enough sources mention."""
    hostile = F.col(f"{event}.goldstein_scale") <= ALERT_GOLDSTEIN
    mentions = F.coalesce(F.col(f"{event}.num_mentions"), F.lit(0))
    conflict = (F.col(f"{event}.quad_class") == 4) & (mentions >= ALERT_MENTIONS)
    return F.coalesce(hostile, F.lit(False)) | F.coalesce(conflict, F.lit(False))


def _with_codes(text: Column, codes: Column) -> Column:
    """The JSON text as it arrived plus ``_violations``: unknown keys survive."""
    body = F.regexp_replace(text, r"\}\s*$", "")
    comma = F.when(body.rlike(r"^\s*\{\s*$"), "").otherwise(",")
    return F.concat(body, comma, F.lit('"_violations":'), F.to_json(codes), F.lit("}"))


def gate(messages: DataFrame) -> DataFrame:
    """Messages (``key``, ``value``) with ``codes``, ``outcome``, ``topic`` and ``payload``.

    ``outcome`` is ``undecodable``, ``invalid``, ``alert`` or ``valid``; ``topic`` is where
    ``payload`` goes, NULL for nowhere. Text that is no JSON object, and a number of the
    wrong type, cannot be decoded and is dead-lettered as it came. A row with a ``fault`` is no
    message but stands for a file that cannot be read: outcome and topic are ``damaged``, the key is
    its path and the payload the fault.
    """
    fault = F.col("fault") if "fault" in messages.columns else F.lit(None).cast("string")
    text = F.col("value").cast("string")
    envelope = F.concat(F.lit('{"message":['), text, F.lit('],"end":1}'))
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt",
        "allowSingleQuotes": "false",
    }
    decoded = messages.select(
        "key",
        "value",
        text.alias("_text"),
        fault.alias("_fault"),
        F.from_json(envelope, _ENVELOPE, options).alias("_envelope"),
    )
    decoded = decoded.withColumn("event", F.get("_envelope.message", F.lit(0)))
    broken = (
        F.col("event").isNull()
        | F.col("_envelope._corrupt").isNotNull()
        | F.col("_envelope.end").isNull()
        | (F.size("_envelope.message") != 1)
        | ~F.is_valid_utf8("_text")
    )
    outcome = (
        F.when(F.col("_fault").isNotNull(), "damaged")
        .when(broken, "undecodable")
        .when(F.size("codes") > 0, "invalid")
        .when(is_high_impact(), "alert")
        .otherwise("valid")
    )
    topic = (
        F.when(F.col("outcome").isin("undecodable", "invalid"), DEAD_LETTERS)
        .when(F.col("outcome") == "alert", ALERTS)
        .when(F.col("outcome") == "damaged", DAMAGED)
    )
    marked = _with_codes(F.col("_text"), F.col("codes")).cast("binary")
    payload = (
        F.when(F.col("outcome") == "invalid", marked)
        .when(F.col("outcome") == "damaged", F.col("_fault").cast("binary"))
        .otherwise(F.col("value"))
    )
    judged = decoded.withColumn("codes", violations()).withColumn("outcome", outcome)
    # a filter on topic or outcome must not repeat the decoding
    settled = F.struct("codes", "outcome", topic.alias("topic"), payload.alias("payload"))
    return judged.select("key", "value", F.inline(F.array(settled)))


def routed(gated: DataFrame) -> DataFrame:
    """Messages to send on: dead letters, alerts and the names of damaged files."""
    return gated.filter(F.col("topic").isNotNull()).select(
        "topic", "key", F.col("payload").alias("value")
    )


def gate_counts(gated: DataFrame) -> list[Column]:
    """Aggregates for the counters of a run."""
    outcome = F.col("outcome")
    return [
        F.count_if(outcome != "damaged").alias("consumed"),
        F.count_if(outcome.isin("valid", "alert")).alias("valid"),
        F.count_if(outcome.isin("undecodable", "invalid")).alias("dead_lettered"),
        F.count_if(outcome == "alert").alias("alerts"),
    ]
