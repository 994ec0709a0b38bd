"""From text lines to contract fields: split, count, normalise, keep the evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.contract import EVENTS, Contract
from millrace.functions.once import evaluate_once

TAB = "\t"


def with_fields(lines: DataFrame) -> DataFrame:
    """Lines with ``_fields``: the tab-separated texts, trailing empty ones included."""
    return evaluate_once(lines, _fields=F.split("_raw_line", TAB, -1))


def field(name: str, contract: Contract = EVENTS) -> Column:
    """One raw field of ``_fields`` by contract name; NULL where the line is too short."""
    return F.get("_fields", F.lit(contract.position(name)))


def field_count(line: Column, contract: Contract = EVENTS) -> Column:
    """Number of fields; one lone empty field after the last expected one is forgiven.

    Counted from the tabs, so a line need not be cut up to be judged. No line at all has no
    field, so it is rejected and not lost.
    """
    tabs = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(TAB), F.lit("")))
    forgiven = (tabs == contract.width) & F.endswith(line, F.lit(TAB))
    count = F.when(forgiven, F.lit(contract.width)).otherwise(tabs + 1)
    return F.coalesce(count, F.lit(0))


def with_field_count(lines: DataFrame, contract: Contract = EVENTS) -> DataFrame:
    return lines.withColumn("_field_count", field_count(F.col("_raw_line"), contract))


def raw_frame(lines: DataFrame, contract: Contract = EVENTS) -> DataFrame:
    """All fields as text, padded or cut to the contract width, plus the drift evidence."""
    return with_fields(lines).select(
        *[field(name, contract).alias(name) for name in contract.names],
        "_source_file",
        field_count(F.col("_raw_line"), contract).alias("_field_count"),
        "_raw_line",
    )


def conformant(lines: DataFrame, contract: Contract = EVENTS) -> DataFrame:
    return lines.filter(field_count(F.col("_raw_line"), contract) == contract.width)


def rejects(lines: DataFrame, contract: Contract = EVENTS) -> DataFrame:
    """Lines that break the contract, as they arrived, without a time stamp."""
    return (
        with_field_count(lines, contract)
        .filter(F.col("_field_count") != contract.width)
        .select(
            "_raw_line",
            "_field_count",
            F.lit(contract.width).alias("_expected_count"),
            "_source_file",
        )
    )


def field_count_distribution(lines: DataFrame, contract: Contract = EVENTS) -> DataFrame:
    """How many lines have which width: total, malformed and their spread in one pass."""
    return (
        with_field_count(lines, contract)
        .groupBy("_field_count")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )


def malformed_rate(distribution: DataFrame, contract: Contract = EVENTS) -> DataFrame:
    """One row: total, malformed, and their ratio (NULL for no lines at all)."""
    bad = F.col("_field_count") != contract.width
    counts = distribution.agg(
        F.coalesce(F.sum("line_count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(bad, F.col("line_count"))), F.lit(0)).alias("malformed"),
    )
    return counts.withColumn("rate", F.try_divide("malformed", "total"))
