"""Bronze lines to the silver table: contract gate, typing, quality gate, MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession

from millrace.contract import EVENTS, Contract
from millrace.operators.lines import conformant, field_count_distribution, rejects
from millrace.operators.quality import SILVER_CHECKS, Check, hold_back
from millrace.operators.silver import to_silver
from millrace.session import tune
from millrace.sources.tables import create_silver, merge_newest, rebuild, replace_rejects

# --- fixed value: share of malformed lines above which a load stops ---
MAX_MALFORMED_RATE = 0.05


class SchemaDriftError(RuntimeError):
    """Too many lines break the contract; the layout of the feed has probably changed."""


@dataclass(frozen=True)
class LoadResult:
    """Lines read, lines rejected, their spread, results of the checks, events of the batch and,
    after it, of the table (a count of file footers; no row is read)."""

    total: int = 0
    malformed: int = 0
    distribution: dict[int, int] = field(default_factory=dict)
    checks: list[Row] = field(default_factory=list)
    events: int = 0
    table_events: int = 0


def load_silver(
    spark: SparkSession,
    lines: DataFrame,
    table: str,
    max_malformed_rate: float = MAX_MALFORMED_RATE,
    contract: Contract = EVENTS,
    checks: Sequence[Check] = SILVER_CHECKS,
    keep_lines: bool = True,
) -> LoadResult:
    """Load one batch of lines. Running it again changes no contract column.

    Lines are read three times. ``keep_lines`` spares archives from being opened as often;
    turn it off for lines that are a table already.

    Lines that break the contract go to ``<table>_rejects`` before the rate is judged, so
    the evidence survives a stop. Total, malformed and their spread come from one pass.
    """
    tune(spark)
    if keep_lines:
        lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        widths = field_count_distribution(lines, contract).collect()
        total = sum(row["line_count"] for row in widths)
        spread = {
            row["_field_count"]: row["line_count"]
            for row in widths
            if row["_field_count"] != contract.width
        }
        malformed = sum(spread.values())
        if total == 0:
            return LoadResult()
        if malformed or spark.catalog.tableExists(f"{table}_rejects"):
            replace_rejects(rejects(lines, contract), lines, f"{table}_rejects")
        rate = malformed / total
        if rate > max_malformed_rate:
            raise SchemaDriftError(
                f"{malformed} of {total} lines ({rate:.2%}) break the contract of "
                f"{contract.width} fields, limit {max_malformed_rate:.2%}; "
                f"lines by field count: {spread}"
            )
        silver = _written(to_silver(conformant(lines, contract), contract), f"{table}_batch")
        try:
            checked = hold_back(silver, checks)
            create_silver(spark, table, contract)
            merge_newest(spark, table, silver, contract.key, contract.recency, contract.day)
            events = silver.count()
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}_batch")
        return LoadResult(total, malformed, spread, checked, events, spark.table(table).count())
    finally:
        if keep_lines:
            lines.unpersist()


def _written(silver: DataFrame, name: str) -> DataFrame:
    """The typed batch as a table for the steps that read it.

    Unlike a cached frame it survives the loss of an executor, its size is known to the
    joins, and each step reads only its columns. A leftover of a dead run is overwritten.
    """
    if "." in name:
        silver.sparkSession.sql(f"CREATE NAMESPACE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    rebuild(silver, name)
    return silver.sparkSession.table(name)
