from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import build_session, scratch_root, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=4,
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def schema(spark):
    """An empty schema for tests that write tables."""
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE NAMESPACE {name} LOCATION '{scratch_root(spark)}/{name}'")
    yield name
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


@pytest.fixture
def lines_of(spark):
    """Lines frame from (line, source file) pairs or bare lines."""

    def build(rows):
        pairs = [row if isinstance(row, tuple) else (row, "f.zip") for row in rows]
        return spark.createDataFrame(pairs, "_raw_line string, _source_file string")

    return build
