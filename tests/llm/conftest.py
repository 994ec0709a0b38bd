from __future__ import annotations

import pytest


@pytest.fixture
def docs_of(spark):
    """A frame of documents from (id, text) pairs, with more columns, some of clashing names."""

    def build(rows, **kinds):
        schema = "doc_id long, text string, score string, _text string, n int"
        return spark.createDataFrame([(i, t, "x", None, None) for i, t in rows], schema)

    return build
