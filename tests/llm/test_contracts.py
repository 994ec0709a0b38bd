"""The registered queries on the smallest tables: their columns, and what SQL can say about them."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

from millrace.llm.queries import LLM_ORACLE, LLM_QUERIES, table

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id keep_id group_size kept text_sha256",
    "op2": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4": "doc_id class_id component_id kept n_shingles",
    "op5": "vec_id n_links component_id kept",
    "op6": "doc_id n_tokens domain posterior rate",
    "op7": "doc_id n_words n_removed kept_sha256",
    "op8": "page_id url text n_chars",
    "op9": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10": "doc_id held_out score predicted",
    "op11": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12": "doc_id start n_tokens ids_crc32",
}


@pytest.mark.parametrize("name", list(LLM_QUERIES))
def test_columns_and_rows(spark, name):
    out = LLM_QUERIES[name](spark, SF)
    assert out.columns == COLUMNS[name.split("_")[0]].split()
    source = {"op5": "embeddings", "op8": "pages", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    rows = out.collect()
    if name.startswith("op13"):
        assert [r.n_convs for r in rows if r.depth == 0] == [table(spark, SF, "conversations").select("conv_id").distinct().count()]
    elif name.startswith("op2"):
        assert {r.doc_id for r in rows} == {r.doc_id for r in table(spark, SF, source).collect()}
    else:
        assert len(rows) == table(spark, SF, source).count()
    for r in rows if "held_out" in out.columns else []:
        fold = zlib.crc32(str(r.doc_id).encode()) % 5
        assert r.held_out == (fold == (1 if name.startswith("op3") else 0))


def test_spans_and_their_digest(spark):
    for r in LLM_QUERIES["op9_secrets"](spark, SF).collect():
        base = [s for s in r.spans.split(",") if s and not s.startswith("crf:")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert len(base) == r.n_assign + r.n_access + r.n_hex


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_against_its_sql(spark, name):
    base = duckdb.connect()
    for source in ("documents", "embeddings", "conversations"):
        base.execute(f"create view {source} as select * from '{SF}/{source}.parquet'")
    relation = base.sql(LLM_ORACLE[name])
    got = LLM_QUERIES[name](spark, SF)
    assert got.columns == relation.columns
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(relation.fetchall(), key=key)
