from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from millrace.llm import exact

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "long " * 50_000), (3, "a"), (None, "b"), (None, "z")]


def expected(rows, keep):
    members = {}
    for i, t in rows:
        members.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        known = [k for k in members[t or ""] if k is not None]
        best = keep(known) if known else None
        out.append((i, best, len(members[t or ""]), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_and_edge_cases(docs_of):
    for keep, best in (("smallest", min), ("largest", max)):
        got = exact.exact_groups(docs_of(ROWS), keep=keep)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected(ROWS, best)


def test_collisions_of_both_hashes_are_told_apart(docs_of):
    weak = lambda text: F.substring(text, 1, 1)
    rows = [(1, "ab"), (2, "ac"), (3, "ab"), (4, "b")]
    got = exact.exact_groups(docs_of(rows), hashed=weak, digest=weak)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got.collect()) == [
        (1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 4, 1),
    ]


def test_drop_copies_keeps_one_row_of_each_text(docs_of):
    docs = docs_of(ROWS)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, 4, 6, None], key=str)


def test_empty_table(docs_of):
    assert exact.exact_groups(docs_of([])).count() == 0
    assert exact.drop_copies(docs_of([])).count() == 0


def test_only_built_in_functions(docs_of):
    plan = exact.exact_groups(docs_of(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
