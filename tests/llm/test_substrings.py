from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow.compute as pc
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import substrings


def brute(rows, width):
    first = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - width + 1):
            if i is not None:
                window = tuple(words[k : k + width])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if i is not None and first[tuple(words[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def made(seed, n=60):
    dice = random.Random(seed)
    pool = [f"w{dice.randrange(25)}" for _ in range(300)]
    rows = []
    for i in range(n):
        at = dice.randrange(200)
        words = pool[at : at + dice.randrange(0, 60)] + ["same"] * dice.randrange(0, 30) + pool[: dice.randrange(0, 40)]
        rows.append((dice.choice([i, i, i, i, 5, None]), dice.choice([" ", "\n", "  "]).join(words)))
    return rows


def test_against_brute_force_over_many_chunks(docs_of):
    for seed, seed_words in ((1, 1), (2, 4), (3, 10)):
        rows = made(seed)
        small = substrings.Settings(width=10, seed=seed_words, chunk_bytes=2500)
        got = substrings.drop_repeats(docs_of(rows), small).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows, 10)


def test_split_minimisers_against_brute_force(docs_of):
    for seed, few, most in ((1, 0, 0), (2, 0, 3), (4, 1, 6)):
        rows = made(seed)
        small = substrings.Settings(width=10, seed=3, chunk_bytes=2500, few=few, most=most)
        assert len(substrings.hot_minimisers(docs_of(rows), small))
        got = substrings.drop_repeats(docs_of(rows), small).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows, 10)


def test_a_short_passage_in_every_document_fills_no_bucket(docs_of):
    """Its minimiser is shared by all, its windows by few: dealt one by one they spread evenly."""
    dice = random.Random(11)
    notice = [f"notice{k}" for k in range(9)]
    rows = [(i, " ".join([f"a{dice.random()}" for _ in range(5)] + notice + [f"b{dice.random()}" for _ in range(5)]))
            for i in range(400)]
    rows += [(900 + i, rows[i][1]) for i in range(5)]
    small = substrings.Settings(width=12, seed=4, chunk_bytes=2500, few=2, most=50)
    docs = docs_of(rows)
    hot = substrings.hot_minimisers(docs, small)
    assert len(hot)
    chunks = substrings.chunk_count(docs, small.chunk_bytes)
    blocks = substrings.deal(docs, chunks).where("chunk < 6").toArrow()

    def largest(split_up):
        """Share of what six chunks ask that goes to one bucket."""
        sizes = np.zeros(4 * chunks)
        for n in range(6):
            part = blocks.filter(pc.field("chunk") == n)
            asked = substrings._asked(n, substrings.Chunk(part, 2 * chunks, small, split_up))
            for bucket, block in zip(asked["bucket"].to_pylist(), asked["asked"].to_pylist()):
                sizes[bucket] += len(substrings.unpack_bytes(block))
        return sizes.max() / sizes.sum()

    assert largest(hot) < largest(hot[:0]) / 3
    got = substrings.drop_repeats(docs, small).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 12)
    assert sum(r.n_removed > 0 for r in got) == 5


def test_edge_cases(docs_of):
    long = " ".join(f"v{k}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, "few words"), (4, long), (5, "x " + long), (5, "x " + long), (None, long), (6, "é\x1cb ñ")]
    got = substrings.drop_repeats(docs_of(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 50)
    assert substrings.drop_repeats(docs_of([])).count() == 0


@given(st.lists(st.integers(0, 50), min_size=1, max_size=80), st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_sliding_minimum(values, width):
    values = np.array(values)
    got = substrings.sliding_min(values, width) if width <= len(values) else np.zeros(0)
    assert got.tolist() == [values[k : k + width].min() for k in range(len(values) - width + 1)]


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "mix", lambda x: x & np.uint64(1))
    strings = [b"a b c d", b"a b x", b"c d e", b"b c d"]
    smallest = np.array([4, 1, 2, 9])
    flags, bounds = substrings.earlier(strings, smallest, 2)
    pairs = {(s, w): bool(flags[bounds[s] + w]) for s in range(4) for w in range(bounds[s + 1] - bounds[s])}
    assert pairs == {
        (0, 0): True, (0, 1): False, (0, 2): True, (1, 0): False, (1, 1): False,
        (2, 0): False, (2, 1): False, (3, 0): True, (3, 1): True,
    }
