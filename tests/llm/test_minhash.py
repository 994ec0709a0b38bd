from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np

from millrace.llm import minhash
from millrace.llm.components import components
from millrace.llm.words import mix


def brute_components(rows, similarity=0.8, words=5):
    bags = {}
    for i, t in rows:
        w = (t or "").encode().split()
        runs = [tuple(w[k : k + words]) for k in range(len(w) - words + 1)] or ([tuple(w)] if w else [])
        bags[i] = Counter(runs)
    up = {i: i for i in bags}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in combinations(bags, 2):
        both = (bags[a] & bags[b]).total()
        either = (bags[a] | bags[b]).total()
        if both >= similarity * either:  # two texts without words are equal
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


def variants(seed, groups=12, size=9):
    """Groups of texts around a base, some near and some far, that all share one passage."""
    dice = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for _ in range(groups):
        base = [f"w{dice.randrange(500)}" for _ in range(90)]
        for _ in range(size):
            words = [w if dice.random() > 0.03 * dice.random() else f"x{dice.randrange(10**6)}" for w in base]
            rows.append((len(rows), " ".join(passage + words)))
    for k in range(30):
        rows.append((len(rows), " ".join(passage + [f"u{k}_{j}" for j in range(dice.randrange(15, 40))])))
    return rows


def test_groups_are_those_of_brute_force(docs_of):
    rows = variants(5)
    got = {r.doc_id: r for r in minhash.near_groups(docs_of(rows)).collect()}
    want = brute_components(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_edge_cases(docs_of):
    text = " ".join(f"a{k}" for k in range(40))
    again = "same same " * 3000
    rows = [
        (1, text), (2, text + " b"), (3, None), (4, ""), (5, "  \n"), (6, "one two"), (7, "one two"), (8, "one"),
        (9, again), (10, again + "same"), (None, text), (2, text + " b"),
    ]
    got = minhash.near_groups(docs_of(rows)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r.component_id for r in got}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 7: 6, 8: 8, 9: 9, 10: 9, None: None}
    assert [r.kept for r in got if r.doc_id is None] == [True]
    left = minhash.drop_near(docs_of(rows))
    assert left.columns == docs_of(rows).columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 3, 6, 8, 9, None], key=str)
    assert minhash.near_groups(docs_of([])).count() == 0


def test_signatures_estimate_the_weighted_similarity():
    dice = np.random.default_rng(3)
    x = dice.integers(0, 9, 80)
    y = np.where(dice.random(80) < 0.5, x, dice.integers(0, 9, 80))
    code = mix(np.arange(80, dtype=np.uint64))
    bounds = np.array([0, (x > 0).sum(), (x > 0).sum() + (y > 0).sum()])
    codes, times = np.concatenate([code[x > 0], code[y > 0]]), np.concatenate([x[x > 0], y[y > 0]])
    sides = minhash.signatures(codes, times, bounds, 20_000)
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((sides[0] == sides[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / 20_000)


def test_components_of_chains_and_cycles(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
