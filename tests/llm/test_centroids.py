"""Clusters against plain integer arithmetic: every distance, every sum, every tie."""

from __future__ import annotations

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import centroids as C


def brute(rows, settings):
    """Clusters of (id, vector) rows in Python integers."""
    kept = [
        (i, [math.floor(Fraction(x) * settings.scale) for x in v])
        for i, v in rows
        if v is not None and len(v) == settings.dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"{settings.seed}:{'' if i is None else i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (name(r[0]), r[1]))[: settings.k]
    points = [q for _, q in first]

    def best(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, p)), n) for n, p in enumerate(points))

    for _ in range(settings.rounds):
        found = [(best(q)[1], q) for _, q in kept]
        for n in range(len(points)):
            mine = [q for m, q in found if m == n]
            if mine:
                points[n] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((i if i is not None else -1, best(q)[1], min(best(q)[0], 2**63 - 1)) for i, q in kept), points


def run(spark, rows, settings):
    table = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int"
    )
    found, points = C.cluster(table, settings)
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.cluster, r.distance) for r in found.collect())
    return got, [[int(x) for x in p] for p in points.tolist()]


@pytest.mark.parametrize("k, dims, span", [(8, 6, 3.0), (5, 2, 0.004), (40, 3, 1.0)])
def test_rounds_against_brute_force(spark, k, dims, span):
    """The narrow span puts many vectors on the same few integer points: ties and repeated rows."""
    dice = random.Random(k)
    rows = [(i, [dice.uniform(-span, span) for _ in range(dims)]) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, [1.0] * (dims - 1)), (902, [])]
    rows += [(903, [None] * dims), (904, [math.nan] * dims), (905, [math.inf] + [0.0] * (dims - 1))]
    settings = C.Settings(k=k, dims=dims, rounds=4, batch=37)
    assert run(spark, rows, settings) == brute(rows, settings)


def test_enormous_components_stay_exact(spark):
    rows = [(0, [1e300, 0.0]), (1, [1e300, 1.0]), (2, [-1e30, 5.0]), (3, [0.5, 0.25]), (4, [1e307, -1e307]), (5, [2e5, 3.0])]
    for k in (1, 3):
        settings = C.Settings(k=k, dims=2, rounds=3)
        assert run(spark, rows, settings) == brute(rows, settings)


def test_few_vectors_and_none(spark):
    settings = C.Settings(k=8, dims=2, rounds=3)
    rows = [(1, [0.1, 0.2]), (2, [0.1, 0.2]), (3, [9.0, 9.0])]
    got, points = run(spark, rows, settings)
    assert len(points) == 3 and (got, points) == brute(rows, settings)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    out = C.with_inertia(*C.cluster(empty, settings))
    assert out.collect() == [] and out.columns[0] == "vec_id"


def test_search_equals_all_distances_and_skips_most():
    """Lattice points make ties at the pruning radius; close centroids make most of the tree needless."""
    dice = np.random.default_rng(3)
    points = dice.integers(0, 7, (300, 3)).astype(float)
    vectors = dice.integers(0, 7, (2000, 3)).astype(float)
    every = ((vectors[:, None, :] - points[None]) ** 2).sum(-1)
    for leaf in (1, 2, 5):
        best, least, tried = C.nearest(C.grow(points, leaf), vectors)
        assert (best == every.argmin(1)).all() and (least == every.min(1)).all()
        assert tried < 0.2 * every.size


def test_parts_of_a_sum_that_is_too_long():
    for total in (0, -1, 2**61, 2**62, -(2**62) - 1, 2**300 + 12345, -(2**300)):
        parts = C.limbs(total)
        assert sum(p << (32 * i) for i, p in enumerate(parts)) == total
        assert all(-(2**63) <= p < 2**63 for p in parts)
