from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import vectors
from millrace.session import scratch_root


def brute(rows, cosine=0.9):
    ids = [i for i, _ in rows]
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        new = np.minimum(label, np.where(linked, label, 2**60).min(axis=1))
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), label)}
        label = new


def clustered(seed, n, d=12):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(n // 12, d))
    x = centres[dice.integers(0, len(centres), n)] + dice.normal(size=(n, d)) * dice.choice([0.05, 0.3, 1.0], n)[:, None]
    x[n // 2 : n // 2 + 20] = x[0]  # copies
    x[n // 2 + 20] = x[0] * 3.5  # the same direction
    return [(int(i), v.astype(np.float32).tolist()) for i, v in zip(dice.permutation(n), x)]


def run(spark, rows, **settings):
    table = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, v string"
    )
    return vectors.near_vectors(table, vectors.Settings(**settings)).collect()


def test_against_brute_force_with_small_blocks(spark):
    rows = clustered(1, 700)
    got = run(spark, rows, block=40, leaf=8, sorted_axes=4, box_axes=6, fan_out=2, sample=200)
    want = brute([(i, np.float32(v)) for i, v in rows])
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_far_blocks_are_skipped():
    left = np.zeros((64, 4))
    left[:, 0] = 1
    right = np.zeros((64, 4))
    right[:, 1] = 1
    calls = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            calls.extend([1] * (self.ndim > 1))
            return np.asarray(self) @ other

    assert list(vectors.join_blocks(left.view(Watched), right, False, vectors.Settings(leaf=8))) == []
    assert calls == []


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [2.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [1e-30, 0.0]), (3, [2.0, 0.0]),
        (12, [0.0, 1.0]), (13, [-1.0, 0.0]),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    lone = {k: (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 12, 13)}
    assert found == lone | {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 11: (3, 1, False), None: (0, None, True)}
    assert run(spark, []) == []


def on_disk(spark):
    """Bytes of shuffle files, and of tables in the shared folder."""
    shuffled = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    kept = f"{scratch_root(spark).removeprefix('file://').removeprefix('file:')}/llm"
    return [sum(os.path.getsize(f"{d}/{f}") for top in tops for d, _, names in os.walk(top) for f in names) for tops in (shuffled, [kept])]


def test_even_vectors_are_moved_and_kept_once_and_not_for_each_pair_of_blocks(spark):
    x = np.random.default_rng(5).normal(size=(4000, 64)).astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    key = "spark.sql.autoBroadcastJoinThreshold"
    usual, before = spark.conf.get(key), on_disk(spark)
    spark.conf.set(key, "-1")  # as blocks of a table that is not small
    try:
        got = vectors.near_vectors(table, vectors.Settings(block=128)).collect()  # 32 blocks, no pair of them is skipped
    finally:
        spark.conf.set(key, usual)
    shuffled, kept = (b - a for a, b in zip(before, on_disk(spark)))
    assert len(got) == 4000 and all(r.n_links == 0 and r.kept for r in got)
    assert kept > x.nbytes  # the folder is the right one
    assert shuffled + kept < 4 * x.nbytes


def test_doubles_copies_and_signed_zeros_against_brute_force(spark):
    rows = [(i, v) for i, v in clustered(3, 260, 5)]
    zero, hot = [0.0, 1.0, 0.0, 0.0, 0.0], rows[7][1]
    rows += [(1000, zero), (1001, [-0.0, 1.0, 0.0, -0.0, 0.0]), *((2000 + k, hot) for k in range(150))]
    table = spark.createDataFrame(rows + rows[:40], "vec_id long, embedding array<double>").repartition(7)
    got = vectors.near_vectors(table, vectors.Settings(block=16, leaf=4, fan_out=2, strip=2)).collect()
    assert len(got) == len(rows) + 40
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("leaf, spread", [(32, 0.3), (20, 0.3), (64, 0.01)])
def test_links_of_two_blocks_against_all_products(same, leaf, spread):
    dice = np.random.default_rng(leaf)
    centres = dice.normal(size=(9, 64))
    x, y = (centres[dice.integers(0, 9, n)] + spread * dice.normal(size=(n, 64)) for n in (333, 517))
    y = x if same else y
    settings = vectors.Settings(leaf=leaf, strip=3)
    turn = vectors._turn(dice.normal(size=(3000, 64)), settings)
    assert turn.lead < 64  # so bounds come first
    found = [(i, j) for a, b in vectors.join_blocks(x, y, same, settings, turn) for i, j in zip(a.tolist(), b.tolist())]
    p, q = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
    want = {(i, j) for i, j in np.argwhere(p @ q.T >= 0.9).tolist() if not same or i < j}
    assert len(found) == len(set(found)) and set(found) == want and want


def test_the_place_of_a_vector_does_not_depend_on_the_rows_around():
    dice = np.random.default_rng(2)
    x = dice.normal(size=(300, 24)).astype(np.float32).tolist()
    x[5:7] = [[None] * 24, [0.0] * 24]
    axes = vectors.principal_axes(np.array(dice.normal(size=(200, 24))))
    ids, column = pa.array([None, *range(1, 300)], pa.int64()), pa.array(x, pa.list_(pa.float32()))

    def places(a, b):
        return vectors._places(ids.slice(a, b - a), column.slice(a, b - a), axes, vectors.Settings())[0]

    whole = places(0, 300)
    assert whole == [p for k in range(0, 300, 7) for p in places(k, min(300, k + 7))]
    assert [k for k, p in enumerate(whole) if p is None] == [0, 5, 6] and len({*whole}) == 298
