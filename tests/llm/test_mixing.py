from __future__ import annotations

import random

import numpy as np
import pytest

from millrace.llm import mixing

WORDS = {d: [f"{d}{k}" for k in range(60)] for d in ("x", "y", "z")}
TARGETS = {"x": 0.5, "y": 0.3, "z": 0.2}


def corpus(n, seed):
    dice = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        d = dice.choices("xyz", (6, 3, 1))[0]
        rows.append((i, " ".join(dice.choice(WORDS[d]) for _ in range(dice.randrange(5, 80)))))
        labels.append((i, d))
    return rows, labels


def test_posteriors_and_totals(spark, docs_of):
    rows, labels = corpus(400, 1)
    known = spark.createDataFrame([*labels[:200], (None, "x"), (3, None), (4, "other")], "doc_id long, domain string")
    out = mixing.mix(docs_of(rows), known, TARGETS).collect()
    assert len(out) == 400
    order = list(TARGETS)
    right = [order[int(np.argmax(r.p))] == dict(labels)[r.doc_id] for r in out]
    assert np.mean(right) > 0.98
    p, t, rate = np.array([r.p for r in out]), np.array([r.n_tokens for r in out]), np.array([r.rate for r in out])
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(x.split()) for i, x in rows}
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
    got = (rate * t) @ p / t.sum()
    assert np.allclose(got, list(TARGETS.values()), atol=2e-3)


def test_rates_are_the_least_squares_fit_within_the_box(spark):
    """Against projected gradient in numpy, where the box keeps the targets out of reach."""
    dice = np.random.default_rng(4)
    p = dice.dirichlet([0.4, 0.4, 0.4], 60)
    t = dice.integers(1, 200, 60)
    rows = [(i, int(n), x.tolist()) for i, (n, x) in enumerate(zip(t, p))]
    soft = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    settings = mixing.Settings(low=0.5, high=1.2, steps=300, tolerance=1e-7)
    fitted, report = mixing.fit_rates(soft, {"a": 0.8, "b": 0.1, "c": 0.1}, 1.0, settings)
    have = t @ p
    want = t.sum() * np.array([0.8, 0.1, 0.1])

    def loss(r):
        return ((((r * t) @ p - want) ** 2) / have).sum()

    best = np.ones(60)
    for _ in range(4000):
        best = np.clip(best - 0.5 * p @ (((best * t) @ p - want) / have), 0.5, 1.2)
    rate = np.array([r.rate for r in fitted.orderBy("doc_id").collect()])
    assert (rate >= 0.5).all() and (rate <= 1.2).all()
    assert loss(rate) <= loss(best) * 1.02 + 1e-9
    assert [d for d, *_ in report] == ["a", "b", "c"]


def test_edge_cases(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = [(1, None), (2, ""), (3, "q " * 100_000), (4, "r"), (4, "r r"), (None, "s")]
    out = {r.doc_id: r for r in mixing.mix(docs_of(rows), none, TARGETS).collect()}
    assert {i: r.n_tokens for i, r in out.items()} == {1: 0, 2: 0, 3: 100_000, 4: 3, None: 1}
    assert all(np.allclose(r.p, 1 / 3) for r in out.values())
    assert mixing.mix(docs_of([]), none, TARGETS).count() == 0


def test_applied_rates(spark, docs_of):
    docs = docs_of([(i, "t") for i in range(2000)] + [(None, "t")])
    rates = spark.createDataFrame([(i, [0.0, 1.0, 2.5, 0.3][i % 4]) for i in range(2000)], "doc_id long, rate double")
    out = mixing.apply_rates(docs, rates)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times[None] == 1
    by_rate = [[times.get(i, 0) for i in range(k, 2000, 4)] for k in range(4)]
    assert set(by_rate[0]) == {0} and set(by_rate[1]) == {1} and set(by_rate[2]) == {2, 3} and set(by_rate[3]) == {0, 1}
    assert abs(np.mean(by_rate[2]) - 2.5) < 0.1 and abs(np.mean(by_rate[3]) - 0.3) < 0.1


def test_only_built_in_functions(spark, docs_of):
    known = spark.createDataFrame([(1, "x")], "doc_id long, domain string")
    soft = mixing.posteriors(docs_of([(1, "x1"), (2, "y1")]), known, list(TARGETS))
    plan = soft._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_rare_domain_reaches_its_target(spark):
    """A fiftieth of the tokens against a target of a ninth: rates beyond any fixed cap."""
    rows = [(i, 100, [0.01, 0.04, 0.95] if i % 50 == 0 else [0.6, 0.4, 0.0]) for i in range(1000)]
    rows += [(2000 + i, 100, [0.2, 0.8, 0.0]) for i in range(300)]
    soft = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    fitted, report = mixing.fit_rates(soft, {"a": 0.49, "b": 0.40, "c": 0.11})
    assert all(abs(got - want) <= 0.01 * want for _, want, got in report)
    assert fitted.agg({"rate": "max"}).first()[0] > 4


def test_a_target_out_of_reach_is_an_error(spark, docs_of):
    rows, labels = corpus(60, 3)
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    with pytest.raises(ValueError, match="z: .* target 0.9"):
        mixing.mix(docs_of(rows), known, {"x": 0.05, "y": 0.05, "z": 0.9}, 1.0, mixing.Settings(high=1.5))


def test_a_domain_nobody_belongs_to_leaves_its_target_to_the_others(spark, docs_of):
    rows, labels = corpus(300, 5)
    known = spark.createDataFrame([x for x in labels if x[1] != "z"], "doc_id long, domain string")
    out = mixing.mix(docs_of([x for x, (_, d) in zip(rows, labels) if d != "z"]), known, TARGETS).collect()
    p, t, rate = np.array([r.p for r in out]), np.array([r.n_tokens for r in out]), np.array([r.rate for r in out])
    assert np.allclose((rate * t) @ p / t.sum(), [0.5 / 0.8, 0.3 / 0.8, 0], atol=2e-3)


def test_applied_rates_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "t", 7, 8, 9), (2, "u", 7, 8, 9)], "doc_id long, text string, times int, _k int, rate int")
    rates = spark.createDataFrame([(1, 2.0), (2, 0.0)], "doc_id long, rate double")
    assert [tuple(r) for r in mixing.apply_rates(docs, rates).collect()] == [(1, "t", 7, 8, 9)] * 2


def test_shares_of_the_pipeline_on_a_skewed_input(spark, monkeypatch):
    """A third of the tokens is poor English: the stage brings it down to its target, and rows follow."""
    import corpus_pipeline as pipeline

    names, weights = list(pipeline.MIX), [40, 33, 9, 1, 9, 1, 6, 1]
    hot = [[float(j == k) for j in range(8)] for k in range(8)]
    rows = [(100_000 * k + i, 100, hot[k]) for k in range(8) for i in range(40 * weights[k])]
    soft = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    fitted, report = mixing.fit_rates(soft, pipeline.MIX, pipeline.MIX_BUDGET, pipeline.MIX_SETTINGS)
    assert mixing.missed(report, pipeline.MIX_SETTINGS) == []
    docs = soft.select("doc_id")
    left = [r.doc_id // 100_000 for r in mixing.apply_rates(docs, fitted).collect()]
    for k, name in enumerate(names):
        share = left.count(k) / len(left)
        assert abs(share - pipeline.MIX[name]) < 0.01, (name, share)
