from __future__ import annotations

import random

import numpy as np

from millrace.llm import toxicity

WORDS = [f"w{k}" for k in range(400)]


def corpus(n, seed):
    dice = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = dice.random() < 0.2
        words = [dice.choice(WORDS) for _ in range(dice.randrange(20, 200))]
        if toxic:
            for _ in range(4):
                words.insert(dice.randrange(len(words)), f"vile{dice.randrange(6)}")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edge_cases(spark, docs_of):
    rows, labels = corpus(1500, 1)
    known = spark.createDataFrame([*labels[:1000], (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(rows), known)
    odd = [(9000, None), (9001, ""), (9002, "vile1 " * 60_000), (None, "w1"), (9000, None)]
    got = toxicity.score(docs_of([*rows[1000:], *odd]), model)
    assert got.columns.count("score") == 1
    scores = {}
    for r in got.collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        scores[r.doc_id] = r.predicted
    truth = dict(labels[1000:])
    assert np.mean([scores[i] == truth[i] for i in truth]) > 0.98
    assert scores[9000] == scores[9001] == 0


def test_correction_keeps_the_risk_of_unlabelled_text_non_negative():
    rows, labels = corpus(800, 2)
    texts = [t.encode() for _, t in rows]
    positive = [t for t, (_, y) in zip(texts, labels) if y]
    model = toxicity.fit(
        toxicity.features(positive), toxicity.features(texts), 0.2, toxicity.Settings(steps=800, min_z=0.0)
    )
    p, u = model.scores(positive), model.scores(texts)
    assert (-np.log1p(-u)).mean() - 0.2 * (-np.log1p(-p)).mean() > -0.05


def test_nothing_to_learn(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs_of([(1, "a")]), none)
    assert [r.predicted for r in toxicity.score(docs_of([(1, "a"), (2, None)]), model).collect()] == [0, 0]
    assert toxicity.score(docs_of([]), model).count() == 0
