from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import language_model as lm


def made(seed, n=200):
    """Texts in which a word tells much about the next."""
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        word, words = dice.randrange(50), []
        for _ in range(dice.randrange(0, 60)):
            words.append(dice.choice([f"W{word}", f"w{word}", f"é{word}"]))
            word = (word * 7 + dice.randrange(3)) % 50
        rows.append((i, " ".join(words)))
    return rows


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_against_brute_force_over_many_chunks(docs_of):
    rows = [*made(1), (900, None), (901, "w1 " * 30_000), (5, "w1 w2"), (None, "w1")]
    got = lm.score(docs_of(rows), F.col("doc_id") % 5 != 1, lm.Settings(chunk_bytes=4000)).collect()
    assert len(got) == len(rows)
    counts = Counter(w for i, t in rows if i is not None and i % 5 != 1 for w in tokens(t))
    total, known = counts.total(), len(counts)
    want = {}
    for i, t in rows:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (known + 1))) for w in tokens(t))
        want.setdefault(i, []).append((len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(base, 6)))
    found = {}
    for r in got:
        assert r.train_tokens == total
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, round(r.base_score, 6)))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    held = [r for r in got if r.doc_id is not None and r.doc_id % 5 == 1 and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    """Over all known tokens and one unknown, after any context."""
    texts = [t.encode() for _, t in made(2, 40)]
    held = lm.Tokens(texts, 2)
    counts = held.times
    total = held.n
    known = [w for w in {w for t in texts for w in tokens(t.decode())} if w is not None]
    weights = np.array([0.1, 0.5, 0.4])
    for context in known[:10]:
        heavy = lm.Tokens([context + b" " + w for w in known] + [context, context + b" unknown"], 2)
        place = np.searchsorted(held.keys, heavy.keys)
        same = (place < len(held.keys)) & (held.keys[np.minimum(place, len(held.keys) - 1)] == heavy.keys)
        found = np.where(same, counts[np.minimum(place, len(counts) - 1)], 0)
        estimates, seen = heavy.estimates(found, total)
        second = heavy.first[:-1] + 1
        assert (seen[second] > 0).all()
        mass = weights[0] / (len(known) + 2) + weights[1:] @ estimates[:, second]
        assert abs(mass.sum() - 1) < 1e-9


def test_weights_follow_the_held_out_counts():
    order = 2
    strong, weak = lm.quantised(np.array([[0.001], [0.9]]))[:, 0], lm.quantised(np.array([[0.05], [0.0]]))[:, 0]
    cell = lambda bucket, level: (bucket * 256 + level[1]) * 256 + level[0]
    weights = lm.learn(np.array([cell(9, strong), cell(1, weak)]), np.array([5000, 5000]), order, 1e-4, 80)
    assert weights[9][2] > 0.95 and weights[1][1] > 0.95
    assert np.allclose(weights.sum(axis=1), 1) and (weights > 0).all()


def test_third_order_and_nothing_to_learn(docs_of):
    rows = made(3, 60)
    got = lm.score(docs_of(rows), F.col("doc_id") % 5 != 1, lm.Settings(order=3)).collect()
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    none = lm.score(docs_of(rows[:3]), F.lit(None).cast("boolean")).collect()
    assert [(r.base_score, r.score, r.n_known, r.trains) for r in none] == [(0, 0, 0, False)] * 3
    assert lm.score(docs_of([]), F.lit(True)).count() == 0
