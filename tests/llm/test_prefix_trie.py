"""The trie against one built from lists, with sketches that are ample and far too small."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import prefix_trie as T


def brute(rows):
    """Nodes of the trie of (conv_id, turn, role, text) rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            digest = hashlib.sha256(f"{len(r.encode())}:{r}:{t}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, r, digest, t))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        under = [k for k in nodes if k[: len(key)] == key]
        children = [k for k in under if len(k) == len(key) + 1]
        leaves = [k for k in under if not any(m[: len(k)] == k and len(m) == len(k) + 1 for m in under)]
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in under if k)
        end = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(key))
        parent = min(nodes[key[:-1]]) if key else None
        sha = hashlib.sha256(end.encode()).hexdigest()
        out.append((min(members), len(key), parent, len(members), len(children), len(leaves), saved, sha))
    return sorted(out, key=str)


def run(spark, rows, settings=T.Settings()):
    schema = "conv_id long, turn long, role string, text string, prefix string, depth int"
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    c = F.col("conv_id")
    whole = T.rebuilt(T.turns_of(table), c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6, 5)
    return sorted((tuple(r) for r in T.trie(whole, settings).collect()), key=str)


def conversations(seed, ids):
    dice = random.Random(seed)
    rows = []
    for c in ids:
        for turn in range(dice.randrange(1, 9)):
            text = dice.choice(["", "a", "hello there", "\u00e9\U0001f600", None, f"only {c} {turn}", f"only {c} {turn}"])
            rows.append((c, dice.choice([turn, turn, None, 3]), dice.choice(["user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("cells", [1 << 24, 1 << 10])
def test_against_brute_force(spark, cells):
    ids = [*range(30), *range(100, 130), *range(-120, -95), *range(205, 215), 10**15 + 7]
    rows = conversations(1, ids)
    rows += [(None, 0, "user", "nobody"), *[(c, t, "user", f"same {t}") for c in (400, 401, 402, 455) for t in range(7)]]
    random.Random(2).shuffle(rows)
    assert run(spark, rows, T.Settings(cells=cells, text_bytes=20)) == brute(rows)


def test_all_equal_and_all_different(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(6)]
    assert run(spark, same, T.Settings(text_bytes=20)) == brute(same)
    apart = [(c, t, "user", f"{c} {t}") for c in range(7, 60_000, 997) for t in range(6)]
    assert run(spark, apart) == brute(apart)


def test_nothing_and_turnless_conversations(spark):
    assert run(spark, []) == []
    # without a base, the first turns go: these have none left
    rows = [(c, 0, "user", "x") for c in range(301, 320) if zlib.crc32(str(c).encode()) % 6 > 0]
    got = run(spark, rows)
    assert got == brute(rows) and [r[1] for r in got] == [0] and got[0][5] == 1


def test_a_long_conversation_is_a_stream(spark):
    rows = [(c, t, "user", f"step {t}") for c in (1000, 1001) for t in range(1500)]
    got = run(spark, rows)
    assert len(got) == len({r[1] for r in got}) and max(r[1] for r in got) == 1500


def test_the_sketch_never_calls_a_shared_prefix_single(spark):
    dice = np.random.default_rng(0)
    once, twice = dice.integers(0, 2**63, 3000), dice.integers(0, 2**63, 500)
    rows = [(1, 1, 1, int(k).to_bytes(8, "little") + b"x", 0, 0) for k in [*once, *twice, *twice]]
    found = spark.createDataFrame(rows, T._PREFIX)
    for cells in (1 << 10, 1 << 20):
        shared = T.sketch(found, T.Settings(cells=cells)).shared
        assert shared(twice.astype(np.uint64)).all()
    assert shared(once.astype(np.uint64)).mean() < 0.02
