from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.bpe import Encoder

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a <|endoftext|> b", "x\n\n  y  z", "it's  'll   x \x1c y", " a", "a ", "", "\n a\n", "don't we'll 'tis x's 12ab",
    "a\x85 b c\x85", "\U0001f600 é\u0000", "é" * 3000,
]


def test_ids_are_those_of_the_tokenizer_file(spark):
    slow = Tokenizer.from_file(FILE)
    with open(FILE, "rb") as file:
        fast = Encoder(file.read())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*ODD, *texts]:
        assert fast(text).tolist() == [*slow.encode(text, add_special_tokens=False).ids, 1]


def test_every_id_lies_in_one_piece(docs_of):
    rows = [(i, ("word%d and more " % (i % 7)) * (i * 13 % 300)) for i in range(60)]
    rows += [(None, "no id"), (3, "again"), (100, None), (101, ""), (102, "long text " * 20_000)]
    slow = Tokenizer.from_file(FILE)
    settings = packing.Settings(shard_tokens=20_000)
    pieces = packing.pack(docs_of(rows), FILE, settings).collect()
    ids = {}
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4"))
        ids.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.ids))
    for i, t in rows:
        want = [*slow.encode(t or "", add_special_tokens=False).ids, 1]
        got = sorted(ids[(i, len(want))])
        if (i, t) in (( 101, ""), (100, None)):
            assert want == [1]
        assert [x for _, part in got for x in part] == want
        assert [s for s, _ in got] == np.cumsum([0, *(len(part) for _, part in got)])[:-1].tolist()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total <= 2048 and total & (total - 1) == 0  # no padding at all


def test_neighbours_are_those_of_bm25():
    dice = np.random.default_rng(1)
    docs = [dice.integers(0, 60, dice.integers(5, 40)).astype(np.uint16) for _ in range(50)]
    settings = packing.Settings(terms=10**6, neighbours=49)
    index = packing.Index(docs, settings)
    mean = np.mean([len(d) for d in docs])
    held = {t: sum(t in d for d in docs) for t in range(60)}

    def bm25(query, d):
        score = 0.0
        for t in set(query.tolist()):
            tf = (d == t).sum()
            idf = np.log(1 + (50 - held[t] + 0.5) / (held[t] + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        return score

    used = np.zeros(50, bool)
    used[[0, 7, 9]] = True
    got = index.neighbours(0, used)
    want = sorted((k for k in range(50) if not used[k]), key=lambda k: (-round(bm25(docs[0], docs[k]), 9), k))
    assert got.tolist() == [k for k in want if bm25(docs[0], docs[k]) > 0][: len(got)]
    assert len(got) >= 40


def test_empty_table(docs_of):
    assert packing.pack(docs_of([]), FILE).count() == 0


def test_default_settings_query_all_terms_with_statistics_of_the_table():
    dice = np.random.default_rng(5)
    docs = [dice.integers(0, 90, dice.integers(30, 60)).astype(np.uint16) for _ in range(80)]
    settings = packing.Settings()
    held = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=1 << 16)
    stats = packing.Stats(80, float(np.mean([len(d) for d in docs])), held)
    whole, shard = packing.Index(docs, settings), packing.Index(docs[:40], settings, stats)
    for seed in range(40):
        away = np.zeros(80, bool)
        away[[seed, *range(40, 80)]] = True
        query = set(docs[seed].tolist())

        def bm25(d):
            score = 0.0
            for t in query & set(docs[d].tolist()):
                tf = (docs[d] == t).sum()
                idf = np.log(1 + (80 - held[t] + 0.5) / (held[t] + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / stats.mean))
            return score

        want = sorted((d for d in range(40) if d != seed), key=lambda d: -bm25(d))[:8]
        assert shard.neighbours(seed, away[:40]).tolist() == want == whole.neighbours(seed, away).tolist()


def test_related_documents_meet_across_files(spark, docs_of):
    """Thirty topics, one document of each in every file; shards are far smaller than the table."""
    dice = np.random.default_rng(6)
    words = sorted(w[1:] for w in Tokenizer.from_file(FILE).get_vocab() if w[0] == "Ġ" and w[1:].isalpha())
    topics = dice.choice(words, (30, 40), replace=False)
    rows = [(k * 30 + t, " ".join(dice.choice(topics[t], 50))) for k in range(12) for t in range(30)]
    settings = packing.Settings(shard_tokens=4000, window=512)
    pieces = packing.pack(docs_of(rows).repartitionByRange(12, "doc_id"), FILE, settings, with_ids=False).collect()
    together = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        together.setdefault(p.sequence_id, []).append(p.doc_id % 30)
    pairs = [a == b for x in together.values() for a, b in zip(x, x[1:])]
    assert np.mean(pairs) > 0.7
    assert {p.doc_id for p in pieces} == {i for i, _ in rows}


def test_used_documents_leave_without_changing_what_is_found():
    dice = np.random.default_rng(7)
    docs = [dice.zipf(1.3, dice.integers(5, 90)).clip(0, 900).astype(np.uint16) for _ in range(120)]
    settings = packing.Settings()
    whole, shrinking, used = packing.Index(docs, settings), packing.Index(docs, settings), np.zeros(120, bool)
    for seed in dice.permutation(120):
        used[seed] = True
        shrinking.leave(used)
        assert shrinking.neighbours(seed, used).tolist() == whole.neighbours(seed, used).tolist()
    assert not len(shrinking.neighbours(0, used))


def test_ranges_hold_equal_tokens_also_where_many_share_a_place():
    dice = np.random.default_rng(8)
    place = np.where(dice.random(6000) < 0.4, 77, dice.integers(0, 1 << 40, 6000))
    spot, size = dice.integers(-(1 << 62), 1 << 62, 6000), dice.integers(1, 5000, 6000)
    bounds = packing.ends(place[::2], spot[::2], size[::2], 10)
    got = packing.range_of(place, spot, bounds)
    want = [sum((p, s) > tuple(b) for b in bounds.tolist()) for p, s in zip(place.tolist(), spot.tolist())]
    assert got.tolist() == want
    totals = np.bincount(got, size, 10)
    assert totals.max() < 1.2 * totals.mean() and totals.min() > 0.8 * totals.mean()
    assert packing.range_of(place, spot, packing.ends(place[:0], spot[:0], size[:0], 10)).max() == 0


def test_parts_that_repeat_are_encoded_once(monkeypatch):
    with open(FILE, "rb") as file:
        encode = Encoder(file.read())
    dice = random.Random(3)
    parts = ["a", "word", "'s", "é ", "中文", "　", "\u0085 ", " ", "  ", " ", "  ", "\n", " <|endoftext|>",
             "<|end", "12", "!?", "😀", "߿ ", "\x00", "\x1c ", "\x7f", "\r\n", ""]
    for _ in range(500):
        texts = ["".join(dice.choice(parts) for _ in range(dice.randrange(0, 14))) for _ in range(dice.randrange(0, 6))]
        got = encode.batch([t.encode() for t in texts])
        assert [x.tolist() for x in got] == [encode(t).tolist() for t in texts]
    seen, ids = [], encode._ids
    monkeypatch.setattr(encode, "_ids", lambda text: seen.append(len(text)) or ids(text))
    encode.batch([b"some words that come again " * 500] * 20)
    assert sum(seen) < 200


def test_common_terms_are_added_up_without_a_copy_of_their_rows():
    dice = np.random.default_rng(9)
    docs = [dice.permutation(np.repeat(np.arange(400), 2))[:700].astype(np.uint16) for _ in range(500)]
    index, used = packing.Index(docs, packing.Settings()), np.zeros(500, bool)
    assert index._rows.nbytes > 700_000
    tracemalloc.start()
    index.neighbours(0, used)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < index._rows.nbytes / 4
