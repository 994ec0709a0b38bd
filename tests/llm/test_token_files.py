"""Ids against the tokenizer itself, files against what went in, and damage that must not go unseen."""

from __future__ import annotations

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_coder, token_files
from millrace.session import scratch_root

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def slow():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def folder_of(spark):
    return f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"


def blocks_of(kind, seed):
    dice = np.random.default_rng(seed)
    n = int(dice.integers(0, 900))
    return {
        "even": lambda: dice.integers(0, 65536, n),
        "few": lambda: dice.integers(0, 3, n),
        "one": lambda: np.full(n, 65535),
        "zipf": lambda: dice.zipf(1.2, n) % 49408,
        "turns": lambda: np.tile([5, 70, 5, 900], n)[:n],
    }[kind]().astype(np.uint16)


@pytest.mark.parametrize("kind", ["even", "few", "one", "zipf", "turns"])
def test_blocks_come_back(kind):
    blocks = [blocks_of(kind, k) for k in range(40)] + [np.zeros(0, np.uint16), np.array([1], np.uint16)]
    packed = token_coder.encode(blocks)
    again = token_coder.decode(packed, [len(b) for b in blocks])
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(blocks, again))
    # a block is coded alike whatever stands beside it, and can be read alone
    alone = token_coder.encode(blocks[7:8])
    assert alone == packed[7:8] and (token_coder.decode(alone, [len(blocks[7])])[0] == blocks[7]).all()
    if kind in ("few", "one", "turns"):
        assert sum(map(len, packed)) < 0.4 * sum(2 * len(b) for b in blocks)


def test_no_blocks():
    assert token_coder.encode([]) == [] and token_coder.decode([], []) == []
    assert token_coder.encode([np.zeros(0, np.uint16)]) == [b""]


def test_ids_are_those_of_the_tokenizer(slow, monkeypatch):
    monkeypatch.setattr(token_files, "_PIECE", 50)
    dice = random.Random(2)
    letters = "abcXYZ 012 .,!\'s\'ll \t\n\u00a0\u2003e\u0301\u00c9\u03a3\u03c3\u0130\u4f60\u00df<|endoftext|>\x1c\x0b\x85"
    texts = ["", " ", "I'LL  go\u00a0there", "<|endoftext|>x <|startoftext|>", "\u0301 a\u0301", "x" * 300, "\u039f\u0394\u039f\u03a3 \u039f\u03a3."]
    texts += ["".join(dice.choice(letters) for _ in range(dice.randrange(200))) for _ in range(300)]
    encode = token_files.Encoder(open(VOCABULARY, "rb").read())
    for text in texts:
        parts = [p.tolist() for p in encode.parts(text)]
        assert [*sum(parts, []), 2] == slow(text)
    ids, sizes = encode(texts)
    assert sizes.tolist() == [len(slow(t)) - 1 for t in texts]
    assert ids.tolist() == [i for t in texts for i in slow(t)[:-1]]


def test_files_against_the_tokenizer(spark, docs_of, slow):
    dice = random.Random(5)
    words = [f"{a}{b}" for a in ("the", "un", "Zor", "q") for b in ("", "ing", "s,", "ed.", "42")]
    rows = [(i, " ".join(dice.choice(words) for _ in range(dice.randrange(60)))) for i in range(300)]
    rows += [(3, "again"), (3, "again"), (None, "nobody"), (None, None), (400, None), (401, ""), (402, "long text " * 4000)]
    dice.shuffle(rows)
    folder = folder_of(spark)
    settings = token_files.Settings(file_bytes=9000, block=64, lanes=16)
    held = token_files.write(docs_of(rows), folder, VOCABULARY, settings).collect()
    found = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    assert len(held) > 3 and sum(r.docs for r in held) == len(rows)
    at = 0
    for r in found:
        assert r.start == at and len(r.tokens) == 4 * r.n_tokens
        at += r.n_tokens
    assert at == sum(r.tokens for r in held)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    got = sorted((r.doc_id or -1, r.n_tokens, zlib.crc32(bytes(r.tokens))) for r in found)
    want = [(i or -1, slow(t)) for i, t in rows]
    assert got == sorted((i, len(x), zlib.crc32(np.array(x, "<u4"))) for i, x in want)


def test_an_empty_table_gives_no_file(spark, docs_of):
    folder = folder_of(spark)
    assert token_files.write(docs_of([]), folder, VOCABULARY).collect() == []
    assert token_files.read(spark, folder).collect() == []


def test_starts_of_many_files(spark):
    rows = [(k * 3, f"f{k}", 1, k % 7, 1) for k in range(100)]
    held = spark.createDataFrame(rows, token_files._FILES)
    found = {r.part: r.start for r in token_files.with_starts(held, group=8).collect()}
    assert [found[k * 3] for k in range(100)] == [sum(j % 7 for j in range(k)) for k in range(100)]


def test_damage_is_found(spark, docs_of, tmp_path):
    """Every byte of a file matters: whichever is changed, reading fails or says so."""
    folder = str(tmp_path / "files")
    rows = [(i, f"some words and number {i} " * 3) for i in range(12)]
    name = token_files.write(docs_of(rows), folder, VOCABULARY, token_files.Settings(block=32)).first().file
    path = tmp_path / "files" / name
    good = path.read_bytes()
    before = [(i, x.tolist()) for i, x, _ in token_files.read_file(folder, name)]
    dice = random.Random(1)
    for at in [0, 5, 9, len(good) - 1, *dice.sample(range(len(good)), 60)]:
        path.write_bytes(good[:at] + bytes([good[at] ^ (1 << dice.randrange(8))]) + good[at + 1 :])
        try:
            after = [(i, x.tolist()) for i, x, _ in token_files.read_file(folder, name)]
        except Exception:
            continue
        assert after == before, at
    path.write_bytes(good[:-20])
    with pytest.raises(ValueError):
        list(token_files.read_file(folder, name))


def test_runs_that_differ_in_case_or_signs_are_encoded_once():
    encode = token_files.Encoder(open(VOCABULARY, "rb").read())
    encode._forget()
    ids, sizes = encode(["Some words, some (WORDS): 1212 words."] * 3)
    assert sorted(encode._place) == sorted([b"some", b"words", b",", b"(", b"):", b"1", b"2", b"."])
    assert sizes.tolist() == [13] * 3 and len(ids) == 39
    # a letter that a mark joins with, and the letters of a special token, stay as they are
    encode(["W̊", "<|ENDOFTEXT|> Word"])
    assert {"W̊".encode(), b"<|ENDOFTEXT|>", b"Word"} <= set(encode._place)


def test_short_blocks_share_what_order_0_knows():
    dice = np.random.default_rng(4)
    blocks = [(dice.zipf(1.3, 64) % 40000).astype(np.uint16) for _ in range(300)] + [np.zeros(0, np.uint16)]
    table, packed = token_coder.encode_together(blocks)
    sizes = [len(b) for b in blocks]
    again = token_coder.decode_together(table, packed, sizes)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(blocks, again))
    # any of them can be read without the others, and all take less room than each with its own table
    assert (token_coder.decode_together(table, packed[5:6], sizes[5:6])[0] == blocks[5]).all()
    assert len(table) + sum(map(len, packed)) < 0.75 * sum(map(len, token_coder.encode(blocks)))
    damaged = bytearray(packed[5])
    damaged[3] ^= 16
    found = token_coder.decode_together(table, [bytes(damaged)], sizes[5:6])[0]
    assert len(found) == 64 and (found != blocks[5]).any()
