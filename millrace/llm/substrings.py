"""Substring dedup: repeated passages of many words, by super-k-mer partitioning.

A window is ``width`` consecutive words. Its minimiser is the smallest hash among the runs of
``seed`` words inside it. Consecutive windows with one minimiser form a super-k-mer: their words
travel together, as one string, to the minimiser's bucket, so a window costs a few words and not
fifty. Equal windows have equal minimisers and meet in a bucket, where sorting brings them together
and their bytes are compared.

A chunk of documents sends each distinct string once, with the smallest id that has it. The bucket
answers which windows of the string start in a smaller document elsewhere. What is common therefore
travels once for each chunk.

A minimiser that many different strings share, such as one inside a short passage that every document
wraps in other words, would fill its bucket. Strings are counted by minimiser beforehand; where they
are too many their windows are sent one by one, as 128-bit digests dealt by digest, so that only equal
windows still meet. The bytes of these are not compared: 10**12 windows collide with chance 10**-15.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import (
    ANSWERED,
    ASKED,
    asked_table,
    chunk_count,
    deal,
    in_order,
    pack_bytes,
    unpack_bytes,
)
from millrace.llm.words import Words, grams, mix, powers, slices, split, utf8


@dataclass(frozen=True)
class Settings:
    """A minimiser of more than ``most`` strings is split. Slices that hold at most ``few`` of its strings
    do not count them, so an unsplit one has ``most`` strings and ``few`` a slice more at worst."""

    width: int = 50
    seed: int = 8
    chunk_bytes: int = 5 << 20
    most: int = 1 << 16
    few: int = 8


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(words: Words, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of each super-k-mer, in order of the words."""
    counts = words.counts()
    short = counts < settings.width
    seeds, _ = grams(words, settings.seed, short=False)
    if short.all():
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    # a hash for every word position; those whose run would leave the text never lie in a window
    at_word = np.full(len(words.start) + settings.width, np.iinfo(np.uint64).max, np.uint64)
    runs = np.maximum(counts - settings.seed + 1, 0)
    where = np.arange(runs.sum()) + np.repeat(words.first[:-1] - (np.cumsum(runs) - runs), runs)
    at_word[where] = seeds
    least = sliding_min(at_word, settings.width - settings.seed + 1)
    windows = np.where(short, 0, counts - settings.width + 1)
    owner = np.repeat(np.arange(len(counts)), windows)
    start = np.arange(windows.sum()) + np.repeat(words.first[:-1] - (np.cumsum(windows) - windows), windows)
    least = least[start]
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return start[at], np.diff(np.append(at, len(start))), least[at]


def hot_minimisers(docs: DataFrame, settings: Settings) -> np.ndarray:
    """Minimisers, sorted, whose distinct strings are too many for one bucket.

    Counted where the texts lie, one row for each slice and frequent minimiser is shuffled; what
    comes back is at most one in ``most`` of all strings.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in slices(texts, settings.chunk_bytes):
                words = split(texts[a:b])
                start, windows, least = super_kmers(words, settings)
                up, down = powers(len(words.start) + 1)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(words.code * up[: len(words.start)])])
                string = (sums[start + windows + settings.width - 1] - sums[start]) * down[start]
                _, one = np.unique(mix(string) ^ least, return_index=True)
                names, times = np.unique(least[one], return_counts=True)
                often = times > settings.few
                yield pa.record_batch(
                    [pa.array(names[often].view(np.int64)), pa.array(times[often])], ["least", "strings"]
                )

    counts = docs.select("text").mapInArrow(counted, "least long, strings long").groupBy("least")
    found = counts.agg(F.sum("strings").alias("strings")).where(F.col("strings") > settings.most).collect()
    return np.sort(np.array([r.least for r in found], np.int64).view(np.uint64))


def _by_bucket(bucket: np.ndarray, which: np.ndarray) -> dict[int, np.ndarray]:
    order = which[np.argsort(bucket[which], kind="stable")]
    parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
    return {int(bucket[p[0]]): p for p in parts}


class Chunk:
    """The super-k-mers of a chunk's documents and the distinct strings among them.

    Strings of ``hot`` minimisers are told by the windows they are made of, ``digests``; buckets of
    these come after the others.
    """

    def __init__(self, table: pa.Table, buckets: int, settings: Settings, hot: np.ndarray) -> None:
        self.ids, texts = in_order(table)
        # one space between words, so that a window has one spelling
        self.texts = [b" ".join(t.split()) for t in texts]
        known = [t if i is not None else b"" for i, t in zip(self.ids, self.texts)]
        self.words = words = split(known)
        self.start, self.windows, least = super_kmers(words, settings)
        owner = np.searchsorted(words.first, self.start, "right") - 1
        raw = words.data.tobytes()
        begin = words.start[self.start].tolist()
        end = words.end[self.start + self.windows + settings.width - 2].tolist()
        number: dict[bytes, int] = {}
        self.string = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(begin, end)], np.int64)
        self.strings = list(number)
        _, first = np.unique(self.string, return_index=True)
        ids = np.array([-1 if i is None else i for i in self.ids], np.int64)
        self.doc = ids[owner]  # ascending, so the first run of a string has its smallest id
        self.smallest, self.count = self.doc[first], self.windows[first]
        split_up = np.isin(least[first], hot)
        self.buckets = _by_bucket(least[first] % np.uint64(buckets), np.flatnonzero(~split_up))
        known_as: dict[bytes, int] = {}
        self.windows_of: dict[int, np.ndarray] = {}
        least_id: list[int] = []
        for k in np.flatnonzero(split_up).tolist():
            at = self.start[first[k]] + np.arange(self.count[k])
            spans = zip(words.start[at].tolist(), words.end[at + settings.width - 1].tolist())
            found = [known_as.setdefault(xxhash.xxh3_128_digest(raw[a:b]), len(known_as)) for a, b in spans]
            # strings come by ascending smallest id, so a window is first met with its own
            least_id += [self.smallest[k]] * (len(known_as) - len(least_id))
            self.windows_of[k] = np.array(found, np.int64)
        self.digests = np.frombuffer(b"".join(known_as), np.uint64).reshape(-1, 2)
        self.least_id = np.array(least_id, np.int64)
        spread = self.digests[:, 0] % np.uint64(buckets) + np.uint64(buckets)
        self.digest_buckets = _by_bucket(spread, np.arange(len(self.digests)))


def _asked(chunk: int, held: Chunk) -> pa.Table:
    rows = [
        pack_bytes(
            np.int64(len(part)).tobytes()
            + held.smallest[part].tobytes()
            + b"\n".join(held.strings[k] for k in part)
        )
        for part in held.buckets.values()
    ]
    rows += [
        pack_bytes(held.digests[part].tobytes() + held.least_id[part].tobytes())
        for part in held.digest_buckets.values()
    ]
    return asked_table(chunk, [*held.buckets, *held.digest_buckets], rows)


def earlier(strings: list[bytes], smallest: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each string: does it start in a document below the string's smallest?

    Returns the flags, one after the other, and the bounds of each string's windows.
    """
    words = split(strings)
    windows = words.counts() - width + 1
    bounds = np.concatenate([[0], np.cumsum(windows)])
    owner = np.repeat(np.arange(len(strings)), windows)
    start = np.arange(bounds[-1]) + np.repeat(words.first[:-1] - bounds[:-1], windows)
    up, down = powers(len(words.start) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words.code * up[: len(words.start)])])
    code = mix((sums[start + width] - sums[start]) * down[start])
    order = np.argsort(code)
    new = np.append(True, code[order[1:]] != code[order[:-1]])
    group = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    doc = smallest[owner]
    least = np.minimum.reduceat(doc[order], at)
    # where hashes agree, bytes decide; equal hashes of different windows are told apart
    raw, begin, end = words.data.tobytes(), words.start[start], words.end[start + width - 1]
    members = np.flatnonzero(~new)
    mine, heads = order[members], order[at[group[members]]]
    same = np.ones(len(members), bool)
    for at_once in range(0, len(members), 1 << 14):
        part = slice(at_once, at_once + (1 << 14))
        spans = zip(*(x.tolist() for x in (begin[mine[part]], end[mine[part]], begin[heads[part]], end[heads[part]])))
        same[part] = [raw[a:b] == raw[c:d] for a, b, c, d in spans]
    flags = np.zeros(len(start), bool)
    flags[order] = least[group] < doc[order]
    for g in np.unique(group[members[~same]]):
        inside = order[at[g] : at[g + 1] if g + 1 < len(at) else len(order)]
        apart: dict[bytes, list[int]] = {}
        for k in inside:
            apart.setdefault(raw[begin[k] : end[k]], []).append(k)
        for twins in apart.values():
            flags[twins] = doc[twins].min() < doc[twins]
    return flags, bounds


def earlier_digests(digests: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    """For each digest: does an equal one have a smaller id?"""
    order = np.lexsort((digests[:, 0], digests[:, 1]))
    there = digests[order]
    new = np.append(True, (there[1:] != there[:-1]).any(axis=1))
    least = np.minimum.reduceat(smallest[order], np.flatnonzero(new))
    flags = np.zeros(len(order), bool)
    flags[order] = least[np.cumsum(new) - 1] < smallest[order]
    return flags


def _answers(table: pa.Table, buckets: int, width: int) -> pa.Table:
    order = sorted(range(table.num_rows), key=lambda k: table["chunk"][k].as_py())
    blocks = [unpack_bytes(table["asked"][k].as_py()) for k in order]
    if table["bucket"][0].as_py() >= buckets:
        sizes = [len(b) // 24 for b in blocks]
        digests = np.concatenate([np.frombuffer(b[: 16 * n], np.uint64) for b, n in zip(blocks, sizes)])
        smallest = np.concatenate([np.frombuffer(b[16 * n :], np.int64) for b, n in zip(blocks, sizes)])
        flags = earlier_digests(digests.reshape(-1, 2), smallest)
        ends = np.cumsum(sizes)
    else:
        sizes = [int(np.frombuffer(b[:8], np.int64)[0]) for b in blocks]
        smallest = np.concatenate([np.frombuffer(b[8 : 8 + 8 * n], np.int64) for b, n in zip(blocks, sizes)])
        strings = [s for b, n in zip(blocks, sizes) for s in b[8 + 8 * n :].split(b"\n")]
        flags, bounds = earlier(strings, smallest, width)
        ends = bounds[np.cumsum(sizes)]
    answers = np.split(flags, ends[:-1])
    hit = [k for k, a in enumerate(answers) if a.any()]
    return pa.table({
        "chunk": pa.array([table["chunk"][order[k]].as_py() for k in hit], pa.int64()),
        "bucket": pa.array([table["bucket"][order[k]].as_py() for k in hit], pa.int64()),
        "answer": pa.array([pack_bytes(np.packbits(answers[k]).tobytes()) for k in hit], pa.binary()),
    })


def _removed(held: Chunk, answers: pa.Table, width: int) -> np.ndarray:
    """Which words of the chunk lie in a window that a smaller document has."""
    flags = [np.zeros(n, bool) for n in held.count]
    there = np.zeros(len(held.digests), bool)
    for bucket, answer in zip(answers["bucket"].to_pylist(), answers["answer"].to_pylist()):
        bits = np.unpackbits(np.frombuffer(unpack_bytes(answer), np.uint8)).astype(bool)
        if bucket in held.digest_buckets:
            part = held.digest_buckets[bucket]
            there[part] = bits[: len(part)]
            continue
        part = held.buckets[bucket]
        at = 0
        for k in part:
            flags[k] = bits[at : at + held.count[k]]
            at += held.count[k]
    for k, windows in held.windows_of.items():
        flags[k] = there[windows] | (held.least_id[windows] < held.smallest[k])
    starts = np.zeros(len(held.words.start) + 1, bool)
    copy = held.doc > held.smallest[held.string] if len(held.string) else np.zeros(0, bool)
    for k, (first, n, string) in enumerate(zip(held.start, held.windows, held.string)):
        if copy[k]:
            starts[first : first + n] = True
        elif flags[string].any():
            starts[first : first + n] = flags[string]
    before = np.concatenate([[0], np.cumsum(starts)])
    word = np.arange(len(held.words.start))
    return before[word + 1] > before[np.maximum(word - width + 1, 0)]


def drop_repeats(docs: DataFrame, settings: Settings = Settings(), *, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, n_words, n_removed, kept_sha256`` and,
    with ``with_text``, ``kept_text``.

    A word goes when it lies in a window whose words also start in a document with a smaller id;
    windows are those of the input. Kept words are joined by one space. Of repeated rows with one id
    none is smaller, so both stay; a row without id removes nothing and keeps everything. NULL
    texts and texts shorter than a window lose nothing. Other columns are not read.
    """
    chunks = chunk_count(docs, settings.chunk_bytes)
    buckets, width = 2 * chunks, settings.width
    # a bounded number of them, at most one in ``most`` strings
    hot = docs.sparkSession.sparkContext.broadcast(hot_minimisers(docs, settings))
    dealt = deal(docs, chunks)

    def ask(table: pa.Table) -> pa.Table:
        return _asked(table["chunk"][0].as_py(), Chunk(table, buckets, settings, hot.value))

    def reply(table: pa.Table) -> pa.Table:
        return _answers(table, buckets, width)

    def finish(mine: pa.Table, answers: pa.Table) -> pa.Table:
        held = Chunk(mine, buckets, settings, hot.value)
        gone = _removed(held, answers, width)
        first = held.words.first
        before = np.concatenate([[0], np.cumsum(gone)])
        lost = before[first[1:]] - before[first[:-1]]
        words, kept = [], []
        for d, text in enumerate(held.texts):
            parts = text.split()
            words.append(len(parts))
            if lost[d]:
                text = b" ".join(w for w, g in zip(parts, gone[first[d] : first[d + 1]].tolist()) if not g)
            kept.append(text)
        columns = {
            "doc_id": pa.array(held.ids, pa.int64()),
            "n_words": pa.array(words, pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept]),
        }
        if with_text:
            columns["kept_text"] = pa.array([t.decode("utf-8", "replace") for t in kept])
        return pa.table(columns)

    asked = dealt.groupBy("chunk").applyInArrow(ask, ASKED)
    answers = asked.groupBy("bucket").applyInArrow(reply, ANSWERED).repartition(chunks, "chunk")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)
