"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of all orders up to ``order`` and a uniform share are mixed:
``P(w | context) = l0 / (V + 1) + l1 c(w) / N + l2 c(context w) / c(context) ...``. The weights
depend on how often the longest context was seen (buckets by powers of two) and are learned by
expectation-maximisation on a part of the training documents whose counts were taken out for it.
Over the V known tokens and one unknown, probabilities sum to one.

Counts meet their uses without a row for each token. A chunk of documents asks buckets of the
hash space about each distinct n-gram it holds, as packed sorted keys with its own counts; a bucket
adds up the counts of all chunks and answers in the same order. What EM needs is a histogram of
the quantised estimates, whose size is bounded by the grid and not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import (
    ASKED,
    ask_counts,
    asked_counts,
    bucket_edges,
    chunk_count,
    deal,
    from_planes,
    in_order,
    planes,
)
from millrace.llm.scratch import landed
from millrace.llm.words import mix, split

_START, _END = np.uint64(0x1B873593CC9E2D51), np.uint64(0xE6546B6485EBCA6B)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_GRID = 16  # levels of the histogram to a decade of probability
_CELLS = 256


@dataclass(frozen=True)
class Settings:
    """``deleted``: one training document in so many gives the held-out counts for the weights.

    ``order`` is 3 at most.
    """

    order: int = 2
    deleted: int = 10
    rounds: int = 60
    chunk_bytes: int = 6 << 20


@dataclass(frozen=True)
class Totals:
    """Tokens and distinct tokens, without the deleted part and in all training documents."""

    tokens_part: int
    known_part: int
    tokens: int
    known: int


class Tokens:
    """The n-grams of a chunk's documents: a distinct sorted key list, and each token's places in it.

    ``at[k]`` gives for every token the key of the (k+1)-gram that ends there; the two lowest bits
    of a key are k. ``first`` bounds the tokens of each document.
    """

    def __init__(self, texts: list[bytes], order: int) -> None:
        words = split(texts, lower=True)
        sizes = words.counts() + order  # start marks, words, one end
        begin = np.concatenate([[0], np.cumsum(sizes)])
        stream = np.full(begin[-1], _START, np.uint64)
        word = np.arange(len(words.start)) + np.repeat(begin[:-1] + order - 1 - words.first[:-1], words.counts())
        stream[word] = words.code
        stream[begin[1:] - 1] = _END
        real = np.ones(len(stream), bool)
        for k in range(order - 1):
            real[begin[:-1] + k] = False
        place = np.flatnonzero(real)
        keys = []
        for k in range(order):
            code = np.zeros(len(place), np.uint64)
            for back in range(k, -1, -1):
                code = mix(code * _STEP + stream[place - back])
            keys.append((code & ~np.uint64(3)) | np.uint64(k))
        self.first = np.concatenate([[0], np.cumsum(words.counts() + 1)])
        self.n, self.order = len(place), order
        self.keys, inverse, self.times = np.unique(
            np.concatenate(keys), return_inverse=True, return_counts=True
        )
        self.at = inverse.reshape(order, -1)
        self.opens = np.zeros(self.n, bool)
        self.opens[self.first[:-1]] = True

    def estimates(self, counts: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
        """Maximum-likelihood estimates of each order for every token, and the count of the
        longest context."""
        texts = counts[self.at[0][self.first[1:] - 1]]  # the end token counts documents
        estimates, context = [counts[self.at[0]] / max(tokens, 1)], np.zeros(self.n, np.int64)
        for k in range(1, self.order):
            context = np.zeros(self.n, np.int64)
            context[1:] = counts[self.at[k - 1][:-1]]
            context[self.opens] = texts
            estimates.append(counts[self.at[k]] / np.maximum(context, 1))
        if self.order == 1:
            context = np.full(self.n, tokens)
        return np.array(estimates), context


def context_bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the power of two of its count."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


_ANSWERED = "chunk long, bucket long, answer binary, tokens_part long, known_part long, tokens long, known long"


def _answers(table: pa.Table, kinds: tuple[int, int]) -> pa.Table:
    """Counts of every asked key, for each chunk in its own order; a bucket's totals are added once.

    Chunks below ``kinds[0]`` count in both sums, those below ``kinds[1]`` in the full one only.
    """
    chunks = table["chunk"].to_pylist()
    keys, times = zip(*(asked_counts(b.as_py()) for b in table["asked"]))
    sizes = [len(k) for k in keys]
    owner = np.repeat(chunks, sizes)
    distinct, group = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.concatenate(times).astype(np.int64)
    part = np.bincount(group, np.where(owner < kinds[0], times, 0), len(distinct)).astype(np.int64)
    full = np.bincount(group, np.where(owner < kinds[1], times, 0), len(distinct)).astype(np.int64)
    single = (distinct & np.uint64(3)) == 0
    totals = [part[single].sum(), (part[single] > 0).sum(), full[single].sum(), (full[single] > 0).sum()]
    answers = []
    for chunk, a, b in zip(chunks, np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        answer = planes(full[group[a:b]])
        if kinds[0] <= chunk < kinds[1]:
            answer = np.int64(len(answer)).tobytes() + answer + planes(part[group[a:b]])
        else:
            answer = np.int64(len(answer)).tobytes() + answer
        answers.append(answer)
    once = np.zeros((4, len(chunks)), np.int64)
    once[:, 0] = totals
    columns = [table["chunk"], table["bucket"], pa.array(answers, pa.binary()), *map(pa.array, once)]
    return pa.table(columns, [c.split()[0] for c in _ANSWERED.split(", ")])


def _counts(tokens: Tokens, answers: pa.Table, buckets: int, *, part: bool = False) -> np.ndarray:
    """The counts that the buckets gave for ``tokens.keys``."""
    by_bucket = dict(zip(answers["bucket"].to_pylist(), answers["answer"].to_pylist()))
    counts = np.zeros(len(tokens.keys), np.int64)
    names, at = bucket_edges(tokens.keys, buckets)
    for name, a, b in zip(names.tolist(), at, at[1:]):
        answer = by_bucket[name]
        size = int(np.frombuffer(answer[:8], np.int64)[0])
        counts[a:b] = from_planes(answer[8 + size :] if part else answer[8 : 8 + size], np.int64)
    return counts


def quantised(estimates: np.ndarray) -> np.ndarray:
    """Grid level of each estimate; 0 for an estimate of zero."""
    with np.errstate(divide="ignore"):
        level = _CELLS - 1 + np.round(_GRID * np.log10(estimates))
    return np.where(estimates > 0, np.clip(level, 1, _CELLS - 1), 0).astype(np.int64)


def learn(cells: np.ndarray, times: np.ndarray, order: int, uniform: float, rounds: int) -> np.ndarray:
    """Mixture weights (uniform share first) for each context bucket, by EM on held-out counts.

    ``cells`` are numbers that hold the bucket and the grid level of each estimate. Weights start
    from those of all buckets together, which also count as one held-out token in each bucket; so a
    bucket without counts has the common weights, and no share is ever zero.
    """
    levels = np.stack([(cells // _CELLS**k) % _CELLS for k in range(order)])
    bucket = cells // _CELLS**order
    estimates = np.where(levels > 0, 10.0 ** ((levels - (_CELLS - 1)) / _GRID), 0.0)
    estimates = np.vstack([np.full(len(cells), uniform), estimates])

    def rise(weights: np.ndarray, which: np.ndarray, count: int, prior: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            shares = weights[which].T * estimates
            shares *= times / np.maximum(shares.sum(axis=0), 1e-300)
            sums = np.stack([np.bincount(which, s, count) for s in shares], axis=1) + prior
            weights = sums / sums.sum(axis=1, keepdims=True)
        return weights

    even = np.full((1, order + 1), 1 / (order + 1))
    common = rise(even, np.zeros(len(cells), np.int64), 1, even)
    return rise(np.repeat(common, 64, axis=0), bucket, 64, common)


def score(docs: DataFrame, trains: Column, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``, scored whole.

    ``trains`` says which rows may be learned from (NULL: not). Columns: ``doc_id, trains,
    n_tokens, n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (unigrams with
    0.5 added) and ``score``, both log10 probabilities of the text. A NULL or empty text is one end
    token; rows that repeat count as often as they occur. Without training rows every token is
    unknown and both scores are 0.
    """
    order = settings.order
    count = chunk_count(docs, settings.chunk_bytes)
    digest = F.xxhash64("doc_id", F.lit("deleted"))
    # chunk numbers: first the counted part, then the deleted part, then what only is scored
    train = F.coalesce(trains, F.lit(False))
    held = F.pmod(digest, F.lit(settings.deleted)) == 0
    deleted = max(1, count // settings.deleted)
    kinds = (count, count + deleted)
    chunks = kinds[1] + max(1, count // 4)
    spread = F.xxhash64("doc_id")
    chunk = (
        F.when(train & ~held, F.pmod(spread, F.lit(count)))
        .when(train, count + F.pmod(spread, F.lit(deleted)))
        .otherwise(kinds[1] + F.pmod(spread, F.lit(chunks - kinds[1])))
    )
    buckets = chunks

    def ask(table: pa.Table) -> pa.Table:
        tokens = Tokens(in_order(table)[1], order)
        return ask_counts(table["chunk"][0].as_py(), tokens.keys, tokens.times, buckets)

    def reply(table: pa.Table) -> pa.Table:
        return _answers(table, kinds)

    asked = deal(docs, chunks, chunk).groupBy("chunk").applyInArrow(ask, ASKED)
    answers = landed(asked.groupBy("bucket").applyInArrow(reply, _ANSWERED), "lm-answers")
    names = ("tokens_part", "known_part", "tokens", "known")
    totals = Totals(*answers.agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in names)).first())
    answers = answers.select("chunk", "bucket", "answer")

    def histogram(mine: pa.Table, said: pa.Table) -> pa.Table:
        tokens = Tokens(in_order(mine)[1], order)
        estimates, context = tokens.estimates(_counts(tokens, said, buckets, part=True), totals.tokens_part)
        cell = context_bucket(context)
        for level in quantised(estimates)[::-1]:
            cell = cell * _CELLS + level
        cells, times = np.unique(cell, return_counts=True)
        return pa.table({"cell": pa.array(cells), "times": pa.array(times)})

    in_part = (F.col("chunk") >= kinds[0]) & (F.col("chunk") < kinds[1])
    slice_docs = deal(docs.where(train & held), chunks, chunk).groupBy("chunk")
    slice_said = answers.where(in_part).repartition(chunks, "chunk").groupBy("chunk")
    cells = slice_docs.cogroup(slice_said).applyInArrow(histogram, "cell long, times long")
    found = cells.groupBy("cell").agg(F.sum("times").alias("times")).toArrow()
    weights = learn(
        found["cell"].to_numpy(), found["times"].to_numpy(), order, 1 / (totals.known_part + 1), settings.rounds
    )

    def finish(mine: pa.Table, said: pa.Table) -> pa.Table:
        ids, texts = in_order(mine)
        tokens = Tokens(texts, order)
        counts = _counts(tokens, said, buckets)
        estimates, context = tokens.estimates(counts, totals.tokens)
        seen = counts[tokens.at[0]]
        base = np.log10((seen + 0.5) / (totals.tokens + 0.5 * (totals.known + 1)))
        share = weights[context_bucket(context)].T if totals.tokens else np.eye(order + 1)[:, :1]
        mixed = np.log10(share[0] / (totals.known + 1) + (share[1:] * estimates).sum(axis=0))
        first = tokens.first[:-1]
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            "trains": pa.array([mine["chunk"][0].as_py() < kinds[1]] * len(ids)),
            "n_tokens": pa.array(np.diff(tokens.first)),
            "n_known": pa.array(np.add.reduceat((seen > 0).astype(np.int64), first)),
            "train_tokens": pa.array([totals.tokens] * len(ids), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, first)),
            "score": pa.array(np.add.reduceat(mixed, first)),
        })

    schema = (
        "doc_id long, trains boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    said = answers.repartition(chunks, "chunk").groupBy("chunk")
    return deal(docs, chunks, chunk).groupBy("chunk").cogroup(said).applyInArrow(finish, schema)
