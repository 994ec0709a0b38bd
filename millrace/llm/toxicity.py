"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and plain unlabelled text (U) train a linear classifier in numpy. With
the class prior ``pi`` the risk is ``pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))``: what U loses by
being called clean, less the part that the toxic texts hidden in U account for. Where that
difference falls below zero the model has begun to fit U's hidden positives, and the step goes the
other way (non-negative correction).

Features are the distinct words of a text and their first four and five bytes, hashed; only those
whose share of texts differs clearly between P and U (a two-sample z of ``min_z``) get a weight.
Training uses bounded samples (``max_positive``, ``max_unlabelled`` texts, chosen by a hash of the
id) and is deterministic; scoring covers every row and whole text in Arrow batches, without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from millrace.llm.words import slices, split, utf8

BITS = 18
_PREFIXES = (4, 5)


@dataclass(frozen=True)
class Settings:
    """Bounds and step sizes of the training."""

    max_positive: int = 1500
    max_unlabelled: int = 5000
    steps: int = 400
    rate: float = 0.2
    decay: float = 1e-4
    min_z: float = 5.0


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        found = [np.zeros(0)]
        for a, b in slices(texts):
            index, bounds = features(texts[a:b])
            found.append(_sigmoid(self.bias + _row_sums(self.weights[index], bounds)))
        return np.concatenate(found)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each text, one after the other, and their bounds."""
    words = split(texts, lower=True, prefixes=_PREFIXES)
    owner = words.text_of()
    # distinct words of each text, by sorting; owners stay in order
    order = np.lexsort((words.code[0], owner))
    owner, code = owner[order], words.code[:, order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (code[0, 1:] != code[0, :-1])
    owner, code = owner[new], code[:, new]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)) * len(code)
    return (code >> np.uint64(64 - BITS)).astype(np.int32).T.ravel(), bounds


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit(
    positive: tuple[np.ndarray, np.ndarray],
    unlabelled: tuple[np.ndarray, np.ndarray],
    prior: float,
    settings: Settings = Settings(),
) -> Model:
    """Minimise the non-negative risk with the logistic loss by AdaGrad on full batches.

    Without positives, without unlabelled texts or with a prior of 0 nothing can be learned:
    every score is then 0; with a prior of 1 every score is 1.
    """
    weights = np.zeros(1 << BITS)
    rows_p, rows_u = len(positive[1]) - 1, len(unlabelled[1]) - 1
    if prior >= 1 and rows_p:
        return Model(weights, 500.0)
    if not (rows_p and rows_u and prior > 0):
        return Model(weights, -500.0)
    parts = [_distinct_texts(*positive), _distinct_texts(*unlabelled)]
    rows_p, rows_u = len(parts[0][1]) - 1, len(parts[1][1]) - 1
    telling = _telling(parts, settings.min_z)
    parts = [_only(telling, *part) for part in parts]
    index = np.concatenate([parts[0][0], parts[1][0]])
    bounds = np.concatenate([parts[0][1], parts[1][1][1:] + parts[0][1][-1]])
    owner = np.repeat(np.arange(rows_p + rows_u), np.diff(bounds))
    is_p = np.arange(rows_p + rows_u) < rows_p
    bias, seen, seen_bias = float(np.log(prior / (1 - prior))), np.full(1 << BITS, 1e-8), 1e-8
    for _ in range(settings.steps):
        p = _sigmoid(bias + _row_sums(weights[index], bounds))
        as_clean = -np.log1p(-np.minimum(p, 1 - 1e-12))
        if as_clean[~is_p].mean() >= prior * as_clean[is_p].mean():
            slope = np.where(is_p, -prior / rows_p, p / rows_u)
        else:
            slope = np.where(is_p, prior / rows_p * p, -p / rows_u)
        gradient = np.bincount(index, slope[owner], 1 << BITS) + settings.decay * weights
        seen += gradient**2
        weights -= settings.rate * gradient / np.sqrt(seen)
        seen_bias += slope.sum() ** 2
        bias -= settings.rate * slope.sum() / np.sqrt(seen_bias)
    return Model(weights, bias)


def _distinct_texts(index: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with other features than all before them: copies count once."""
    seen = dict.fromkeys(index[a:b].tobytes() for a, b in zip(bounds, bounds[1:]))
    parts = [np.frombuffer(x, np.int32) for x in seen]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def _telling(parts: list[tuple[np.ndarray, np.ndarray]], min_z: float) -> np.ndarray:
    """Which features are in clearly more, or clearly fewer, texts of P than of U."""
    shares, sizes = [], []
    for index, bounds in parts:
        share = np.zeros(1 << BITS, np.int64)
        for begin, end in zip(bounds, bounds[1:]):
            share[np.unique(index[begin:end])] += 1
        shares.append(share)
        sizes.append(len(bounds) - 1)
    pooled = np.clip(sum(shares) / sum(sizes), 1e-12, 1 - 1e-12)
    spread = np.sqrt(pooled * (1 - pooled) * sum(1 / n for n in sizes))
    return np.abs(shares[0] / sizes[0] - shares[1] / sizes[1]) >= min_z * spread


def _only(telling: np.ndarray, index: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = telling[index]
    before = np.concatenate([[0], np.cumsum(keep)])
    return index[keep], before[bounds]


def _packed(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features of a bounded set of texts, worked out by tasks; only numbers reach the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts = utf8(batch.column("text")), []
            for low, high in slices(texts):
                index, bounds = features(texts[low:high])
                parts.extend(index[a:b].tobytes() for a, b in zip(bounds, bounds[1:]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(parts, pa.binary())], ["doc_id", "f"])

    found = frame.select("doc_id", "text").mapInArrow(rows, "doc_id long, f binary").collect()
    parts = [np.frombuffer(r.f, np.int32) for r in sorted(found, key=lambda r: (r.doc_id, bytes(r.f)))]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), bounds


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    Rows of ``labels`` without id or label are ignored; a document labelled both ways counts as
    toxic. The prior is the share of toxic ones among labelled documents. Give only what may be
    learned from: folds are the caller's.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    spread = F.xxhash64(F.col("doc_id"))

    def chosen(rows: DataFrame, count: int) -> DataFrame:
        ids = rows.select("doc_id").where("doc_id IS NOT NULL").distinct()
        # at most `count` ids: a proven bound for a broadcast
        picked = ids.orderBy(spread, "doc_id").limit(count)
        texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        return texts.join(F.broadcast(picked), "doc_id", "left_semi")

    positive = _packed(chosen(known.where("toxic = 1"), settings.max_positive))
    unlabelled = _packed(chosen(docs, settings.max_unlabelled))
    return fit(positive, unlabelled, toxic / total if total else 0.0, settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with two more columns, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    One row per row; a NULL text counts as empty and has the score of an empty text. Columns of
    these names in ``docs`` are replaced.
    """
    kept = docs.drop("score", "predicted")
    schema = StructType(
        [*kept.schema, StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(utf8(batch.column("text")))
            extra = [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.record_batch([*batch.columns, *extra], [*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(rows, schema)
