"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, exact verification.

A text is the multiset of its runs of five words. Each shingle owns Poisson processes over its
weight axis, cut into the intervals [0,1), [1,2), [2,4), [4,8)...: a point has a time, a place on
the axis and one of the signature's components, and counts for a text when its place is below the
shingle's multiplicity. A component keeps its earliest point, so two texts agree in it with
probability sum(min) / sum(max), whatever the multiplicities; intervals make the work grow with
the logarithm of a multiplicity. Points later than a limit cannot matter and are never drawn.

Texts with equal multisets form a class with one representative. Representatives meet in bands of
the signature, and each is compared with the smallest of its bucket, so a bucket costs as many
comparisons as members. What then still lies in one bucket but in two components, as texts around
one common passage do, is not paired off: an exact prefix filter finds the pairs that can be links
at all, by rare shingles they must share. So no link of a bucket is lost. Comparisons count the
whole multisets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import (
    ANSWERED,
    ASKED,
    add_counts,
    answered_counts,
    ask_counts,
    chunk_count,
    deal,
    in_order,
)
from millrace.llm.components import components
from millrace.llm.scratch import landed, only
from millrace.llm.words import grams, mix, slices, split, uniform, utf8


@dataclass(frozen=True)
class Settings:
    """``rows`` components to a band: 24 bands of 5 find a pair of similarity 0.8 with 0.9999."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 5


def multisets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order, their multiplicities, and the texts' bounds.

    A text of fewer than ``words`` words has its whole word sequence as its only shingle.
    """
    code, bounds = grams(split(texts), words)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((code, owner))
    code = code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.concatenate([at, [len(code)]]))
    return code[at], times, np.searchsorted(owner[at], np.arange(len(texts) + 1))


def signatures(code: np.ndarray, times: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Time of the earliest point of each component, for every text; infinite without shingles."""
    texts = len(bounds) - 1
    total = np.concatenate([[0], np.cumsum(times)])
    weight = (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)
    earliest = np.full((texts, size), np.inf)
    # one process for each shingle and interval [low, low + length) that its multiplicity reaches
    levels = np.ceil(np.log2(times)).astype(np.int64) + 1
    shingle = np.repeat(np.arange(len(code)), levels)
    level = np.arange(len(shingle)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.maximum(low, 1.0)
    owner = np.repeat(np.arange(texts), np.diff(bounds))[shingle]
    seed = mix(code[shingle] + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    share = (times[shingle] - low) / length
    todo, slack = weight > 0, 3.0
    while todo.any():
        limit = np.where(todo, (np.log(size) + slack) / np.maximum(weight, 1.0), 0.0)
        live = np.flatnonzero(todo[owner])
        when, step = np.zeros(len(live)), 0
        while len(live):
            step = (step + 0xD1342543DE82EF95) % 2**64
            draw = mix(seed[live] + np.uint64(step))
            when = when - np.log(uniform(draw)) / (size * length[live])
            inside = when <= limit[owner[live]]
            live, when, draw = live[inside], when[inside], draw[inside]
            draw = mix(draw + np.uint64(0xA0761D6478BD642F))
            component = ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> np.uint64(32)
            place = (draw >> np.uint64(32)).astype(np.float64) * 2.0**-32
            used = place < share[live]
            np.minimum.at(earliest, (owner[live[used]], component[used].astype(np.int64)), when[used])
        todo &= ~np.isfinite(earliest).all(axis=1)
        slack += 6.0
    return earliest


def band_keys(earliest: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each text and band; equal keys mean the same earliest points."""
    bits = earliest.view(np.uint64).reshape(len(earliest), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + bits[:, :, r])
    return key.view(np.int64)


_SIGNED = "doc_id long, size long, class_a long, class_b long, bands array<long>"


def sign(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, size`` (shingles), ``class_a, class_b`` (128 bits of the multiset), ``bands``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in slices(texts):
                code, times, bounds = multisets(texts[a:b], settings.words)
                each = mix(code + mix(times.astype(np.uint64)))
                sums = np.zeros((3, len(code) + 1), np.uint64)
                sums[0, 1:] = np.cumsum(times)
                sums[1, 1:], sums[2, 1:] = np.cumsum(each), np.cumsum(mix(each + np.uint64(7)))
                size, class_a, class_b = (sums[:, bounds[1:]] - sums[:, bounds[:-1]]).view(np.int64)
                keys = band_keys(
                    signatures(code, times, bounds, settings.bands * settings.rows),
                    settings.bands,
                    settings.rows,
                )
                full = size > 0
                offsets = np.concatenate([[0], np.cumsum(full * settings.bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel()))
                columns = [ids.slice(a, b - a), *map(pa.array, (size, class_a, class_b)), lists]
                yield pa.record_batch(columns, ["doc_id", "size", "class_a", "class_b", "bands"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(rows, _SIGNED)


class _Pairs:
    """The lengths of pairs of texts, without putting the texts together."""

    def __init__(self, left: list[bytes], right: list[bytes]) -> None:
        self._sizes = [len(x) + len(y) for x, y in zip(left, right)]

    def __iter__(self) -> Iterator[range]:
        return (range(n) for n in self._sizes)

    def __len__(self) -> int:
        return len(self._sizes)


def linked(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Those of ``pairs (a, b)`` whose multisets overlap enough, counted exactly."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
            keep = np.zeros(batch.num_rows, bool)
            for a, b in slices(_Pairs(left, right)):
                number = {t: i for i, t in enumerate(dict.fromkeys([*left[a:b], *right[a:b]]))}
                code, times, bounds = multisets(list(number), settings.words)
                total = np.add.reduceat(np.append(times, 0), np.minimum(bounds[:-1], len(times)))
                for k in range(a, b):
                    i, j = number[left[k]], number[right[k]]
                    mine, yours = slice(bounds[i], bounds[i + 1]), slice(bounds[j], bounds[j + 1])
                    shared, x, y = np.intersect1d(
                        code[mine], code[yours], assume_unique=True, return_indices=True
                    )
                    both = np.minimum(times[mine][x], times[yours][y]).sum()
                    keep[k] = both >= settings.similarity * (total[i] + total[j] - both)
            yield pa.record_batch(batch.columns[:2], ["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(rows, "a long, b long").distinct()


def _elements(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's multiset as a set: an occurrence of a shingle and its number. Bounds by text."""
    code, times, bounds = multisets(texts, words)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    total = np.concatenate([[0], np.cumsum(times)])
    return mix(np.repeat(code, times) + mix(nth.astype(np.uint64))), total[bounds]


_CHUNK_BYTES = 4 << 20  # a chunk's elements and their sorting take some twenty times that
_PREFIX = "element long, doc_id long, rest long"


def prefixes(texts: DataFrame, settings: Settings) -> DataFrame:
    """``element, doc_id, rest``: the rare elements of each text that any link of its must share.

    Elements are ordered by the number of these texts that hold them. Two texts of the similarity
    share one of the first ``n - ceil(similarity * n) + 1`` of either (prefix filter), and one that
    only one text holds joins nothing. ``rest`` counts the text's elements from this one on: two
    texts whose first common element this is have at most the smaller rest in common.
    """
    chunks = chunk_count(texts, _CHUNK_BYTES)
    buckets, dealt = 2 * chunks, deal(texts, chunks)

    def ask(table: pa.Table) -> pa.Table:
        keys, times = np.unique(_elements(in_order(table)[1], settings.words)[0], return_counts=True)
        return ask_counts(table["chunk"][0].as_py(), keys, times, buckets)

    def finish(mine: pa.Table, said: pa.Table) -> pa.Table:
        ids, texts = in_order(mine)
        element, bounds = _elements(texts, settings.words)
        keys, place = np.unique(element, return_inverse=True)
        held = answered_counts(keys, said, buckets)[place]
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((element, held, owner))
        rank = np.arange(len(element)) - np.repeat(bounds[:-1], sizes)
        length = sizes - np.ceil(settings.similarity * sizes - 1e-9).astype(np.int64) + 1
        used = order[(rank < length[owner]) & (held[order] > 1)]
        return pa.table({
            "element": pa.array(element[used].view(np.int64)),
            "doc_id": pa.array(np.array(ids, np.int64)[owner[used]]),
            "rest": pa.array((sizes[owner] - rank)[(rank < length[owner]) & (held[order] > 1)]),
        })

    said = dealt.groupBy("chunk").applyInArrow(ask, ASKED).groupBy("bucket").applyInArrow(add_counts, ANSWERED)
    said = said.repartition(chunks, "chunk")
    return dealt.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInArrow(finish, _PREFIX)


def near_groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: class and component of near-duplicates.

    Columns: ``doc_id``; ``class_id``, smallest id with the same multiset; ``component_id``,
    smallest id reachable by links of at least the similarity; ``kept`` (``doc_id`` is
    ``component_id``); ``n_shingles``. NULL texts count as empty; texts without any word are one
    class and link with nothing else. A row without id is not compared: its class and component
    are NULL and it is kept. Repeated rows get the same answer each. Other columns are not read.
    """
    signed = landed(sign(docs, settings), "minhash-signed")
    named = signed.where("doc_id IS NOT NULL")
    keys = ["class_a", "class_b"]
    classes = landed(named.groupBy(*keys).agg(F.min("doc_id").alias("class_id")), "minhash-classes")
    first = classes.withColumnRenamed("class_id", "doc_id")
    members = (
        named.join(first, [*keys, "doc_id"], "left_semi")
        .select("doc_id", "size", F.explode("bands").alias("key"))
    )
    leaders = members.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"))
    shared = leaders.where("a < z").drop("z")
    buckets = landed(members.join(shared, "key"), "minhash-buckets")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = landed(only(texts, buckets.select("doc_id").distinct(), "doc_id").distinct(), "minhash-texts")
    star = buckets.where("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    links = landed(linked(star, texts, settings), "minhash-links")
    found = components(links)

    # what shares a bucket but no component: found by the rare elements that a link must share
    placed = buckets.drop("a").join(found.toDF("doc_id", "c"), "doc_id", "left")
    placed = placed.withColumn("c", F.coalesce("c", "doc_id"))
    split_keys = placed.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y")
    open_docs = placed.join(split_keys.select("key"), "key", "left_semi").select("doc_id", "c", "size")
    open_docs = landed(open_docs.distinct(), "minhash-open")
    rare = prefixes(only(texts, open_docs.select("doc_id"), "doc_id"), settings).join(open_docs, "doc_id")
    rare = landed(rare.select("element", "doc_id", "size", "c", "rest"), "minhash-rare")
    one, two = (rare.toDF("element", *(f"{x}{i}" for x in ("d", "s", "c", "r"))) for i in (1, 2))
    overlap = settings.similarity / (1 + settings.similarity)
    apart = (
        one.join(two, "element")
        .where("c1 <> c2 AND d1 < d2")
        .where(F.least("r1", "r2") >= overlap * (F.col("s1") + F.col("s2")) - 1e-6)
        .select(F.col("d1").alias("a"), F.col("d2").alias("b"))
        .distinct()
    )
    more = linked(apart, texts, settings)
    found = landed(components(links.union(more)).toDF("class_id", "component_id"), "minhash-found")

    out = signed.select("doc_id", "size", *keys).join(
        classes, (signed["class_a"] == classes["class_a"]) & (signed["class_b"] == classes["class_b"]), "left"
    )
    known = F.col("doc_id").isNotNull()
    out = out.select("doc_id", "size", F.when(known, F.col("class_id")).alias("class_id"))
    out = out.join(found, "class_id", "left")
    component = F.coalesce("component_id", "class_id")
    return out.select(
        "doc_id",
        "class_id",
        component.alias("component_id"),
        F.when(known, F.col("doc_id") == component).otherwise(True).alias("kept"),
        F.col("size").alias("n_shingles"),
    )


def drop_near(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose id stays: one document of each component."""
    gone = landed(near_groups(docs, settings).where("NOT kept").select("doc_id").distinct(), "minhash-gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
