"""Lexical retrieval packing: related documents share a window of tokens.

Terms are the ids of the tokenizer. Document frequencies, the number of documents and their mean
length are those of the whole table. A shuffle brings related documents together, wherever they lay:
a tree of two-means splits, grown on a bounded sample of document vectors, gives every document a
place, and ranges of places, equal in tokens however many documents share a place, become shards of
at most ``shard_tokens`` tokens with a BM25 inverted index each. A seed document opens a
window; its best unused neighbours fill the rest: the first of them that fits whole, else the best
one, cut where the window ends. What is cut off goes on in the next window, whose seed it is. No
window but a shard's last has room left, and that one is laid out as sequences of powers of two,
which need no padding. Retrieval and use are by shard: neighbours that the tree puts elsewhere are
not found. `README.md` says how many.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import encoder
from millrace.llm.scratch import landed
from millrace.llm.words import slices, utf8


@dataclass(frozen=True)
class Settings:
    """``k1`` and ``b`` are BM25's. ``terms`` of the seed that weigh most make its query: all by default.

    About ``sample`` document vectors of ``axes`` numbers grow the tree that routes; about
    ``per_range`` documents for each shard say where its range of places ends.
    """

    window: int = 2048
    shard_tokens: int = 4_000_000
    terms: int = 1 << 16
    neighbours: int = 8
    k1: float = 1.2
    b: float = 0.75
    sample: int = 16_384
    axes: int = 128
    per_range: int = 64


@dataclass(frozen=True)
class Stats:
    """Of a whole table: number of documents, mean length, documents that hold each term."""

    n: int
    mean: float
    held: np.ndarray


def _idf(stats: Stats) -> np.ndarray:
    return np.log(1 + (stats.n - stats.held + 0.5) / (stats.held + 0.5))


class Index:
    """BM25 over the documents of a shard. Postings lie by term; a document knows its own.

    Weights follow ``stats``, by default those of the shard. A term that a quarter of the documents
    hold is a row with a number for each document, at most four times its postings in size; rows are
    added up whole, in single precision.
    """

    def __init__(self, docs: list[np.ndarray], settings: Settings, stats: Stats | None = None) -> None:
        n, lengths = len(docs), np.array([len(d) for d in docs])
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
        # document by document: sixteen bits sort several times faster
        keys = (owner << 16) | np.concatenate([np.sort(d) for d in docs])
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        times = np.diff(np.append(at, len(keys)))
        doc, term = (keys[at] >> 16).astype(np.int32), (keys[at] & 0xFFFF).astype(np.uint16)
        held = np.bincount(term, minlength=1 << 16)
        stats = stats or Stats(n, lengths.mean(), held)
        norm = settings.k1 * (1 - settings.b + settings.b * lengths / stats.mean)
        weight = (_idf(stats)[term] * times * (settings.k1 + 1) / (times + norm[doc])).astype(np.float32)
        self._terms, self._own = term, np.searchsorted(doc, np.arange(n + 1))
        # a term of one document only finds nobody
        self._pull = np.where(held[term] > 1, weight, np.float32(0))
        self._settings = settings
        self._lay(doc, term, weight, np.arange(n))

    def _lay(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, at: np.ndarray) -> None:
        """Postings in order of documents, which are numbers into ``at``."""
        self._postings, self._at = (doc, term, weight), at
        held = np.bincount(term, minlength=1 << 16)
        often = np.flatnonzero(held * 4 >= max(len(at), 4))
        self._row = np.full(1 << 16, -1, np.int32)
        self._row[often] = np.arange(len(often))
        row = self._row[term]
        in_row = row >= 0
        self._rows = np.zeros((len(often), len(at)), np.float32)
        self._rows[row[in_row], doc[in_row]] = weight[in_row]
        rare = np.flatnonzero(~in_row)
        by_term = rare[np.argsort(term[rare], kind="stable")]  # sixteen bits: linear
        self._doc, self._weight = doc[by_term], weight[by_term]
        held[often] = 0
        self._begin = np.concatenate([[0], np.cumsum(held)])

    def leave(self, used: np.ndarray) -> None:
        """Documents that are used for good leave the index, once they are half of it."""
        gone = used[self._at]
        if 2 * np.count_nonzero(gone) <= len(gone):
            return
        doc, term, weight = self._postings
        stay, number = ~gone[doc], np.cumsum(~gone, dtype=np.int32) - 1
        self._lay(number[doc[stay]], term[stay], weight[stay], self._at[~gone])

    def _scores(self, terms: np.ndarray) -> np.ndarray:
        row = self._row[terms]
        scores = np.zeros(len(self._at), np.float32)
        for k in row[row >= 0].tolist():  # in place: a copy of all these rows costs more than to add them
            scores += self._rows[k]
        rare = terms[row < 0].astype(np.int64)
        begin, count = self._begin[rare], self._begin[rare + 1] - self._begin[rare]
        found = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
        return scores + np.bincount(self._doc[found], self._weight[found], len(self._at))

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share terms with ``seed``, best first; ties by position."""
        own = slice(self._own[seed], self._own[seed + 1])
        pull, terms = self._pull[own], self._terms[own]
        if len(pull) > self._settings.terms:
            best = np.argpartition(-pull, self._settings.terms)[: self._settings.terms]
            pull, terms = pull[best], terms[best]
        terms = terms[pull > 0]
        most = min(self._settings.neighbours, len(self._at))
        if not len(terms) or not most:
            return np.zeros(0, np.int64)
        scores = self._scores(terms)
        scores[used[self._at]] = 0.0
        top = np.sort(np.argpartition(-scores, most - 1)[:most])
        top = top[np.argsort(-scores[top], kind="stable")][: np.count_nonzero(scores[top] > 0)]
        return self._at[top]


def windows(
    docs: list[np.ndarray], settings: Settings, stats: Stats | None = None
) -> Iterator[list[tuple[int, int, int]]]:
    """The sequences of a shard, each a list of pieces (document, start, length)."""
    if not docs:
        return
    index, used = Index(docs, settings, stats), np.zeros(len(docs), bool)
    pieces: list[tuple[int, int, int]] = []
    room, following, seed = settings.window, 0, -1
    ranked: np.ndarray = np.zeros(0, np.int64)
    while True:
        ranked = ranked[~used[ranked]]
        if pieces and not len(ranked):
            index.leave(used)
            ranked = index.neighbours(pieces[-1][0] if seed < 0 else seed, used)
            seed = -1
        if pieces and len(ranked):
            fits = [d for d in ranked if len(docs[d]) <= room]
            doc = int(fits[0] if fits else ranked[0])
        else:
            while following < len(docs) and used[following]:
                following += 1
            if following == len(docs):
                break
            doc = following
        used[doc] = True
        if not pieces:
            seed, ranked = doc, ranked[:0]
        start, left = 0, len(docs[doc])
        while left:
            length = min(left, room)
            pieces.append((doc, start, length))
            start, left, room = start + length, left - length, room - length
            if not room:
                yield pieces
                pieces, room, seed, ranked = [], settings.window, doc, ranked[:0]
    yield from in_powers_of_two(pieces)


def in_powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The same tokens in order, as sequences whose lengths are powers of two, longest first."""
    rest = sum(length for *_, length in pieces)
    waiting = pieces[::-1]
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        sequence = []
        while room:
            doc, start, length = waiting.pop()
            taken = min(room, length)
            sequence.append((doc, start, taken))
            room -= taken
            if taken < length:
                waiting.append((doc, start + taken, length - taken))
        yield sequence


# ---- routing ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Splits by a plane each. ``below``: the next node on either side, or -1 at a leaf."""

    plane: np.ndarray
    cut: np.ndarray
    below: np.ndarray

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """The path of each vector as a number: what parts late lies close together."""
        place, node = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
        live = np.arange(len(vectors)) if len(self.cut) else np.zeros(0, np.int64)
        for level in range(_DEPTH):
            if not len(live):
                break
            at = node[live]
            side = ((vectors[live] * self.plane[at]).sum(axis=1) > self.cut[at]).astype(np.int64)
            place[live] |= side << (_DEPTH - 1 - level)
            node[live] = self.below[at, side]
            live = live[node[live] >= 0]
        return place


_DEPTH = 40
_LEAF = 6


def grow(vectors: np.ndarray) -> Tree:
    """Two-means splits of the sample, down to a few vectors."""
    planes, cuts, below = [], [], []
    waiting = [(np.arange(len(vectors)), 0, -1, 0)]
    while waiting:
        part, depth, parent, side = waiting.pop()
        mine = vectors[part]
        if len(part) <= _LEAF or depth == _DEPTH or (mine == mine[0]).all():
            continue
        far = mine[np.argmax(((mine - mine.mean(axis=0)) ** 2).sum(axis=1))]
        centres = np.stack([mine.mean(axis=0) * 2 - far, far])
        for _ in range(8):
            plane = centres[1] - centres[0]
            cut = float((centres[1] + centres[0]) @ plane / 2)
            right = mine @ plane > cut
            if right.all() or not right.any():
                break
            centres = np.stack([mine[~right].mean(axis=0), mine[right].mean(axis=0)])
        if right.all() or not right.any():
            continue
        if parent >= 0:
            below[parent][side] = len(cuts)
        waiting += [(part[~right], depth + 1, len(cuts), 0), (part[right], depth + 1, len(cuts), 1)]
        planes.append(plane)
        cuts.append(cut)
        below.append([-1, -1])
    return Tree(
        np.array(planes, np.float32).reshape(-1, vectors.shape[1]), np.array(cuts), np.array(below, np.int64).reshape(-1, 2)
    )


def _begins(ids: np.ndarray) -> np.ndarray:
    """Where each term begins in the sorted ids of a document."""
    new = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:])
    return np.flatnonzero(new)


_AXES: dict[int, np.ndarray] = {}


def vectors(docs: list[np.ndarray], stats: Stats, settings: Settings) -> np.ndarray:
    """Random projections of the BM25 weights of each document, of length one."""
    if settings.axes not in _AXES:
        dice = np.random.default_rng(2)
        _AXES[settings.axes] = dice.standard_normal((1 << 16, settings.axes), np.float32)
    axes, idf = _AXES[settings.axes], _idf(stats).astype(np.float32)
    out = np.zeros((len(docs), settings.axes), np.float32)
    # the axes of a document's terms, taken into one place: to get it anew costs more than to fill it
    room = np.empty((min(max(map(len, docs), default=0), 1 << 16), settings.axes), np.float32)
    for k, doc in enumerate(docs):
        ids = np.sort(doc)
        begin = _begins(ids)
        terms, times = ids[begin], np.diff(begin, append=len(ids))
        near = np.take(axes, terms, axis=0, out=room[: len(terms)], mode="clip")
        norm = settings.k1 * (1 - settings.b + settings.b * len(doc) / stats.mean)
        out[k] = (idf[terms] * times / (times + norm)).astype(np.float32) @ near
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _docs(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in batch.column("tokens").to_pylist()]


def statistics(tokens: DataFrame) -> Stats:
    """Of all rows of ``tokens``; one number a term is all that is collected."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for doc in _docs(batch):
                ids = np.sort(doc)  # of sixteen bits: several times faster than to hash them
                held[ids[_begins(ids)]] += 1
        term = np.flatnonzero(held)
        yield pa.record_batch([pa.array(term), pa.array(held[term])], ["term", "held"])

    held = np.zeros(1 << 16, np.int64)
    counts = tokens.select("tokens").mapInArrow(rows, "term long, held long")
    for term, times in counts.groupBy("term").agg(F.sum("held")).collect():
        held[term] = times
    n, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()
    return Stats(n, total / 2 / max(n, 1), held)


def routed(tokens: DataFrame, stats: Stats, settings: Settings) -> DataFrame:
    """``tokens`` in ranges of related documents, each a partition in order of places.

    Ranges are equal in tokens, by a sample that grows with their number: ``per_range`` rows each.
    """
    spark = tokens.sparkSession
    spot = F.xxhash64("doc_id", "tokens")

    def share(rows: float) -> Column:
        return F.pmod(spot, F.lit(1 << 30)) < int(min(1.0, rows / max(stats.n, 1)) * (1 << 30))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = vectors(_docs(batch), stats, settings)
            yield pa.record_batch([pa.array([x.tobytes() for x in found], pa.binary())], ["v"])

    chosen = tokens.where(share(settings.sample)).select("tokens")
    found = sorted(bytes(r.v) for r in chosen.mapInArrow(sampled, "v binary").distinct().collect())
    tree = spark.sparkContext.broadcast(
        grow(np.frombuffer(b"".join(found), np.float32).reshape(-1, settings.axes))
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = tree.value.places(vectors(_docs(batch), stats, settings))
            yield pa.record_batch([*batch.columns, pa.array(place)], [*batch.schema.names, "_place"])

    known = "doc_id long, tokens binary, _place long"
    # a little under a shard each, so that ranges of uneven length are seldom cut again
    parts = max(1, -(-int(stats.n * stats.mean) * 5 // (settings.shard_tokens * 4)))
    some = tokens.where(share(parts * settings.per_range)).mapInArrow(placed, known)
    places = some.select("_place", spot.alias("_spot"), (F.octet_length("tokens") / 2).alias("size")).toPandas()
    bounds = spark.sparkContext.broadcast(
        ends(places["_place"].to_numpy(), places["_spot"].to_numpy(), places["size"].to_numpy(), parts)
    )

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in placed(batches):
            part = range_of(batch.column("_place").to_numpy(), batch.column("_spot").to_numpy(), bounds.value)
            yield batch.append_column("_part", pa.array(part))

    dealt = tokens.withColumn("_spot", spot).mapInArrow(ranged, "doc_id long, tokens binary, _spot long, _place long, _part int")
    near = dealt.repartitionById(parts, "_part").sortWithinPartitions("_place", "_spot")
    return near.select("doc_id", "tokens")


def ends(place: np.ndarray, spot: np.ndarray, size: np.ndarray, parts: int) -> np.ndarray:
    """Place and spot where each of ``parts`` ranges but the last ends: as many tokens in each."""
    order = np.lexsort((spot, place))
    tokens = np.cumsum(size[order])
    if not len(tokens):
        return np.zeros((0, 2), np.int64)
    at = np.searchsorted(tokens, tokens[-1] * np.arange(1, parts) / parts)
    return np.stack([place[order][at], spot[order][at]], axis=1).astype(np.int64)


def range_of(place: np.ndarray, spot: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The number of the range that each place and spot lies in; a bound belongs to the range it ends.

    Bounds and rows are sorted together, so places that many documents share are split by spot.
    """
    edge = np.arange(len(place) + len(bounds)) < len(bounds)
    places = np.concatenate([bounds[:, 0], place])
    order = np.lexsort((edge, np.concatenate([bounds[:, 1], spot]), places))
    passed = np.empty(len(order), np.int32)
    passed[order] = np.cumsum(edge[order])
    return passed[len(bounds) :]


# ---- over tables -----------------------------------------------------------------------------


# bytes of text that are encoded together
_ENCODED = 8 << 20

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)


def pack(
    docs: DataFrame, tokenizer: str, settings: Settings = Settings(), *, with_ids: bool = True
) -> DataFrame:
    """One row per piece of a document: where it starts there, and where it lies in a sequence.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with
    ``with_ids``, ``ids``. ``tokenizer`` is a tokenizer file (JSON); a document is its ids and
    then id 1. A NULL or empty text is that one id. Every row is packed, also one without id or
    one that repeats another. Sequences are full windows or have a power of two as length. An
    empty table gives no rows; other columns are not read.
    """
    with open(tokenizer, "rb") as file:  # a vocabulary of fixed size, sent once to each executor
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [c.split()[0] for c in _PIECES.split(", ")] + ["ids"] * with_ids

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary.value)
        for batch in batches:
            texts, found = utf8(batch.column("text")), []
            for a, b in slices(texts, _ENCODED):
                found.extend(ids.astype("<u2").tobytes() for ids in encode.batch(texts[a:b]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "tokens"])

    slim = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    # two bytes a token, encoded once; read for the statistics, the sample and the routing
    tokens = landed(slim.mapInArrow(encoded, "doc_id long, tokens binary"), "packing-tokens")
    stats = statistics(tokens)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32

        def laid(ids: list, docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out: list[tuple] = []
            parts: list[np.ndarray] = []
            for pieces in windows(docs, settings, stats):
                offset = 0
                for doc, start, length in pieces:
                    part = docs[doc][start : start + length].astype("<u4")
                    out.append((ids[doc], start, length, zlib.crc32(part), len(docs[doc]), sequence, offset))
                    parts.append(part)
                    offset += length
                sequence += 1
                if len(out) >= 5000:
                    yield batch_of(out, parts)
                    out, parts = [], []
            if out:
                yield batch_of(out, parts)

        ids, shard, size = [], [], 0
        for batch in batches:
            for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), _docs(batch)):
                if shard and size + len(tokens) > settings.shard_tokens:
                    yield from laid(ids, shard)
                    ids, shard, size = [], [], 0
                ids.append(doc_id)
                shard.append(tokens)
                size += len(tokens)
        yield from laid(ids, shard)

    def batch_of(out: list[tuple], parts: list[np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
        if with_ids:
            columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
        return pa.record_batch(columns, names)

    return routed(tokens, stats, settings).mapInArrow(rows, _PIECES + ", ids array<int>" * with_ids)
