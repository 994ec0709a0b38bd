"""Documents dealt into chunks of bounded size, which ask buckets and get answers back.

A chunk asks about each distinct thing it holds once, whatever its copies, so what is common in the
corpus reaches a bucket once for each chunk and no bucket is hot. Chunks are read twice, from one
shuffle: when asking, and when the answers come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import utf8

CHUNK_BYTES = 16 << 20
ASKED = "chunk long, bucket long, asked binary"
ANSWERED = "chunk long, bucket long, answer binary"


def pack_bytes(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def unpack_bytes(data: bytes) -> bytes:
    return zstandard.decompress(data)


def chunk_count(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> int:
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    return max(1, -(-int(total) // chunk_bytes))


def deal(docs: DataFrame, chunks: int, chunk: Column | None = None) -> DataFrame:
    """``chunk, block``: documents in compressed blocks, each chunk whole in one partition.

    ``chunk`` is a number from 0 to ``chunks`` - 1, by default by a hash of the id.
    """
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)) if chunk is None else chunk
    slim = docs.select(spread.cast("long").alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_blocks, "chunk long, block binary").repartition(chunks, "chunk")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers = batch.column("chunk").to_numpy()
        ids, texts = batch.column("doc_id").to_pylist(), utf8(batch.column("text"))
        order = np.argsort(numbers, kind="stable")
        names, at = np.unique(numbers[order], return_index=True)
        rows = []
        for part in np.split(order, at[1:]) if len(order) else []:
            known = np.array([ids[k] is not None for k in part], np.int64)
            values = np.array([ids[k] or 0 for k in part], np.int64)
            sizes = np.array([len(texts[k]) for k in part], np.int64)
            head = np.concatenate([[len(part)], known, values, sizes]).astype(np.int64)
            rows.append(pack_bytes(head.tobytes() + b"".join(texts[k] for k in part)))
        yield pa.record_batch([pa.array(names), pa.array(rows, pa.binary())], ["chunk", "block"])


def in_order(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """Ids and texts of a chunk by id (NULL last), equal ids by text.

    Both readings of a chunk see one order, however its blocks arrive.
    """
    found: list[tuple[int | None, bytes]] = []
    for block in table.column("block"):
        data = unpack_bytes(block.as_py())
        n = int(np.frombuffer(data[:8], np.int64)[0])
        known, values, sizes = np.frombuffer(data[8 : 8 + 24 * n], np.int64).reshape(3, n).tolist()
        at = 8 + 24 * n
        for k, v, size in zip(known, values, sizes):
            found.append((v if k else None, data[at : at + size]))
            at += size
    found.sort(key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    return [i for i, _ in found], [t for _, t in found]


def asked_table(chunk: int, buckets: list[int], rows: list[bytes]) -> pa.Table:
    numbers = pa.array([chunk] * len(rows), pa.int64())
    return pa.table(
        {"chunk": numbers, "bucket": pa.array(buckets, pa.int64()), "asked": pa.array(rows, pa.binary())}
    )


def planes(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: small ones cost little."""
    return pack_bytes(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def from_planes(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(unpack_bytes(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def bucket_edges(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets sorted ``keys`` fall into, and where each begins; a bucket is a key range."""
    number = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    names, at = np.unique(number, return_index=True)
    return names.astype(np.int64), np.append(at, len(keys))


def ask_counts(chunk: int, keys: np.ndarray, times: np.ndarray, buckets: int) -> pa.Table:
    """A chunk's sorted distinct keys and their counts in it, for the buckets that add them up."""
    names, at = bucket_edges(keys, buckets)
    rows = []
    for a, b in zip(at, at[1:]):
        packed = planes(np.diff(keys[a:b], prepend=np.uint64(0)))
        rows.append(np.int64(len(packed)).tobytes() + packed + planes(times[a:b].astype(np.uint32)))
    return asked_table(chunk, names.tolist(), rows)


def asked_counts(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int(np.frombuffer(block[:8], np.int64)[0])
    return np.cumsum(from_planes(block[8 : 8 + size], np.uint64)), from_planes(block[8 + size :], np.uint32)


def add_counts(table: pa.Table) -> pa.Table:
    """Sums over all chunks of each key, for each chunk in its own order."""
    keys, times = zip(*(asked_counts(b.as_py()) for b in table["asked"]))
    distinct, group = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(group, np.concatenate(times), len(distinct)).astype(np.int64)[group]
    bounds = np.cumsum([0, *map(len, keys)])
    answers = [planes(total[a:b]) for a, b in zip(bounds, bounds[1:])]
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "answer": pa.array(answers, pa.binary())})


def answered_counts(keys: np.ndarray, answers: pa.Table, buckets: int) -> np.ndarray:
    """The sums for a chunk's sorted distinct ``keys``."""
    by_bucket = dict(zip(answers["bucket"].to_pylist(), answers["answer"].to_pylist()))
    names, at = bucket_edges(keys, buckets)
    counts = np.zeros(len(keys), np.int64)
    for name, a, b in zip(names.tolist(), at, at[1:]):
        counts[a:b] = from_planes(by_bucket[name], np.int64)
    return counts
