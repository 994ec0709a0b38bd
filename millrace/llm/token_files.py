"""Texts as files of token ids, and back.

A file holds the ids of documents in ascending order of their ids, in segments that are written and
read one at a time, so memory does not depend on the size of a file or a document:

    file     magic, version, ids per block; segments; a segment of no documents ends the file
    segment  bytes of its index and shares, number of documents and blocks, crc32 of what follows up
             to the blocks; index; shares; bytes and crc32 of each block; blocks
    index    id, known, number of ids and whether the document ends here, for each document (zstd)
    shares   how often each id occurs in the segment, as ``token_coder`` packs it

Both heads end in a crc32 of their own. A block is coded by ``token_coder``, needs the shares of its
segment and no other block, and carries the crc32 of its ids (little-endian unsigned 32-bit). Documents
may go on in the next block or segment.

Every task writes files under names of its own; the table of files, written last and by Spark, says
which of them count. A task that is run again leaves its first file behind unnamed, never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from millrace.llm import token_coder

_MAGIC, _VERSION = b"MTID", 2
_HEAD = struct.Struct("<4sII")
_SEGMENT = struct.Struct("<QIIII")
_CHECK = struct.Struct("<I")
_BLOCK = struct.Struct("<II")
_CACHED = 3 << 18
_PIECE = 1 << 22


@dataclass(frozen=True)
class Settings:
    """``end`` is put after each document; a file takes about ``file_bytes`` of text.

    A segment holds at most ``lanes`` blocks of ``block`` ids, which bounds the memory of a task.
    """

    end: int = 2
    file_bytes: int = 32 << 20
    block: int = token_coder.BLOCK
    lanes: int = token_coder.LANES


# ---- texts to ids ----------------------------------------------------------------------------


# kinds of bytes. A text is cut where white space begins or ends, between letters, digits and signs, and
# between digits. An apostrophe may open the ending of a word and a bar the end of a special token, so
# there, and at what is not ASCII, nothing else is cut
_OTHER, _LETTER, _DIGIT, _SIGN, _SPACE = range(5)


def _kinds() -> tuple[bytes, bytes]:
    """The kind of each byte, and whether a text is cut between two kinds (three bits each)."""
    kind, cut = np.full(256, _OTHER, np.uint8), np.zeros((32, 8), bool)
    kind[33:127], kind[48:58] = _SIGN, _DIGIT
    kind[65:91] = kind[97:123] = _LETTER
    kind[list(b"'|")] = _OTHER
    kind[[0x20, *range(0x09, 0x0E)]] = _SPACE
    cut[_SPACE, :_SPACE] = cut[:_SPACE, _SPACE] = True
    cut[_LETTER:_SPACE, _LETTER:_SPACE] = ~np.eye(3, dtype=bool)
    cut[_DIGIT, _DIGIT] = True
    return kind.tobytes(), cut.tobytes()


_KIND, _CUT = _kinds()
_JOINED = 512  # words that are encoded as one text


class Encoder:
    """Ids of whole texts by a tokenizer that drops white space and makes letters small.

    Such a tokenizer never looks across white space, nor from one kind of ASCII character to another. A
    text is cut there and each distinct run is encoded once; the ids of runs met before are kept, up to
    a bound.
    """

    def __init__(self, tokenizer_json: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self._tokenizer = Tokenizer.from_str(tokenizer_json.decode())
        # small letters a-z are changed by no step before the merges, only parted at white space
        self._plain = Tokenizer.from_str(tokenizer_json.decode())
        self._plain.normalizer = None
        self._plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._closes = np.zeros(1 << 16, bool)  # ids that end a word
        self._closes[[i for token, i in self._tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self._forget()
        known = "The end.of 12 (WORDS)! isn't_here x'd"
        if self([known])[0].tolist() != self._tokenizer.encode(known, add_special_tokens=False).ids:
            raise ValueError("this tokenizer parts words by other rules")

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._ids, self._starts = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def _learn(self, runs: list[bytes]) -> None:
        plain: list[bytes] = []
        words: list[str] = []
        others: list[str] = []
        for run in runs:
            if run.isalpha() and run.islower():  # of bytes: a-z
                plain.append(run)
            else:
                text = run.decode()
                (words if text.isalpha() else others).append(text)
        found = [self._words(self._plain, [r.decode() for r in plain]), self._words(self._tokenizer, words)]
        found.append(self._singly(others))
        met = [*plain, *(w.encode() for w in words), *(r.encode() for r in others)]
        self._place.update(zip(met, range(len(self._place), len(self._place) + len(met))))
        self._ids = np.concatenate([self._ids, *(ids for ids, _ in found)])
        sizes = np.concatenate([sizes for _, sizes in found])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])

    def _words(self, tokenizer: Tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, many in one text: each has one id that ends a word, its last one.

        Where a text has more, something in it is no word for the tokenizer, and each is encoded alone.
        """
        groups = [words[a : a + _JOINED] for a in range(0, len(words), _JOINED)]
        ids, sizes = [_flat([])], [np.zeros(0, np.int64)]
        for group, e in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            flat = _flat([e.ids])
            ends = np.flatnonzero(self._closes[flat])
            if len(ends) == len(group) and ends[-1] == len(flat) - 1:
                ids.append(flat)
                sizes.append(np.diff(ends, prepend=-1))
            else:
                alone = self._singly(group)
                ids.append(alone[0])
                sizes.append(alone[1])
        return np.concatenate(ids), np.concatenate(sizes)

    def _singly(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        return _flat(found), np.array([len(i) for i in found], np.int64)

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a long text, part by part."""
        for piece in _pieces(text):
            yield self([piece])[0]

    def __call__(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and how many each has."""
        runs, first = _cut(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()))
        runs = runs.dictionary_encode()
        names = runs.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self._place) + len(names) > _CACHED:
            self._forget()
        place = np.fromiter(map(self._place.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(place < 0).tolist()
        if new:
            self._learn([names[k] for k in new])
            place[new] = [self._place[names[k]] for k in new]
        starts, sizes = self._starts[place], np.diff(self._starts)[place]
        number = runs.indices.to_numpy(zero_copy_only=False)
        starts, sizes = starts[number], sizes[number]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._ids[np.repeat(starts - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, np.diff(upto[first])


def _flat(ids: list[list[int]]) -> np.ndarray:
    flat = np.fromiter(chain.from_iterable(ids), np.int64)
    if len(flat) and flat.max() > 65535:
        raise ValueError("this file format holds ids below 65,536")
    return flat.astype(np.uint16)


def _cut(texts: pa.LargeStringArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The runs of all texts one after another, and the number of the first run of each text.

    Letters A-Z come as small ones where no mark can follow that would join with them, unless a text
    may name a special token: that is told by its letters.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    begins = offsets - offsets[0]
    held = data.tobytes()
    kind = np.frombuffer(held.translate(_KIND), np.uint8)
    cut = np.ones(len(data) + 1, bool)
    if len(data):
        cut[1:-1] = np.frombuffer(((kind[:-1] << 3) | kind[1:]).tobytes().translate(_CUT), bool)
    cut[begins] = True
    if b"<|" not in held:
        upper = (data - 65 < 26).view(np.uint8)
        upper[:-1] &= data[1:] < 128
        data = data + (upper << 5)
    edges = np.flatnonzero(cut)
    solid = kind != _SPACE
    filled = solid[edges[:-1]] if len(data) else np.zeros(0, bool)
    sizes = np.diff(edges)[filled] if len(data) else np.zeros(0, np.int64)
    stops = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    buffers = [None, pa.py_buffer(stops), pa.py_buffer(data[solid])]
    runs = pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers)
    return runs, np.concatenate([[0], np.cumsum(filled)])[np.searchsorted(edges, begins)]


_LOADED: dict[int, Encoder] = {}


def encoder(tokenizer_json: bytes) -> Encoder:
    """One encoder for each Python worker, which keeps what it has met from task to task."""
    key = hash(tokenizer_json)
    if key not in _LOADED:
        _LOADED[key] = Encoder(tokenizer_json)
    return _LOADED[key]


def _pieces(text: str) -> Iterator[str]:
    """A text in parts that end before white space."""
    at = 0
    while at < len(text):
        cut = min(len(text), at + _PIECE)
        while cut < len(text) and text[cut] not in " \t\n\r\v\f":
            cut += 1
        yield text[at:cut]
        at = cut


# ---- a file ----------------------------------------------------------------------------------


def _checked(head: bytes) -> bytes:
    return head + _CHECK.pack(zlib.crc32(head))


class _FileWriter:
    def __init__(self, folder: str, settings: Settings) -> None:
        self._system, root = fs.FileSystem.from_uri(folder)
        self._system.create_dir(root, recursive=True)
        self.name = f"part-{uuid.uuid4().hex}.tids"
        self._out = self._system.open_output_stream(f"{root}/{self.name}")
        self._settings = settings
        self._out.write(_checked(_HEAD.pack(_MAGIC, _VERSION, settings.block)))
        self.docs = self.tokens = 0
        self._rows: list[tuple[int, int, int, int]] = []  # id, known, ids here, ends here
        self._parts: list[np.ndarray] = []
        self._size = 0

    def add(self, doc_id: int | None, ids: np.ndarray, ends: bool) -> None:
        """Ids of a document; the last call for it has ``ends``."""
        most = self._settings.block * self._settings.lanes
        while self._size + len(ids) > most:
            room = most - self._size
            self._take(doc_id, ids[:room], False)
            ids = ids[room:]
            self._flush()
        self._take(doc_id, ids, ends)
        self.docs += ends

    def _take(self, doc_id: int | None, ids: np.ndarray, ends: bool) -> None:
        self._rows.append((doc_id or 0, doc_id is not None, len(ids), ends))
        self._parts.append(ids)
        self._size += len(ids)

    def _flush(self) -> None:
        if not self._rows:
            return
        block = self._settings.block
        stream = np.concatenate(self._parts)
        blocks = [stream[a : a + block] for a in range(0, len(stream), block)]
        index = zstandard.compress(np.array(self._rows, np.int64).T.tobytes(), 3)
        shares, payloads = token_coder.encode_together(blocks)
        sums = [zlib.crc32(b.astype("<u4")) for b in blocks]
        lists = index + shares + b"".join(_BLOCK.pack(len(p), c) for p, c in zip(payloads, sums))
        head = _SEGMENT.pack(len(index), len(shares), len(self._rows), len(blocks), zlib.crc32(lists))
        self._out.write(b"".join([_checked(head), lists, *payloads]))
        self.tokens += len(stream)
        self._rows, self._parts, self._size = [], [], 0

    def close(self) -> int:
        self._flush()
        self._out.write(_checked(_SEGMENT.pack(0, 0, 0, 0, 0)))
        size = self._out.tell()
        self._out.close()
        return size


def _exactly(source: pa.NativeFile, size: int) -> bytes:
    data = source.read(size)
    if len(data) != size:
        raise ValueError("a file of token ids ends too early")
    return data


def _head(source: pa.NativeFile, kind: struct.Struct) -> tuple:
    data = _exactly(source, kind.size)
    if _exactly(source, _CHECK.size) != _CHECK.pack(zlib.crc32(data)):
        raise ValueError("a file of token ids is damaged or none")
    return kind.unpack(data)


def read_file(folder: str, name: str) -> Iterator[tuple[int | None, np.ndarray, bool]]:
    """(id, ids, whether the document ends) of a file, checked; segment by segment."""
    system, root = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{root}/{name}") as source:
        magic, version, block = _head(source, _HEAD)
        if (magic, version) != (_MAGIC, _VERSION):
            raise ValueError(f"{name} is no file of token ids")
        while True:
            size, shared, docs, blocks, check = _head(source, _SEGMENT)
            if not docs:
                return
            lists = _exactly(source, size + shared + blocks * _BLOCK.size)
            if zlib.crc32(lists) != check:
                raise ValueError(f"the index of {name} is damaged")
            index = np.frombuffer(zstandard.decompress(lists[:size]), np.int64)
            ids, known, lengths, ends = index.reshape(4, docs).tolist()
            table = list(_BLOCK.iter_unpack(lists[size + shared :]))
            payloads = [_exactly(source, n) for n, _ in table]
            left = sum(lengths)
            sizes = [block] * (blocks - 1) + [left - block * (blocks - 1)] if blocks else []
            found = token_coder.decode_together(lists[size : size + shared], payloads, sizes)
            if any(zlib.crc32(b.astype("<u4")) != c for b, (_, c) in zip(found, table)):
                raise ValueError(f"a block of {name} is damaged")
            stream, at = np.concatenate(found) if found else np.zeros(0, np.uint16), 0
            for doc_id, there, length, last in zip(ids, known, lengths, ends):
                yield doc_id if there else None, stream[at : at + length], bool(last)
                at += length


# ---- over tables -----------------------------------------------------------------------------


_FILES = "part long, file string, docs long, tokens long, bytes long"
_TOKENS = "doc_id long, start long, n_tokens long, tokens binary"


def write(docs: DataFrame, folder: str, tokenizer: str, settings: Settings = Settings()) -> DataFrame:
    """Files of the ids of ``docs (doc_id, text)`` below ``folder``, in ascending order of ids.

    Returns, as a table below ``folder``, one row per file in the order of the files: ``part``, ``file``,
    ``docs``, ``tokens``, ``bytes``. A NULL or empty text is its end id alone. Documents without id
    come first; rows that repeat an id are ordered by a hash of the text, and rows equal in both are
    written as often as they occur. A text of any length is encoded whole, in parts. An empty table
    gives no file. Other columns are not read. ``folder`` is one that all executors share.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:  # a vocabulary of fixed size, sent once to each executor
        vocabulary = spark.sparkContext.broadcast(file.read())
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = slim.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // settings.file_bytes))
    ordered = slim.withColumn("spot", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "spot")
    ordered = ordered.sortWithinPartitions("doc_id", "spot").select("doc_id", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = encoder(vocabulary.value), None
        end = np.array([settings.end], np.uint16)
        for batch in batches:
            for a, b in _runs(batch.column("text")):
                ids, texts = batch.column("doc_id").slice(a, b - a).to_pylist(), batch.column("text").slice(a, b - a)
                out = out or _FileWriter(folder, settings)
                if len(texts) == 1 and len(text := texts[0].as_py()) > _PIECE:
                    for part in encode.parts(text):
                        out.add(ids[0], part, False)
                    out.add(ids[0], end, True)
                    continue
                found, sizes = encode(texts)
                stops = np.cumsum(sizes)
                for doc_id, size, stop in zip(ids, sizes.tolist(), stops.tolist()):
                    out.add(doc_id, np.concatenate([found[stop - size : stop], end]), True)
        if out is not None:
            size = out.close()
            row = [[TaskContext.get().partitionId()], [out.name], [out.docs], [out.tokens], [size]]
            yield pa.record_batch([pa.array(c) for c in row], [c.split()[0] for c in _FILES.split(", ")])

    ordered.mapInArrow(rows, _FILES).write.parquet(f"{folder}/files")
    return files(spark, folder)


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of texts that are short together; a long one is alone."""
    sizes = pc.binary_length(texts).to_pylist()
    begin = size = 0
    for i, n in enumerate(sizes):
        if i > begin and size + n > _PIECE:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield begin, len(sizes)


def files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_FILES).parquet(f"{folder}/files")


def with_starts(held: DataFrame, group: int = 4096) -> DataFrame:
    """The table of files with ``start``, the ids of all files before.

    Sums within groups of neighbouring files first, so that no window spans the table.
    """
    grouped = held.withColumn("_group", F.floor(F.col("part") / group))
    sums = grouped.groupBy("_group").agg(F.sum("tokens").alias("_sum"))
    one = Window.partitionBy(F.lit(0)).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select("_group", F.coalesce(F.sum("_sum").over(one), F.lit(0)).alias("_head"))
    inside = Window.partitionBy("_group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = grouped.withColumn("_before", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return rows.join(heads, "_group").select(*held.columns, (F.col("_head") + F.col("_before")).alias("start"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files below ``folder``: ``doc_id, start, n_tokens, tokens``.

    ``start`` counts the ids of all documents before, ``tokens`` are the ids as little-endian unsigned
    32-bit numbers. A damaged file is an error that names it.
    """
    held = with_starts(files(spark, folder)).select("part", "file", "start")
    number = held.count()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                at, ready, size = row["start"], [], 0
                parts: list[np.ndarray] = []
                for doc_id, ids, last in read_file(folder, row["file"]):
                    parts.append(ids)
                    if not last:
                        continue
                    whole = parts[0] if len(parts) == 1 else np.concatenate(parts)
                    ready.append((doc_id, at, len(whole), whole.astype("<u4").tobytes()))
                    at, size, parts = at + len(whole), size + 4 * len(whole), []
                    if size > _PIECE:
                        yield _batch(ready, names)
                        ready, size = [], 0
                if ready:
                    yield _batch(ready, names)

    spread = held.repartitionByRange(max(1, number), "part")
    return spread.mapInArrow(rows, _TOKENS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    ids, starts, sizes, tokens = zip(*rows)
    columns = [pa.array(c, pa.int64()) for c in (ids, starts, sizes)]
    return pa.record_batch([*columns, pa.array(tokens, pa.binary())], names)
