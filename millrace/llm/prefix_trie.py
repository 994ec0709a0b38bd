"""The trie of conversation prefixes: which beginnings conversations share, and what that saves.

A prefix is known by a sha256 chained over its turns, so text is read once and never shuffled. A
count-min sketch of all prefixes, saturating at two, screens them: where its estimate is one, the prefix
occurs once, and so do all longer ones of that conversation. Such tails are written out where they
are. Only prefixes that may be shared are shuffled and grouped exactly; a sketch that is too
small for its input only lets more of them through.

Sums over subtrees need no walk by level. A node belongs to the member with the smallest id, and what a
conversation owns is the end of its path; so each conversation adds, at every depth of its path,
what it owns from there on, and one sum by prefix gives the subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.scratch import landed
from millrace.llm.words import mix

_EMPTY = hashlib.sha256(b"").hexdigest()
_ROWS = 3  # of the sketch
_SLICE = 1 << 16
_SALT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_HOT = 1000  # a prefix with more than one row in so many is hot; there are fewer of them than this


@dataclass(frozen=True)
class Settings:
    """``cells`` of each of the sketch's three rows, at most; one bit of each is broadcast."""

    cells: int = 1 << 24
    text_bytes: int = 1 << 18


# ---- conversations ---------------------------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, rank, digest, n_chars``: the turns of each conversation in order.

    Ordered by turn (NULL first), equal turns by role and then by a digest of the text; rows without
    id belong to no conversation and are left out. NULL role or text is empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        # the length in front keeps role and text apart
        F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest", "n_chars")
    return slim.select("conv_id", F.row_number().over(order).alias("rank"), "digest", "n_chars")


def rebuilt(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Every conversation with its first turns taken from another one.

    ``heads`` (at most ``most``) and ``base`` are given in terms of ``conv_id``. Columns: ``conv_id, depth,
    digest, n_chars, n_turns``; a conversation without any turn left has one row of depth 0. A base
    serves a bounded number of conversations by their ids, and gives ``most`` turns at the most.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    known = landed(lengths.select("conv_id", "own", base.alias("base"), heads.alias("heads")), "trie-lengths")
    of_base = known.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    plan = known.join(of_base, "base", "left").select(
        "conv_id",
        "base",
        "heads",
        F.least("heads", F.coalesce("base_own", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("heads"), F.lit(0)).alias("left"),
    )
    plan = landed(plan.withColumn("n_turns", F.col("taken") + F.col("left")), "trie-plan")
    own = turns.join(plan, "conv_id").where("rank > heads")
    own = own.select("conv_id", (F.col("taken") + F.col("rank") - F.col("heads")).alias("depth"), "digest", "n_chars", "n_turns")
    first = turns.where(F.col("rank") <= most).withColumnRenamed("conv_id", "base")
    lent = first.join(plan, "base").where("rank <= heads")
    lent = lent.select("conv_id", F.col("rank").cast("long").alias("depth"), "digest", "n_chars", "n_turns")
    none = plan.where("n_turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("n_chars"), "n_turns",
    )
    return own.unionByName(lent).unionByName(none)


_PREFIX = "conv_id long, depth long, n_turns long, prefix binary, before long, n_chars long"


def prefixes(whole: DataFrame) -> DataFrame:
    """Each turn with the chained digest of all up to it; ``before`` is the key of the one before.

    A stream over sorted rows: what is carried from row to row is one digest.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain = None, b""
        for batch in batches:
            found, before = [], []
            for c, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()):
                if c != conv:
                    conv, chain = c, b""
                before.append(int.from_bytes(chain[:8], "little", signed=True))
                chain = hashlib.sha256(chain + digest).digest() if digest is not None else b""
                found.append(chain)
            columns = [batch.column(c) for c in ("conv_id", "depth", "n_turns")]
            columns += [pa.array(found, pa.binary()), pa.array(before, pa.int64()), batch.column("n_chars")]
            yield pa.record_batch(columns, [c.split()[0] for c in _PREFIX.split(", ")])

    ordered = whole.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.select("conv_id", "depth", "n_turns", "digest", "n_chars").mapInArrow(rows, _PREFIX)


# ---- the sketch ------------------------------------------------------------------------------


def keys_of(column: pa.Array) -> np.ndarray:
    """The first eight bytes of each prefix."""
    data = b"".join(x[:8] for x in column.to_pylist())
    return np.frombuffer(data, "<u8")


def cells_of(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    """Where a row of the sketch counts each key; ``cells`` is a power of two."""
    return (mix(keys ^ _SALT[row]) >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)


@dataclass(frozen=True)
class Sketch:
    """One bit of each cell: whether it counted two or more."""

    cells: int
    twice: tuple[np.ndarray, ...]

    def shared(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that were counted once."""
        out = np.ones(len(keys), bool)
        for row, bits in enumerate(self.twice):
            at = cells_of(keys, row, self.cells)
            out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def sketch(found: DataFrame, settings: Settings = Settings()) -> Sketch:
    """Counts of all prefixes, up to two. Tasks send slices of their counts, compressed; each slice is
    added up by one task as they come. What reaches the driver is a bit for each cell."""
    n = found.where("depth > 0").count()
    cells = max(1 << 10, min(settings.cells, 1 << max(0, 4 * n - 1).bit_length()))
    width = min(cells, _SLICE)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((_ROWS, cells), np.uint8)
        for batch in batches:
            keys = keys_of(batch.column("prefix"))
            for row in range(_ROWS):
                at, times = np.unique(cells_of(keys, row, cells), return_counts=True)
                held[row, at] = np.minimum(held[row, at] + np.minimum(times, 2), 2)
        parts = held.reshape(-1, width)
        for number in np.flatnonzero(parts.any(axis=1)).tolist():
            data = zstandard.compress(parts[number].tobytes(), 1)
            yield pa.record_batch([pa.array([number]), pa.array([data])], ["number", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("number").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zstandard.decompress(data), np.uint8)
                total[number] = np.minimum(total[number] + part, 2) if number in total else part
        for number, part in total.items():
            bits = np.packbits(part == 2, bitorder="little").tobytes()
            yield pa.record_batch([pa.array([number]), pa.array([bits])], ["number", "bits"])

    sent = found.where("depth > 0").select("prefix").mapInArrow(counted, "number long, counts binary")
    slices = sent.repartition(max(1, _ROWS * cells // width // 16), "number").mapInArrow(added, "number long, bits binary")
    bits = np.zeros((_ROWS * cells // width, width // 8), np.uint8)
    for r in slices.collect():
        bits[r.number] = np.frombuffer(r.bits, np.uint8)
    return Sketch(cells, tuple(bits.reshape(_ROWS, cells // 8)))


def screened(found: DataFrame, estimates: Sketch) -> DataFrame:
    """Prefixes of depth 1 and more with ``shared`` and ``parent_shared``: False proves a single one.

    The root counts as shared.
    """
    sent = found.sparkSession.sparkContext.broadcast(estimates)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = sent.value.shared(keys_of(batch.column("prefix")))
            before = sent.value.shared(batch.column("before").to_numpy().view(np.uint64))
            before |= batch.column("depth").to_numpy() == 1
            yield pa.record_batch(
                [*batch.columns, pa.array(here), pa.array(before)], [*batch.schema.names, "shared", "parent_shared"]
            )

    return found.where("depth > 0").mapInArrow(rows, f"{_PREFIX}, shared boolean, parent_shared boolean")


# ---- the trie --------------------------------------------------------------------------------


def _single(depth: Column, conv: Column, parent: Column) -> list[Column]:
    """The columns of a node with one member, ``n_turns`` long."""
    last = depth == F.col("n_turns")
    return [
        conv.alias("conv_id"),
        depth.alias("depth"),
        parent.alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(conv.cast("string"), 256)).otherwise(_EMPTY).alias("ends_sha256"),
    ]


def _with_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` with the members, smallest id and longest conversation of their prefix.

    A prefix that holds more than a ``_HOT``-th of all rows is joined by broadcast, and there are fewer
    than ``_HOT`` of those; so no task gets all rows of one prefix.
    """
    total = rows.count()
    hot = nodes.where(F.col("n_convs") * _HOT > total)
    rest = nodes.where(F.col("n_convs") * _HOT <= total)
    held = rows.join(F.broadcast(hot), "prefix", "left")
    left = held.where("first IS NULL").select(rows.columns).join(rest, "prefix")
    return held.where("first IS NOT NULL").unionByName(left)


def ends(last: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``prefix, ends_sha256`` of ``last (prefix, conv_id)``: ids in ascending order, joined by commas.

    Sorted in ranges of prefix and id, so a frequent prefix is spread; each range sends text in
    parts, which one task of each prefix feeds to its hash as they come.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["prefix", "first", "text"]
        prefix, ids, size = None, [], 0
        for batch in batches:
            for p, c in zip(batch.column("prefix").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (p != prefix or size > settings.text_bytes):
                    yield pa.record_batch([pa.array([prefix], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names)
                    ids, size = [], 0
                prefix = p
                ids.append(c)
                size += 1 + len(str(c))
        if ids:
            yield pa.record_batch([pa.array([prefix], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, held = None, None
        for batch in batches:
            done, digests = [], []
            for p, text in zip(batch.column("prefix").to_pylist(), batch.column("text").to_pylist()):
                if p != prefix:
                    if held is not None:
                        done.append(prefix)
                        digests.append(held.hexdigest())
                    prefix, held = p, hashlib.sha256(text.encode())
                else:
                    held.update(b"," + text.encode())
            yield pa.record_batch([pa.array(done, pa.binary()), pa.array(digests, pa.string())], ["prefix", "ends_sha256"])
        if held is not None:
            yield pa.record_batch([pa.array([prefix], pa.binary()), pa.array([held.hexdigest()])], ["prefix", "ends_sha256"])

    ranged = last.select("prefix", "conv_id").repartitionByRange("prefix", "conv_id").sortWithinPartitions("prefix", "conv_id")
    parts = ranged.mapInArrow(joined, "prefix binary, first long, text string")
    ordered = parts.repartition("prefix").sortWithinPartitions("prefix", "first")
    return ordered.select("prefix", "text").mapInArrow(hashed, "prefix binary, ends_sha256 string")


def trie(whole: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per distinct prefix of the conversations ``(conv_id, depth, digest, n_chars, n_turns)``.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (nodes without children in the subtree), ``saved_tokens`` (summed over
    the subtree: members but one times code points of the last text) and ``ends_sha256`` (of the ids of
    members that end here). The root, depth 0, has every conversation as a member, turnless ones too;
    without any conversation there is no node at all.
    """
    spark = whole.sparkSession
    found = landed(prefixes(whole), "trie-prefixes")
    marked = landed(screened(found, sketch(found, settings)), "trie-screened")
    maybe = marked.where("shared").select("prefix", "conv_id", "depth", "n_turns", "n_chars")

    # exact grouping of what may be shared: tasks add up first, so a frequent prefix is a few rows
    nodes = landed(
        maybe.groupBy("prefix").agg(
            F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n_convs"), F.max("n_turns").alias("longest")
        ),
        "trie-nodes",
    )
    placed = _with_nodes(maybe, nodes)
    # each conversation from its deepest shared prefix up: what it owns so far, and its neighbours
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    owned = F.col("first") == F.col("conv_id")
    saved = F.when(owned, (F.col("n_convs") - 1) * F.col("n_chars")).otherwise(0)
    below = F.lag("depth").over(up) == F.col("depth") + 1
    above = F.lead("depth").over(up) == F.col("depth") - 1
    ends_here = F.col("depth") == F.col("n_turns")
    leaf = F.when(ends_here, owned & (F.col("longest") == F.col("depth"))).otherwise(F.lit(True))
    steps = placed.select(
        "prefix", "conv_id", "depth", "n_turns", "first", "n_convs", "longest",
        F.sum(saved).over(up.rowsBetween(Window.unboundedPreceding, 0)).alias("saved"),
        F.first(leaf).over(up.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("leaf"),
        F.when(ends_here, False).when(below, F.lag(owned).over(up)).otherwise(True).cast("long").alias("child"),
        (~ends_here & ~F.coalesce(below, F.lit(False))).alias("tail"),
        F.when(F.col("depth") > 1, F.when(above, F.lead("first").over(up)).otherwise(F.col("conv_id"))).alias("parent"),
    )
    steps = landed(steps, "trie-steps")
    inner = steps.groupBy("prefix").agg(
        F.min("first").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent_conv_id"),
        F.min("n_convs").alias("n_convs"),
        F.sum("child").alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    done = ends(steps.where("depth = n_turns"), settings)
    inner = inner.join(done, "prefix", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).drop("prefix")
    # the first of a conversation's single prefixes, below one that may be shared, and all that follow
    heads = steps.where("tail").select(*_single(F.col("depth") + 1, F.col("conv_id"), F.col("first")))
    tails = marked.where("NOT shared AND (NOT parent_shared OR depth = 1)").select(
        *_single(F.col("depth"), F.col("conv_id"), F.when(F.col("depth") > 1, F.col("conv_id")))
    )
    below_root = landed(inner.unionByName(heads).unionByName(tails), "trie-below-root")
    return _rooted(spark, found, below_root, settings)


def _rooted(spark: SparkSession, found: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """The nodes with their root; nodes of depth 1 are its children."""
    every = found.where("depth <= 1").agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n")).first()
    if not every.n:
        return nodes
    alone = F.col("n_children") == 0
    sums = nodes.agg(
        F.coalesce(F.sum(F.when(F.col("depth") == 1, 1)), F.lit(0)).alias("children"),
        F.coalesce(F.sum(F.when(alone, 1)), F.lit(0)).alias("leaves"),
        F.coalesce(F.sum(F.when(F.col("depth") == 1, F.col("saved_tokens"))), F.lit(0)).alias("saved"),
    ).first()
    turnless = found.where("depth = 0").select(F.lit(b"").alias("prefix"), "conv_id")
    last = ends(turnless, settings).first()
    digest = last.ends_sha256 if last else _EMPTY
    row = (every.first, 0, None, every.n, sums.children, max(sums.leaves, 1), sums.saved, digest)
    root = spark.createDataFrame([row], nodes.schema)
    parent = F.when(F.col("depth") == 1, F.lit(every.first)).otherwise(F.col("parent_conv_id"))
    return nodes.withColumn("parent_conv_id", parent).unionByName(root)
