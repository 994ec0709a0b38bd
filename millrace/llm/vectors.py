"""Embedding near-duplicates: an exact cosine join by epsilon grid order.

Unit vectors are turned so that the leading axes are their principal ones and sorted by grid cell,
cell width epsilon, the distance at which the cosine falls below the threshold. The sorted sequence
is cut into blocks. Starting from the whole sequence, pairs of intervals are split and joined
recursively; a pair whose bounding boxes are further apart than epsilon is skipped with all below
it. Block pairs that are left are read side by side, where the recursion goes on down to small dense
products. Nothing is left out: axes and cells only decide what may be skipped.

Equal vectors are one class with a size, so copies cost nothing. A block pair reports sums of links
and a spanning forest, never its links one by one.

What is moved and kept grows with the vectors, not with the pairs: vectors are shuffled once, as
they were given, and kept once, as blocks; a task reads the blocks of its pairs where they lie.
Everything else that is moved has a place in the order (32 bytes) instead of a vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from millrace.llm.components import components
from millrace.llm.scratch import landed


@dataclass(frozen=True)
class Settings:
    """``sample`` vectors fit the axes. Sorting uses ``sorted_axes`` of them, boxes ``box_axes``.

    A block has ``block`` vectors; of a large table more, a ``cut``-th of it, but no more than
    ``block_bytes``. Of its leaves, ``strip`` side by side meet another leaf in one product.
    """

    cosine: float = 0.9
    sample: int = 4096
    block: int = 2048
    leaf: int = 256
    sorted_axes: int = 6
    box_axes: int = 16
    fan_out: int = 8
    cut: int = 32
    block_bytes: int = 1 << 22
    strip: int = 4

    @property
    def epsilon(self) -> float:
        return float(np.sqrt(2.0 - 2.0 * self.cosine)) * (1 + 1e-6) + 1e-6


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by the largest entry, so that nothing overflows."""
    scaled = vectors.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal columns, the one of most spread first."""
    unit = _unit(vectors)
    return np.linalg.eigh(unit.T @ unit)[1][:, ::-1]


@dataclass(frozen=True)
class Turn:
    """The axes, and how many leading ones bound a cosine well enough to be multiplied first."""

    axes: np.ndarray
    lead: int

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """Vectors of another length than the axes stay as they are."""
        return unit @ self.axes if unit.shape[1] == len(self.axes) else unit


def _turn(sample: np.ndarray, settings: Settings) -> Turn:
    """Fitted to ``sample``; ``lead`` axes let at most one of 100,000 of its pairs through in vain."""
    axes = principal_axes(sample)
    turned = _unit(sample[:2048]) @ axes
    links = (turned @ turned.T >= settings.cosine).sum()
    for lead in (m << k for k in range(2, len(axes).bit_length()) for m in (4, 5, 6, 7)):
        if lead * 4 > len(axes) * 3:
            break
        known = _led(turned, lead)
        if (known @ known.T >= settings.cosine).sum() - links <= len(known) ** 2 * 1e-5:
            return Turn(axes, lead)
    return Turn(axes, len(axes))


def _led(turned: np.ndarray, lead: int) -> np.ndarray:
    """Leading axes and the length of the rest: products are upper bounds of those of whole rows."""
    if lead >= turned.shape[1]:
        return turned.astype(np.float32)
    rest = np.linalg.norm(turned[:, lead:], axis=1, keepdims=True)
    return np.concatenate([turned[:, :lead], rest], axis=1).astype(np.float32)


# ---- blocks in grid order --------------------------------------------------------------------

_BLOCKS = (
    "block long, parent long, dims int, low array<double>, high array<double>, ids binary, sizes binary, vectors binary"
)

_BITS = 20


def _places(ids: pa.Array, column: pa.Array, axes: np.ndarray, settings: Settings) -> tuple[list, list]:
    """For each row its place in the order and its vector as bytes; None twice where it is unusable.

    A place is the length, the grid cell on the leading axes, and a digest: equal vectors, and only
    they, share one. Cells are found in whole numbers, so that they never depend on the machine or
    on the rows around.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False) + column.type.value_type.to_pandas_dtype()(0)  # no -0.0
    ends = np.cumsum(lengths)
    starts = ends - lengths
    odd, some = (np.append(0, np.cumsum(x)) for x in (~np.isfinite(flat), flat != 0))
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    usable = known & (odd[ends] == odd[starts]) & (some[ends] > some[starts])
    cells = np.zeros((len(lengths), settings.sorted_axes), np.int64)
    mine = np.flatnonzero(usable & (lengths == len(axes)))
    if len(mine):
        matrix = flat[starts[mine][:, None] + np.arange(len(axes))].astype(np.float64)
        whole = np.rint(matrix / np.abs(matrix).max(axis=1, keepdims=True) * 2.0**_BITS).astype(np.int64)
        turned = whole @ np.rint(axes[:, : settings.sorted_axes] * 2.0**_BITS).astype(np.int64)
        length = np.sqrt((whole * whole).sum(axis=1).astype(np.float64))[:, None]
        cells[mine, : turned.shape[1]] = np.floor(turned / length / 2.0**_BITS / settings.epsilon)
    cells = (np.clip(cells, -(1 << 15), (1 << 15) - 1) + (1 << 15)).astype(">u2")
    data, width = memoryview(np.ascontiguousarray(flat)).cast("B"), flat.itemsize
    places, vectors = [None] * len(lengths), [None] * len(lengths)
    for k in np.flatnonzero(usable).tolist():
        vectors[k] = data[starts[k] * width : ends[k] * width]
        places[k] = int(lengths[k]).to_bytes(4, "big") + cells[k].tobytes() + blake2b(vectors[k], digest_size=16).digest()
    return places, vectors


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, as they are worked on in double precision."""
    for batch in batches:
        yield from (batch.slice(k, 2048) for k in range(0, batch.num_rows, 2048))


def _keyed(rows: DataFrame, axes: np.ndarray, settings: Settings) -> DataFrame:
    """``vec_id, place`` of each row of ``rows (vec_id, v)``; the place of an unusable row is NULL."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            places, _ = _places(*batch.columns, axes, settings)
            yield pa.record_batch([batch.column(0), pa.array(places, pa.binary())], ["vec_id", "place"])

    return rows.mapInArrow(keyed, "vec_id long, place binary")


def _blocks(rows: DataFrame, classes: DataFrame, axes: np.ndarray, settings: Settings, kind: str, per: int, partitions: int) -> DataFrame:
    """The sequence in grid order, cut into blocks; a range partition is their common parent.

    Two sorts of rows meet at a place: vectors, one for all of a batch that are equal, and the id
    and size of the class.
    """
    dtype = np.dtype(kind)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for piece in _pieces([batch]):
                found.update(zip(*_places(*piece.columns, axes, settings)))
            found.pop(None, None)
            columns = [pa.array([*x], pa.binary()) for x in (found.keys(), found.values())]
            yield pa.record_batch(columns, ["place", "v"])

    vectors = rows.mapInArrow(placed, "place binary, v binary")
    nothing = F.lit(None).cast("long")
    both = vectors.select("place", "v", nothing.alias("class_id"), nothing.alias("size")).unionByName(
        classes.select("place", F.lit(None).cast("binary").alias("v"), "class_id", "size")
    )
    sorted_rows = both.repartitionByRange(partitions, "place").sortWithinPartitions("place")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        now = [None]
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("place", "v", "class_id", "size"))):
                if row[0] != now[0]:
                    if now[0] is not None:
                        yield now
                    now = [*row]
                elif row[1] is not None:
                    now[1] = row[1]
                else:
                    now[2:] = row[2:]
        if now[0] is not None:
            yield now

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        made, waiting = 0, []

        def block(rows: list[list]) -> pa.RecordBatch:
            nonlocal made
            data = b"".join(r[1] for r in rows)
            given = np.frombuffer(data, dtype).reshape(len(rows), -1)
            low, high = np.inf, -np.inf
            for k in range(0, len(given), 2048):
                unit = _unit(given[k : k + 2048])
                turned = (unit @ axes[:, : settings.box_axes] if unit.shape[1] == len(axes) else unit)[:, : settings.box_axes]
                low, high = np.minimum(low, turned.min(axis=0)), np.maximum(high, turned.max(axis=0))
            ids, sizes = (np.array([r[k] for r in rows], np.int64).tobytes() for k in (2, 3))
            values = ((number << 24) + made, number, unit.shape[1], low, high, ids, sizes, data)
            made += 1
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            types = [pa.int64(), pa.int64(), pa.int32(), *[pa.list_(pa.float64())] * 2, *[pa.binary()] * 3]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names)

        for row in merged(batches):
            full = waiting and min(per, max(1, settings.block_bytes // len(waiting[0][1])))
            if waiting and (len(waiting) >= full or len(row[1]) != len(waiting[0][1])):
                yield block(waiting)
                waiting = []
            waiting.append(row)
        if waiting:
            yield block(waiting)

    return sorted_rows.mapInArrow(cut, _BLOCKS)


def _near(settings: Settings) -> Column:
    """Are the boxes (low_a, high_a) and (low_b, high_b) within epsilon of each other?"""
    gap = F.zip_with(
        F.zip_with("low_a", "high_b", lambda x, y: x - y),
        F.zip_with("low_b", "high_a", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= settings.epsilon**2


def block_pairs(boxes: DataFrame, settings: Settings, partitions: int) -> DataFrame:
    """``a, b`` (a <= b): blocks that may hold a link. ``boxes``: block, parent, dims, low, high.

    Intervals of the sequence form a tree: blocks, range partitions, and ``fan_out`` of what is
    below. Pairs of intervals are joined with their children by parent, level by level.
    """

    levels = [boxes]
    width = partitions
    while True:
        below = levels[-1]
        axes = F.sequence(F.lit(0), F.lit(settings.box_axes - 1))
        edges = below.select("parent", "dims", F.explode(axes).alias("axis"), "low", "high")
        edges = edges.where(F.col("axis") < F.size("low"))
        spans = edges.groupBy("parent", "dims", "axis").agg(
            F.min(F.element_at("low", F.col("axis") + 1)).alias("l"), F.max(F.element_at("high", F.col("axis") + 1)).alias("h")
        )
        whole = spans.groupBy("parent", "dims").agg(F.array_sort(F.collect_list(F.struct("axis", "l", "h"))).alias("s"))
        level = whole.select(
            F.col("parent").alias("block"),
            F.floor(F.col("parent") / settings.fan_out).cast("long").alias("parent"),
            "dims",
            F.col("s.l").alias("low"),
            F.col("s.h").alias("high"),
        )
        levels.append(landed(level, "vector-intervals"))
        if width == 1:
            break
        width = -(-width // settings.fan_out)
    top = levels[-1].select("block", "dims")
    pairs = top.select(F.col("block").alias("a"), F.col("block").alias("b"), "dims")
    for level in reversed(levels[:-1]):
        left = level.select("dims", *(F.col(c).alias(f"{c}_a") for c in ("block", "parent", "low", "high")))
        right = level.select("dims", *(F.col(c).alias(f"{c}_b") for c in ("block", "parent", "low", "high")))
        pairs = (
            pairs.join(left.withColumnRenamed("parent_a", "a"), ["dims", "a"])
            .join(right.withColumnRenamed("parent_b", "b"), ["dims", "b"])
            .where(_near(settings) & (F.col("block_a") <= F.col("block_b")))
            .select(F.col("block_a").alias("a"), F.col("block_b").alias("b"), "dims")
        )
        pairs = landed(pairs, "vector-pairs")
    return pairs.select("a", "b")


# ---- inside a block pair ---------------------------------------------------------------------


#: So many rows of a leaf are multiplied at once: small enough that no product is spread over threads.
_ROWS = 32


class Side:
    """A block made ready: leading axes by leaf, and boxes of leaves, pairs of them, and so on."""

    def __init__(self, rows: np.ndarray, turn: Turn, settings: Settings) -> None:
        leaf = settings.leaf
        many, each = -(-len(rows) // leaf), _ROWS if leaf % _ROWS == 0 else leaf
        made = []
        for k in range(0, len(rows), 16 * leaf):  # few rows at a time in double precision
            turned = turn(_unit(rows[k : k + 16 * leaf]))
            cuts = np.arange(0, len(turned), leaf)
            made.append((_led(turned, turn.lead), np.minimum.reduceat(turned, cuts), np.maximum.reduceat(turned, cuts)))
        self.rows = rows
        self.lead = np.zeros((many, leaf // each, each, made[0][0].shape[1]), np.float32)
        np.concatenate([m[0] for m in made], out=self.lead.reshape(many * leaf, -1)[: len(rows)])
        self.boxes = [tuple(np.concatenate([m[k] for m in made]) for k in (1, 2))]
        while len(low := self.boxes[-1][0]) > 1:
            cuts = np.arange(0, len(low), 2)
            self.boxes.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(self.boxes[-1][1], cuts)))


def _near_leaves(left: Side, right: Side, same: bool, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves whose boxes are within epsilon, by halving both sides level by level."""
    at_a, at_b = len(left.boxes) - 1, len(right.boxes) - 1
    i = j = np.zeros(1, np.int64)
    while True:
        (low_a, high_a), (low_b, high_b) = left.boxes[at_a], right.boxes[at_b]
        kept = [np.zeros(0, bool)]
        for k in range(0, len(i), 4096):
            m, n = i[k : k + 4096], j[k : k + 4096]
            gap = np.maximum(0.0, np.maximum(low_a[m] - high_b[n], low_b[n] - high_a[m]))
            kept.append((gap * gap).sum(axis=1) <= settings.epsilon**2)
        kept = np.concatenate(kept)
        i, j = i[kept], j[kept]
        if not at_a and not at_b or not len(i):
            order = np.lexsort((j, i))
            return i[order], j[order]
        halves = [(x, y) for x in ((0, 1) if at_a else (0,)) for y in ((0, 1) if at_b else (0,))]
        i, j = ((1 + bool(at)) * k for at, k in ((at_a, i), (at_b, j)))
        i, j = np.concatenate([i + x for x, _ in halves]), np.concatenate([j + y for _, y in halves])
        at_a, at_b = max(0, at_a - 1), max(0, at_b - 1)
        there = (i < len(left.boxes[at_a][0])) & (j < len(right.boxes[at_b][0]))
        if same:
            there &= i <= j
        i, j = i[there], j[there]


def join_blocks(
    left: Side | np.ndarray, right: Side | np.ndarray, same: bool, settings: Settings, turn: Turn = Turn(np.eye(0), 1 << 30)
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links as (rows of left, rows of right), from near leaves, found by recursive halving.

    Products of leading axes in single precision come first, as upper bounds that allow for rounding;
    what they let through is decided in double precision. ``same``: both are one block; then pairs
    are given once, below the diagonal never.
    """
    left, right = (s if isinstance(s, Side) else Side(s, turn, settings) for s in (left, right))
    leaf = settings.leaf
    _, parts, each, width = left.lead.shape
    least = np.float32(settings.cosine - (width + 8) * 1.2e-7)
    space, over = np.empty(leaf * leaf * settings.strip, np.float32), np.empty(leaf * leaf * settings.strip, bool)
    columns = np.ascontiguousarray(right.lead.reshape(-1, leaf, width).transpose(0, 2, 1))
    near_a, near_b = _near_leaves(left, right, same, settings)
    new = np.flatnonzero((np.diff(near_a, prepend=-1) != 0) | (np.diff(near_b, prepend=-1) != 1))
    for first, last in zip(new, np.append(new[1:], len(near_a))):
        for k in range(first, last, settings.strip):
            i, j, many = near_a[k], near_b[k], min(settings.strip, last - k)
            shape, size = (parts, many, each, leaf), leaf * leaf * many
            product, mask = space[:size].reshape(shape), over[:size]
            np.matmul(left.lead[i][:, None], columns[j : j + many], out=product)
            np.greater_equal(space[:size], least, out=mask)
            hits = np.flatnonzero(mask)
            if not len(hits):
                continue
            a, c = i * leaf, j * leaf
            b, d = min(a + leaf, len(left.rows)), min(c + many * leaf, len(right.rows))
            if len(hits) * 16 > size:
                rows, others = np.nonzero(_unit(left.rows[a:b]) @ _unit(right.rows[c:d]).T >= settings.cosine)
                rows, others = rows + a, others + c
            else:
                part, next_to, row, other = np.unravel_index(hits, shape)
                rows, others = a + part * each + row, c + next_to * leaf + other
                there = (rows < b) & (others < d)
                rows, others = rows[there], others[there]
                cosines = np.einsum("ij,ij->i", _unit(left.rows[rows]), _unit(right.rows[others]))
                linked = cosines >= settings.cosine
                rows, others = rows[linked], others[linked]
            if same:
                rows, others = rows[rows < others], others[rows < others]
            if len(rows):
                yield rows, others


def _unite(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (node: a node of its component, never a larger one) with the edges (u, v) added."""
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


_LINKED = "class_id long, links long, root long"
_AT_ONCE = 1 << 19


def _linked(settings: Settings, turn: Turn, kind: str):
    """For each block pair, of each vector with links: their number, and the smallest id that it reaches."""
    dtype = np.dtype(kind)

    def links(left: Side, right: Side, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        waiting, held = [], 0
        for found in join_blocks(left, right, same, settings):
            waiting.append(found)
            held += len(found[0])
            if held >= _AT_ONCE:
                yield tuple(np.concatenate(x) for x in zip(*waiting))
                waiting, held = [], 0
        if waiting:
            yield tuple(np.concatenate(x) for x in zip(*waiting))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[int, Side | None] = (-1, None)
        for batch in batches:
            for k in range(batch.num_rows):
                a, b, width = (batch.column(c)[k].as_py() for c in ("a", "b", "dims"))

                def read(name: str, of: np.dtype) -> np.ndarray:
                    return np.frombuffer(batch.column(name)[k].as_buffer(), of)

                def side(s: str) -> Side:
                    return Side(read(f"vectors_{s}", dtype).reshape(-1, width), turn, settings)

                if kept[0] != a:
                    kept = (-1, None)
                    kept = (a, side("a"))
                left = kept[1]
                same = a == b
                right = left if same else side("b")
                ids, sizes = (np.concatenate([read(f"{c}_{s}", np.int64) for s in ("a", "b")[: 2 - same]]) for c in ("ids", "sizes"))
                start = 0 if same else len(left.rows)
                count, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
                for u, v in links(left, right, same):
                    v = v + start
                    for x, y in ((u, v), (v, u)):
                        count += np.bincount(x, weights=sizes[y], minlength=len(ids)).astype(np.int64)
                    label = _unite(label, u, v)
                hit = count > 0
                if hit.any():
                    root = np.full(len(ids), np.iinfo(np.int64).max)
                    np.minimum.at(root, label, ids)
                    columns = (ids[hit], count[hit], root[label[hit]])
                    yield pa.record_batch([pa.array(c) for c in columns], ["class_id", "links", "root"])

    return rows


# ---- over tables -----------------------------------------------------------------------------


@contextmanager
def _batches_of_one(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile sends rows to Python one by one: a block pair is large enough."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def near_vectors(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``table (vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    Vectors link at a cosine of at least ``settings.cosine``, in double precision; ``n_links`` counts
    the other vectors a vector links with, ``component_id`` is the smallest id reachable. A vector
    that is NULL, empty, zero or has NULL or non-finite entries links with nothing, and so do
    vectors of different length with each other. Rows that repeat id and vector are one vector. A
    row without id is not compared: it has no links, no component, and is kept. Other columns are
    not read.
    """
    given = table.schema["embedding"].dataType
    single = isinstance(given, ArrayType) and given.elementType == FloatType()
    v = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    kind = "<f4" if single else "<f8"
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    compared = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    by_length = compared.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    common = by_length.orderBy(F.desc("n"), "d").limit(1).collect()
    turn = Turn(np.eye(0), 1 << 30)
    if common:
        # at most `sample` vectors reach the driver
        share = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, common[0].n // settings.sample))) == 0
        some = compared.where((F.size("v") == common[0].d) & share).limit(settings.sample).select("v").collect()
        sample = np.array([r.v for r in some], np.float64).reshape(len(some), common[0].d)
        sample = sample[np.isfinite(sample).all(axis=1) & (sample != 0).any(axis=1)]
        if len(sample):
            turn = _turn(sample, settings)
    axes = turn.axes
    keys = landed(_keyed(rows, axes, settings), "vector-keys")
    good = keys.where(F.col("place").isNotNull()).distinct()
    classes = good.groupBy("place").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("size"))
    classes = landed(classes.select("class_id", "size", "place"), "vector-classes")
    count = classes.count()
    wide = max(1, len(axes)) * np.dtype(kind).itemsize
    per = max(settings.block, min(count // settings.cut, settings.block_bytes // wide))
    partitions = max(1, -(-count // (4 * per)))
    blocks = landed(_blocks(rows, classes, axes, settings, kind, per, partitions), "vector-blocks")
    boxes = blocks.select("block", "parent", "dims", "low", "high")
    parents = boxes.agg(F.coalesce(F.max("parent"), F.lit(0))).first()[0] + 1
    pairs = block_pairs(boxes, settings, parents)
    # A pair is met by reading both its blocks where they lie: no block is shuffled or sent around.
    partners = pairs.groupBy("a").agg(F.collect_list("b").alias("partners"))
    # A task holds the blocks on its right, some 16 of a large table, and lets those on its left pass.
    held = max(min(partitions, 16), -(-partitions // 4))
    content = blocks.select("block", "dims", "ids", "sizes", "vectors")
    left = content.coalesce(min(held, 128)).select(F.col("block").alias("a"), "dims", *(F.col(c).alias(f"{c}_a") for c in ("ids", "sizes", "vectors")))
    right = content.coalesce(held).select(F.col("block").alias("b"), *(F.col(c).alias(f"{c}_b") for c in ("ids", "sizes", "vectors")))
    both = left.join(F.broadcast(partners), "a").join(right.hint("shuffle_replicate_nl"), F.array_contains("partners", F.col("b")))
    both = both.select("a", "b", "dims", "ids_a", "sizes_a", "vectors_a", "ids_b", "sizes_b", "vectors_b")
    with _batches_of_one(table.sparkSession):
        found = landed(both.mapInArrow(_linked(settings, turn, kind), _LINKED), "vector-links")
    groups = components(found.select("class_id", "root")).toDF("class_id", "component_id")
    sums = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    # a class of one row without links is answered as rows without a place are
    answer = classes.join(sums, "class_id", "left").join(groups, "class_id", "left")
    answer = answer.where((F.col("size") > 1) | F.col("links").isNotNull()).select(
        "place",
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "class_id").alias("component_id"),
    )
    out = keys.join(answer, "place", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
