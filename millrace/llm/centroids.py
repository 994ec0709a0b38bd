"""Centroid clustering of integer vectors: exact nearest centroids through a vantage-point tree.

Components are turned into integers, so distances, sums and ties are exact and every run gives the
same clusters. Each round builds a tree over the centroids on the driver, broadcasts it (its size is
that of the centroids, a parameter), and every task searches it for a batch of vectors at a time:
each vector keeps a frontier of nodes with lower bounds, opens its nearest one first and stops when
the bound of what is left lies beyond the best distance. The radius counts as inside, so that a tie
is always seen. New centroids come from sums by cluster: tasks add up first, what is shuffled and
collected are centroids times components numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import landed

# below these, every step of a squared distance is a whole number that a double holds exactly
_EXACT = 2.0**20
_LIMB = 32
_SLACK = 1e-9  # relative; a bound that rounding made too large must not hide a tie
_LONGEST = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    """``k`` centroids of ``dims`` components bound what is broadcast; ``leaf`` of them end a branch.

    A component x is the integer floor(``scale`` * x). The first centroids are the ``k`` vectors with
    the smallest sha256 of ``seed``:id. ``batch`` vectors are searched at a time.
    """

    k: int = 8
    dims: int = 64
    rounds: int = 10
    scale: int = 1024
    seed: str = "3"
    leaf: int = 2
    batch: int = 4096


# ---- integers --------------------------------------------------------------------------------


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly: doubles while they are small enough, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * float(scale))
    if not scaled.size or np.abs(scaled).max() < _EXACT and math.log2(scale).is_integer():
        return scaled
    ratios = (x.as_integer_ratio() for x in vectors.ravel().tolist())
    return np.array([n * scale // d for n, d in ratios], object).reshape(vectors.shape)


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles, or both as Python integers where one has to be."""
    if a.dtype == b.dtype:
        return a, b
    return tuple(x if x.dtype == object else _python(x) for x in (a, b))  # type: ignore[return-value]


def _python(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).astype(object)


def centroid_array(rows: list[list[int]], dims: int) -> np.ndarray:
    found = np.array(rows, object).reshape(len(rows), dims)
    small = all(abs(x) < _EXACT for row in rows for x in row)
    return found.astype(np.float64) if small else found


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors from one point."""
    gap = vectors - point
    return (gap * gap).sum(axis=1)


# ---- the tree --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """``members`` are compared exactly: the vantage point, or all centroids of a leaf.

    ``children`` are (node, least distance, greatest distance) seen from the vantage point.
    """

    members: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...] = ()


@dataclass(frozen=True)
class Tree:
    centroids: np.ndarray
    nodes: tuple[Node, ...]


def _between(low: object, high: object) -> tuple[float, float]:
    """Least and greatest distance from squared ones; nothing is known of enormous integers."""
    return (math.sqrt(low), math.sqrt(high)) if isinstance(high, float) else (0.0, math.inf)


def grow(centroids: np.ndarray, leaf: int) -> Tree:
    """A vantage-point tree: the point furthest from the first one splits the rest at the median."""
    nodes: list[Node] = []

    def build(members: list[int]) -> int:
        place = len(nodes)
        nodes.append(Node(tuple(members)))
        if len(members) <= max(1, leaf):
            return place
        away = squared(centroids[members], centroids[members[0]])
        vantage = members[int(np.argmax(away))]
        rest = [m for m in members if m != vantage]
        far = squared(centroids[rest], centroids[vantage])
        order = sorted(range(len(rest)), key=lambda i: (far[i], rest[i]))
        half = -(-len(rest) // 2)
        children = []
        for part in (order[:half], order[half:]):
            if part:
                low, high = _between(far[part[0]], far[part[-1]])
                children.append((build(sorted(rest[i] for i in part)), low, high))
        nodes[place] = Node((vantage,), tuple(children))
        return place

    if len(centroids):
        build(list(range(len(centroids))))
    return Tree(centroids, tuple(nodes))


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of each vector (ties: the smallest) and the squared distance.

    Best-first branch and bound, for all vectors at once: in each step every vector opens the node
    of its frontier with the least bound. Python integers may be too large for a bound: with them
    nothing is skipped. The third value counts the distances worked out.
    """
    vectors, centroids = _alike(vectors, tree.centroids)
    n, bounded = len(vectors), vectors.dtype != object
    best = np.full(n, len(centroids), np.int64)
    least = np.full(n, math.inf).astype(vectors.dtype)
    frontier = np.full((n, len(tree.nodes)), math.inf)
    frontier[:, 0] = 0.0
    open_rows, tried = np.arange(n), 0
    while len(open_rows):
        bounds = frontier[open_rows]
        node = bounds.argmin(axis=1)
        bound = bounds[np.arange(len(open_rows)), node]
        reach = np.sqrt(least[open_rows]) if bounded else math.inf
        inside = np.isfinite(bound) & (bound <= reach)  # the radius itself is inside
        open_rows, node = open_rows[inside], node[inside]
        for name in np.unique(node):
            rows = open_rows[node == name]
            parent = frontier[rows, name].copy()
            frontier[rows, name] = math.inf
            here = tree.nodes[name]
            for member in here.members:
                away = squared(vectors[rows], centroids[member])
                tried += len(rows)
                closer = (away < least[rows]) | ((away == least[rows]) & (member < best[rows]))
                least[rows[closer]], best[rows[closer]] = away[closer], member
            if here.children:  # the last distance is that of the vantage point
                apart = np.sqrt(away) if bounded else 0.0
                for child, low, high in here.children:
                    gap = np.maximum(low - apart, apart - high) - _SLACK * (apart + high) if bounded else 0.0
                    frontier[rows, child] = np.maximum(parent, np.maximum(gap, 0.0))
    return best, least, tried


# ---- over tables -----------------------------------------------------------------------------


def _kept(table: DataFrame, settings: Settings) -> DataFrame:
    """``vec_id, v``: rows whose vector has the right length and only finite components."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.where((F.size("v") == settings.dims) & finite)


def _start(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The first centroids: at most ``k`` vectors, in ascending order of their hashes."""
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(name, 256), "v").limit(settings.k).select("v").collect()
    rows = whole(np.array([r.v for r in first], np.float64).reshape(len(first), settings.dims), settings.scale)
    return centroid_array([[int(x) for x in row] for row in rows.tolist()], settings.dims)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _searched(batches: Iterator[pa.RecordBatch], tree: Tree, settings: Settings):
    """(record batch, whole vectors, nearest, distances) of slices of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, settings.batch):
            part = batch.slice(at, settings.batch)
            found = whole(_matrix(part.column("v"), settings.dims), settings.scale)
            best, least, _ = nearest(tree, found)
            yield part, found, best, least


def limbs(total: int) -> list[int]:
    """Parts that fit a long and give ``total`` when the i-th is worth 2**(32 i)."""
    out = []
    while not -(2**62) <= total < 2**62:
        total, low = divmod(total, 1 << _LIMB)
        out.append(low)
    return [*out, total]


_SUMS = "cluster int, limb int, dim int, total long, size long"


def _summed(tree: Tree, settings: Settings):
    """Sums by cluster and component of a task, written out at its end: a bounded number of rows.

    ``size``, the rows of the cluster, is in the first component's first limb only.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.centroids)
        size = np.zeros(k, np.int64)
        small, large = np.zeros((k, settings.dims), np.int64), np.zeros((k, settings.dims), object)
        for _, found, best, _ in _searched(batches, tree, settings):
            size += np.bincount(best, minlength=k)
            into = large if found.dtype == object else small
            for cluster in np.unique(best):
                # whole numbers below 2**20 times a batch of rows: the sum is exact
                part = found[best == cluster].sum(axis=0)
                into[cluster] += part if found.dtype == object else part.astype(np.int64)
        out = []
        for cluster in np.flatnonzero(size).tolist():
            for dim in range(settings.dims):
                total = int(small[cluster, dim]) + int(large[cluster, dim])
                for limb, part in enumerate(limbs(total)):
                    first = dim == 0 and limb == 0
                    out.append((cluster, limb, dim, part, int(size[cluster]) if first else 0))
        if out:
            columns = list(zip(*out))
            kinds = [pa.int32()] * 3 + [pa.int64()] * 2
            names = [c.split()[0] for c in _SUMS.split(", ")]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return rows


def _moved(vectors: DataFrame, tree: Tree, settings: Settings) -> np.ndarray:
    """The centroids after one round: exact floor of the mean; a cluster without vectors stays."""
    parts = vectors.select("v").mapInArrow(_summed(tree, settings), _SUMS)
    # decimals do not overflow, however many tasks add a part near the end of a long
    sums = parts.groupBy("cluster", "limb", "dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("size").alias("size")
    )
    total: dict[tuple[int, int], int] = {}
    size: dict[int, int] = {}
    for r in sums.collect():  # centroids times components, and limbs only for enormous components
        total[r.cluster, r.dim] = total.get((r.cluster, r.dim), 0) + (int(r.total) << (_LIMB * r.limb))
        size[r.cluster] = size.get(r.cluster, 0) + r["size"]
    rows = []
    for cluster, held in enumerate(tree.centroids.tolist()):
        n = size.get(cluster, 0)
        rows.append([total[cluster, d] // n for d in range(settings.dims)] if n else [int(x) for x in held])
    return centroid_array(rows, settings.dims)


def _assigned(tree: Tree, settings: Settings):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, best, least in _searched(batches, tree, settings):
            away = pa.array([min(int(x), _LONGEST) for x in least.tolist()], pa.int64())
            columns = [part.column("vec_id"), pa.array(best, pa.int32()), away]
            yield pa.record_batch(columns, ["vec_id", "cluster", "distance"])

    return rows


def cluster(table: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of the kept rows of ``table (vec_id, embedding)``, and the centroids.

    Kept are rows whose vector has exactly ``dims`` components, none NULL or non-finite; the others are
    left out. Equally near centroids: the smaller number. Rows that repeat an id, or have none, are
    clustered like any other (without id the hash is that of ``seed:``). With fewer than ``k`` kept
    rows there are as many centroids; an empty table gives none. A squared distance beyond a long is
    reported as the greatest long; it is compared exactly nevertheless. Other columns are not read.
    """
    vectors = landed(_kept(table, settings), "centroid-vectors")
    centroids = _start(vectors, settings)
    share = vectors.sparkSession.sparkContext.broadcast
    for _ in range(settings.rounds if len(centroids) else 0):
        centroids = _moved(vectors, _Sent(share(grow(centroids, settings.leaf))), settings)
    tree = _Sent(share(grow(centroids, settings.leaf)))
    return vectors.mapInArrow(_assigned(tree, settings), "vec_id long, cluster int, distance long"), centroids


class _Sent:
    """A broadcast tree, looked up where it is used."""

    def __init__(self, sent) -> None:
        self._sent = sent

    @property
    def centroids(self) -> np.ndarray:
        return self._sent.value.centroids

    @property
    def nodes(self) -> tuple[Node, ...]:
        return self._sent.value.nodes


def centroid_digests(centroids: np.ndarray) -> list[str]:
    """sha256 of each centroid's components as decimal integers joined by commas."""
    texts = [",".join(str(int(x)) for x in row) for row in centroids.tolist()]
    return [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the distance summed over the cluster and over all, and the centroid's digest.

    A sum beyond a long is the greatest long.
    """
    spark = assigned.sparkSession
    held = landed(assigned, "centroid-clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    found = {r.cluster: int(r.total) for r in held.groupBy("cluster").agg(exact.alias("total")).collect()}
    everything = sum(found.values())
    digests = centroid_digests(centroids)
    rows = [(c, min(t, _LONGEST), min(everything, _LONGEST), digests[c]) for c, t in found.items()]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # one row for each centroid, at most k
    small = F.broadcast(spark.createDataFrame(rows, schema))
    columns: list[Column | str] = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return held.join(small, "cluster").select(*columns)
