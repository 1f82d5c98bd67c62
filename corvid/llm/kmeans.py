"""Centroid clustering in exact integers by kd-tree filtering.

Each vector becomes integers floor(scale * x). Every block of rows gets a kd-tree whose nodes hold the number of their vectors, the
integer sums and the bounding box; the trees are written once. In a round a tree is walked from its root with the centroids that can still
be nearest: a centroid goes where another one is strictly nearer to every point of the box (tested at the box's corner that favours
it most). A node with one centroid left is assigned whole, from its count and sums; a leaf with several is resolved vector by vector. All
comparisons are between integers, so ties are ties, and go to the smaller number. A partition sends a count and a sum for each centroid
and component; the driver sees centroids only.

Odd input: vectors that are null, of another length, or hold a null or a component that is not finite take no part. Components beyond
+-2^27 after scaling count as +-2^27, so that every distance fits a long; an inertia beyond a long is the largest long. Repeated rows are
vectors of their own. A null id can't be a starting centroid unless ids run out. With fewer than k vectors there are as many centroids.
Without vectors the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ship import ship
from .common import ranges, table

#: Vectors of a tree, and of a leaf at most (unless all are equal).
BLOCK, LEAF = 2048, 32
LIMIT = 1 << 27
_MAX = np.iinfo(np.int64).max


class Tree:
    """A kd-tree over the rows of points; nodes in order of level. points is put in the order of the leaves."""

    NODES = ("start", "stop", "left", "low", "high", "sums")

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        n = len(points)
        order = np.arange(n)
        start, stop, left, low, high, sums = [0], [n], [], [], [], []
        for_node = 0
        while for_node < len(start):
            s, e = start[for_node], stop[for_node]
            part = points[order[s:e]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            sums.append(part.sum(axis=0))
            widths = high[-1] - low[-1]
            axis = int(widths.argmax())
            if e - s > leaf and widths[axis]:
                half = (e - s) // 2
                order[s:e] = order[s:e][np.argpartition(part[:, axis], half)]
                left.append(len(start))
                start += [s, s + half]
                stop += [s + half, e]
            else:
                left.append(-1)
            for_node += 1
        self.order, self.points = order, points[order]
        self.start, self.stop, self.left = (np.array(x, np.int64) for x in (start, stop, left))
        self.low, self.high, self.sums = (np.array(x, np.int64) for x in (low, high, sums))

    def packed(self) -> list[bytes]:
        return [self.points.astype("<i4").tobytes(), *(getattr(self, x).astype("<i8").tobytes() for x in self.NODES)]

    @classmethod
    def unpacked(cls, parts: list[bytes], d: int) -> Tree:
        tree = cls.__new__(cls)
        tree.points = np.frombuffer(parts[0], "<i4").reshape(-1, d).astype(np.int64)
        for name, raw in zip(cls.NODES, parts[1:], strict=True):
            x = np.frombuffer(raw, "<i8")
            setattr(tree, name, x.reshape(-1, d) if name in ("low", "high", "sums") else x)
        return tree


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row for each point. Products that a double holds exactly go through the faster multiplication."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * largest * largest * points.shape[1] < 1 << 53:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def filtered(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole nodes and their centroids, then rows of the leaves that had to be resolved and their centroids."""
    k, squares = len(centroids), (centroids * centroids).sum(axis=1)
    nodes, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
    whole, whole_to, rows, rows_to = [], [], [], []
    while len(nodes):
        low, high = tree.low[nodes], tree.high[nodes]
        middle = np.where(alive, distances(low + high, 2 * centroids), _MAX).argmin(axis=1)
        apart = centroids[None] - centroids[middle][:, None]
        corner = np.where(apart > 0, high[:, None], low[:, None])
        # |z - v|^2 - |z* - v|^2 at the corner v that favours z most
        gap = squares - squares[middle][:, None] - 2 * (corner * apart).sum(axis=2)
        alive &= gap <= 0
        one = alive.sum(axis=1) == 1
        whole.append(nodes[one])
        whole_to.append(alive[one].argmax(axis=1))
        ends = ~one & (tree.left[nodes] < 0)
        if ends.any():
            sizes = tree.stop[nodes[ends]] - tree.start[nodes[ends]]
            at = ranges(tree.start[nodes[ends]], sizes)
            rows.append(at)
            rows_to.append(np.where(np.repeat(alive[ends], sizes, axis=0), distances(tree.points[at], centroids), _MAX).argmin(axis=1))
        inner = ~one & ~ends
        left = tree.left[nodes[inner]]
        nodes, alive = np.concatenate([left, left + 1]), np.concatenate([alive[inner]] * 2)
    joined = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return joined(whole), joined(whole_to), joined(rows), joined(rows_to)


def summed(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each centroid the number of its vectors and their sums."""
    nodes, to, rows, rows_to = filtered(tree, centroids)
    counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    np.add.at(counts, to, tree.stop[nodes] - tree.start[nodes])
    np.add.at(sums, to, tree.sums[nodes])
    np.add.at(counts, rows_to, 1)
    np.add.at(sums, rows_to, tree.points[rows])
    return counts, sums


def assigned(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of the tree its centroid and its distance from it."""
    nodes, to, rows, rows_to = filtered(tree, centroids)
    out = np.empty(len(tree.points), np.int64)
    sizes = tree.stop[nodes] - tree.start[nodes]
    out[ranges(tree.start[nodes], sizes)] = np.repeat(to, sizes)
    out[rows] = rows_to
    distance = np.empty(len(out), np.int64)
    for c in np.unique(out):
        mine = out == c
        distance[mine] = distances(tree.points[mine], centroids[c : c + 1])[:, 0]
    return out, distance


_PACKED = ("points", *Tree.NODES)


def _trees(batch: pa.RecordBatch, d: int) -> Iterator[Tree]:
    columns = [batch.column(c).to_pylist() for c in _PACKED]
    for parts in zip(*columns, strict=True):
        yield Tree.unpacked(list(parts), d)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, d: int = 64, scale: int = 1024, seed: str = "3:", vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of each vector after `rounds` rounds, and the centroids.

    The centroids start as the vectors with the smallest sha256 of seed + id; a centroid without vectors stays where it is.
    """
    spark = ship(vectors.sparkSession)
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).where(
        (F.size("v") == d) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    whole = kept.withColumn("v", F.transform("v", lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x * float(scale)))).cast("int")))
    first = whole.orderBy(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, d)
    kind = whole.schema["vec_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)
            for at in range(0, len(points), BLOCK):
                tree = Tree(points[at : at + BLOCK])
                ids = batch.column(0).take(pa.array(tree.order + at))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x], pa.binary()) for x in tree.packed())], names=["vec_id", *_PACKED])

    trees = table(whole.mapInArrow(build, f"vec_id array<{kind}>, " + ", ".join(f"{c} binary" for c in _PACKED)))

    def totals(c: np.ndarray):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, sums = np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64)
            for batch in batches:
                for tree in _trees(batch, d):
                    n, s = summed(tree, c)
                    counts += n
                    sums += s
            held = np.flatnonzero(counts)
            flat = (np.repeat(held, d), np.tile(np.arange(d), len(held)), np.repeat(counts[held], d), sums[held].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in flat], names=["cluster", "at", "n", "s"])

        return run

    for _ in range(rounds if len(centroids) else 0):
        parts = trees.select(*_PACKED).mapInArrow(totals(centroids), "cluster bigint, at bigint, n bigint, s bigint")
        whole_sum = lambda x: F.sum(F.col(x).cast("decimal(38,0)")).alias(x)
        centroids = centroids.copy()
        for r in parts.groupBy("cluster", "at").agg(whole_sum("n"), whole_sum("s")).collect():
            centroids[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, tree in enumerate(_trees(batch, d)):
                to, distance = assigned(tree, centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1).flatten(), pa.array(to.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return table(trees.mapInArrow(final, f"vec_id {kind}, cluster int, distance bigint")), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster()'s rows with cluster_inertia, inertia and the sha256 of the centroid's components."""
    spark = found.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    held = lambda x: min(x, int(_MAX))
    rows = [(c, held(s), held(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
