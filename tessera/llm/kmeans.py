"""Centroid clustering of whole-number vectors, exact at every magnitude.

Vectors are packed once into blocks of whole numbers in the shared folder. A round expands |x|^2 - 2x.c + |c|^2 by one
float64 product of matrices a block: where all components are small enough for every sum to stay below 2^53, floats hold
these whole numbers exactly. Rows or centroids with larger components are measured in integers instead. treeAggregate
adds up counts and sums by cluster; only k centroids ever reach the driver.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import written

#: Vectors of a block.
ROWS = 4096
_BLOCK = "kind string, data binary"


def takes_part(vector: Column, dim: int) -> Column:
    """Whether a vector has exactly ``dim`` components, none of them null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & fine, F.lit(False))


def _floor(x: float, scale: int) -> int:
    """floor(scale * x); from 2^53 on x is whole itself, so the product can't overflow."""
    return scale * int(x) if abs(x) >= 2.0**53 else math.floor(scale * x)


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python's integers where a component reaches 2^52."""
    if not x.size or np.abs(x).max() * scale < 2.0**52:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[_floor(v, scale) for v in row] for row in x.tolist()], object)


def limit(dim: int) -> int:
    """The largest component for which squared distances, and all that is added up on the way, stay below 2^53."""
    return math.isqrt((2**53 - 1) // max(dim, 1)) // 2


def largest(x: np.ndarray) -> np.ndarray:
    """Of each row, the magnitude of its largest component."""
    return np.abs(x).max(1) if x.shape[1] else np.zeros(len(x), x.dtype)


def _in_integers(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one centroid in integers, of 64 bits where these suffice."""
    top = int(largest(x).max(initial=0)) + int(np.abs(c).max(initial=0))
    kind = np.int64 if top * top * x.shape[1] < 2**63 else object
    apart = x.astype(kind) - c.astype(kind)
    return (apart * apart).sum(1)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number) and the squared distance, in whole numbers."""
    most = limit(x.shape[1])
    rows, cents = largest(x) <= most, largest(c) <= most
    which, far = np.zeros(len(x), np.int64), np.full(len(x), -1, object)
    if rows.any() and cents.any():
        a, b = x[rows].astype(np.float64), c[cents].astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        best = d.argmin(1)
        which[rows], far[rows] = np.flatnonzero(cents)[best], d[np.arange(len(d)), best].astype(np.int64)
    for j in range(len(c)):
        todo = np.flatnonzero(~rows) if cents[j] else np.arange(len(x))
        if len(todo):
            d = _in_integers(x[todo], c[j])
            old = far[todo]
            better = np.array([o < 0 or n < o or (n == o and j < w) for n, o, w in zip(d, old, which[todo], strict=True)], bool)
            which[todo[better]], far[todo[better]] = j, d[better].astype(object)
    return which, far


def _sums(x: np.ndarray, which: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sums of components by cluster, as Python's integers."""
    count, total = np.bincount(which, minlength=k).astype(object), np.zeros((k, x.shape[1]), object)
    for j in np.flatnonzero(count):
        part = x[which == j]
        small = part.dtype != object and int(np.abs(part).max(initial=0)) * len(part) < 2**63
        total[j] = (part if small else part.astype(object)).sum(0).astype(object)
    return count, total


def _packed(data: np.ndarray) -> tuple[str, bytes]:
    if data.dtype == object:
        return "digits", ",".join(map(str, data.ravel().tolist())).encode()
    kind = "int32" if np.abs(data).max(initial=0) < 2**31 else "int64"
    return kind, data.astype(kind).tobytes()


def _unpacked(kind: str, data: bytes, dim: int) -> np.ndarray:
    if kind == "digits":
        return np.array(list(map(int, bytes(data).decode().split(","))), object).reshape(-1, dim)
    return np.frombuffer(data, kind).reshape(-1, dim).astype(np.int64)


def _pack(dim: int, scale: int):
    """Blocks of ids and whole-number vectors; rows with components from 2^52 on are kept apart."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = np.asarray(batch.column("vec").flatten(), np.float64).reshape(-1, dim)
                huge = largest(x) * scale >= 2.0**52
                for mask in (~huge, huge):
                    if mask.any():
                        kind, data = _packed(quantised(x[mask], scale))
                        ids = batch.column("id").filter(pa.array(mask))
                        ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                        yield pa.RecordBatch.from_arrays([ids, pa.array([kind]), pa.array([data], pa.binary())], ["ids", "kind", "data"])

    return over


@dataclass
class Clustering:
    """Centroids with, for each, the rows and the summed squared distances after the last assignment."""

    centroids: np.ndarray
    count: list[int]
    inertia: list[int]


def _round(blocks: DataFrame, c: np.ndarray, measure: bool) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums by cluster: of components, or (measure) of squared distances."""
    k, dim = c.shape
    shared = blocks.sparkSession.sparkContext.broadcast(c)

    def add(acc, block):
        x = _unpacked(block.kind, block.data, dim)
        which, far = nearest(x, shared.value)
        count, total = _sums(far[:, None] if measure else x, which, k)
        return acc[0] + count, acc[1] + total

    zero = np.zeros(k, object), np.zeros((k, 1 if measure else dim), object)
    return blocks.select("kind", "data").rdd.treeAggregate(zero, add, lambda a, b: (a[0] + b[0], a[1] + b[1]), 2)


def _seeds(rows: DataFrame, k: int, dim: int, scale: int, salt: str) -> np.ndarray:
    """The k rows with the smallest hash of their id (not null), as whole numbers; equal ids go by their vectors."""
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.where(F.col("id").isNotNull()).select(order.alias("h"), "vec").orderBy("h", "vec").limit(k).collect()
    x = np.array([r.vec for r in sorted(first, key=lambda r: (r.h, r.vec))], np.float64).reshape(-1, dim)
    q = quantised(x, scale)
    return q if q.dtype != object and q.size == 0 or largest(x).max(initial=0) * scale >= 2.0**52 else q.astype(np.int64)


def lloyd(blocks: DataFrame, seeds: np.ndarray, rounds: int) -> Clustering:
    """``rounds`` of assigning all rows and moving every non-empty centroid to the floor of its rows' mean, then one more assignment."""
    c = seeds
    for _ in range(rounds if len(seeds) else 0):
        count, total = _round(blocks, c, False)
        moved = [[s // int(n) for s in sums] if n else row for n, sums, row in zip(count.tolist(), total.tolist(), c.tolist(), strict=True)]
        c = np.array(moved, object)
        if max((abs(v) for row in moved for v in row), default=0) < 2**62:
            c = c.astype(np.int64)
    count, far = _round(blocks, c, True) if len(c) else (np.zeros(0, object), np.zeros((0, 1), object))
    return Clustering(c, [int(n) for n in count], [int(d) for d in far[:, 0]])


def _long(n: int) -> int | None:
    return n if n < 2**63 else None


def _assign(shared, dim: int, names: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Clustering = shared.value
        whole = _long(sum(found.inertia))
        own = [_long(n) for n in found.inertia]
        digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in found.centroids.tolist()]
        for batch in batches:
            for ids, kind, data in zip(batch.column("ids"), batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
                which, far = nearest(_unpacked(kind, data, dim), found.centroids)
                of = which.tolist()
                longs = [pa.array(v, pa.int64()) for v in ([_long(int(d)) for d in far], [own[j] for j in of], [whole] * len(of))]
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(of, pa.int32()), *longs, pa.array([digest[j] for j in of], pa.string())], names)

    return over


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Clustering]:
    """Rows with ``id_col``, cluster, distance, cluster_inertia, inertia and centroid_sha256, and the clustering itself.

    Components become floor(scale * x), x as double. Vectors that are null, have another number of components than
    ``dim``, or hold a null or non-finite component take no part. Centroids start as the rows with the smallest sha256
    of ``salt`` and the id; with fewer rows than k there are fewer. A row with a null id is clustered but starts no
    centroid. Repeated rows each come back; equal ids with unlike vectors count as rows of their own. A centroid without
    rows stays where it is. Distances of components too large for 64 bits are measured exactly, but a distance or
    inertia beyond a long comes back null. An empty table gives an empty result; further columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec")).where(takes_part(F.col("vec"), dim)).withColumn("vec", F.col("vec").cast("array<double>"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks, _ = written(rows.mapInArrow(_pack(dim, scale), f"ids array<{kind}>, {_BLOCK}"), "vector-blocks")
    found = lloyd(blocks, _seeds(rows, k, dim, scale, salt), rounds)
    names = [id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    shared = vectors.sparkSession.sparkContext.broadcast(found)
    # without a row that can start a centroid there are no clusters to name
    some = blocks if len(found.centroids) else blocks.limit(0)
    return some.mapInArrow(_assign(shared, dim, names), f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"), found
