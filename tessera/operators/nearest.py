"""Exact k nearest references: packed blocks, bounds from centres and radii, and k-th distances carried through a task.

References are packed once (``index``): each goes to the nearest of a bounded number of coarse centres, and the rows of a
cell become blocks with a centre and a radius, in single precision where that holds every component exactly. Queries are
packed the same way into sets of neighbouring ones. A set takes the blocks that its bound leaves, nearest first, in one
task: what it hands on is k rows a query. Blocks within a checked size are broadcast, so a search shuffles the queries
alone; beyond it blocks are shuffled to the sets that need them.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import arrow_batches, written

#: References of a block and of a product of matrices, and coarse centres at most.
BLOCK, CHUNK, CENTRES = 1024, 8192, 2048
#: Numbers of a product of rows and centres that a Python worker holds at a time.
PRODUCT = 1 << 20
#: Queries of a set at least and at most, and queries that are scored at a time.
FEWEST, ASKS, SCORED = 512, 16_384, 256
#: Bytes of packed rows that a Python worker is handed at a time (one row may be larger), and numbers of a batch that it returns.
BATCH, RETURNED = 4 << 20, 1 << 16
#: References whose least distance stands for them where the k-th distance is looked for.
STRIDE = 32
#: Bytes of packed references that may be broadcast.
BROADCAST = 256 << 20
_NO_CODE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max


@dataclass
class Index:
    """Packed references, and by coarse cell its centre, how many it has and how far they reach."""

    blocks: DataFrame
    centres: np.ndarray
    size: np.ndarray
    reach: np.ndarray
    bytes: int


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _bytes_of(x: np.ndarray) -> list[bytes]:
    """Each row in single precision if that changes none of its components."""
    short = x.astype(np.float32)
    exact = (short == x).all(1)
    return [a.tobytes() if e else b.tobytes() for a, b, e in zip(short, x, exact, strict=True)]


def _rows_of(data: list[bytes], dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(d, np.float32 if len(d) == 4 * dim else np.float64).astype(np.float64) for d in data]) if data else np.zeros((0, dim))


def _packed(x: np.ndarray) -> bytes:
    short = x.astype(np.float32)
    return short.tobytes() if (short == x).all() else x.tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if len(data) == 4 * rows * dim else np.float64).reshape(rows, dim)


def _to_cells(shared, names: list[str]):
    """Rows with the nearest centre and the distance to it."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        c2 = (centres * centres).sum(1)
        size = max(1, min(4096, PRODUCT // len(centres)))
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                x = _matrix(batch.column("vec"))
                cell = (c2 - 2 * (x @ centres.T)).argmin(1)
                far = np.sqrt(((x - centres[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(_bytes_of(x), pa.binary()), pa.array(cell.astype(np.int32)), pa.array(far)], [*names, "vec", "cell", "far"])

    return over


def _pack(names: list[str], dim: int, most: int, by_cell: bool = False, bound=None):
    """Sorted rows in blocks of at most ``most``: number, rows, ids, labels, vectors, centre, radius, cell and reach. Of
    queries also what bounds each one's k-th distance, and a ball around those of each cell: bound, radius, centre."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def ball(x: np.ndarray) -> tuple[np.ndarray, float]:
            centre = x.mean(0)
            return centre, float(np.sqrt(((x - centre) ** 2).sum(1)).max())

        def close() -> pa.RecordBatch:
            nonlocal nth
            ids, labels, vec, cell, far = zip(*held, strict=True)
            x = _rows_of(list(vec), dim)
            centre, radius = ball(x)
            bounds, balls = b"", b""
            if bound:
                worst = bound(x)
                starts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
                for i, j in zip(starts, starts[1:], strict=False):
                    c, r = ball(x[i:j])
                    balls += np.concatenate([[worst[i:j].max(), r], c]).tobytes()
                bounds = worst.tobytes()
            values = [(task << 32) + nth, len(held), np.array(ids, np.int64).tobytes(), np.array([_NO_CODE if v is None else v for v in labels], np.int64).tobytes(), _packed(x), centre.tobytes(), radius, cell[0], max(far), bounds, balls]
            nth += 1
            held.clear()
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], _FIELDS)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*names, "vec", "cell", "far")), strict=True):
                if held and (len(held) == most or (by_cell and row[3] != held[0][3])):
                    yield close()
                held.append(row)
        if held:
            yield close()

    return over


_FIELDS = ["number", "rows", "ids", "labels", "data", "centre", "radius", "cell", "reach", "bounds", "balls"]
_PACKED = "number long, rows int, ids binary, labels binary, data binary, centre binary, radius double, cell int, reach double, bounds binary, balls binary"


def _near_order(x: np.ndarray) -> np.ndarray:
    """Rows so that near ones are close in the order: halves by the component that varies most, again and again."""
    if len(x) < 3:
        return np.arange(len(x))
    order = np.argsort(x[:, x.var(0).argmax()], kind="stable")
    left, right = order[: len(x) // 2], order[len(x) // 2 :]
    return np.concatenate([left[_near_order(x[left])], right[_near_order(x[right])]])


def index(refs: DataFrame, rows: int | None = None) -> Index:
    """Packs references (ref_id, code, vec). ``rows``: references of a block. Build it once and search it as often as needed."""
    most = rows or BLOCK
    sc = refs.sparkSession.sparkContext
    wanted = min(CENTRES, max(1, refs.count() // most))
    first = refs.select(F.xxhash64("ref_id").alias("h"), "ref_id", "vec").orderBy("h", "ref_id").limit(wanted).collect()
    if not first:
        return Index(refs.sparkSession.createDataFrame([], _PACKED), np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0)
    centres = np.array([r.vec for r in first], np.float64)
    centres = centres[_near_order(centres)]
    celled = refs.select("ref_id", "code", "vec").mapInArrow(_to_cells(sc.broadcast(centres), ["ref_id", "code"]), "ref_id long, code int, vec binary, cell int, far double")
    ranged = celled.repartitionByRange("cell", "far", "ref_id").sortWithinPartitions("cell", "far", "ref_id")
    blocks, _ = written(ranged.mapInArrow(_pack(["ref_id", "code"], centres.shape[1], most, True), _PACKED), "reference-blocks")
    size, reach, held = np.zeros(len(centres)), np.zeros(len(centres)), 0
    for r in blocks.groupBy("cell").agg(F.sum("rows").alias("n"), F.max("reach").alias("reach"), F.sum(F.length("data")).alias("bytes")).collect():
        size[r.cell], reach[r.cell], held = r.n, r.reach, held + r.bytes
    return Index(blocks, centres, size, reach, held)


def _bound(shared, k: int):
    """Of each query a distance within which it surely has k references: whole cells, the nearest farthest point first. Without ``shared`` no such distance is known."""

    def over(x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), np.inf)
        for at in range(0, len(x) if shared else 0, SCORED):
            centres, size, reach = shared.value
            q = x[at : at + SCORED]
            far = np.sqrt(np.maximum((q * q).sum(1)[:, None] - 2 * (q @ centres.T) + (centres * centres).sum(1), 0))
            far = np.where(size > 0, far * (1 + 1e-6) + 1e-6 + reach, np.inf)
            order = far.argsort(1)
            enough = np.cumsum(size[order], 1) >= k
            out[at : at + SCORED] = np.where(enough.any(1), np.take_along_axis(far, order, 1)[np.arange(len(q)), enough.argmax(1)], np.inf)
        return out

    return over


def _needed(shared, dim: int):
    """number, qset, nearest: which sets a block may hold neighbours for, and the least distance between it and one of their balls."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, bound, radius, centre = shared.value
        first = np.flatnonzero(np.concatenate([[True], sets[1:] != sets[:-1]]))
        for b in batches:
            if not b.num_rows:
                continue
            c = np.stack([np.frombuffer(x, np.float64) for x in b.column("centre").to_pylist()]).reshape(-1, dim)
            for i, own in enumerate(np.asarray(b.column("radius"))):
                apart = np.sqrt(((centre - c[i]) ** 2).sum(1))
                least = np.maximum(apart * (1 - 1e-6) - 1e-6 - own - radius, 0)
                least = np.minimum.reduceat(np.where(least <= bound, least, np.inf), first)
                hit = np.flatnonzero(np.isfinite(least))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), b.column("number")[i].as_py(), np.int64)), pa.array(sets[first[hit]]), pa.array(least[hit])], ["number", "qset", "nearest"])

    return over


class _Set:
    """One set of queries with the k nearest references so far."""

    def __init__(self, numbers: bytes, labels: bytes, data: bytes, n: int, dim: int, k: int, exclude_self: bool, bounds: bytes):
        self.rows, self.truths, self.q = np.frombuffer(numbers, np.int64), np.frombuffer(labels, np.int64), _unpacked(data, n, dim).astype(np.float64)
        self.q2, self.k, self.exclude_self = (self.q * self.q).sum(1), k, exclude_self
        self.d2, self.ids, self.codes = np.full((n, k), np.inf), np.full((n, k), _LAST), np.full((n, k), _NO_CODE)
        self.limit = np.frombuffer(bounds, np.float64) ** 2
        self.held: list[tuple] = []
        self.waiting, self.blocks, self.scored = 0, 0, 0

    def add(self, rows: int, ids: bytes, labels: bytes, data: bytes, centre: np.ndarray, radius: float) -> None:
        self.blocks += 1
        apart = np.sqrt(np.maximum(self.q2 - 2 * (self.q @ centre) + centre @ centre, 0)) * (1 - 1e-6) - 1e-6 - radius * (1 + 1e-9)
        need = np.maximum(apart, 0) ** 2 <= self.limit
        if not need.any():
            return
        self.scored += 1
        self.held.append((np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), _unpacked(data, rows, len(centre)), need))
        self.waiting += rows
        if self.waiting >= (CHUNK if np.isfinite(self.d2[:, -1]).all() else max(4 * self.k, 2 * BLOCK)):
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        ids, codes, r = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        need = np.logical_or.reduce([h[3] for h in self.held])
        self.held, self.waiting = [], 0
        r2 = np.einsum("ij,ij->i", r, r, dtype=np.float64)
        half, short, far = (r2 / 2).astype(np.float32), r.astype(np.float32, copy=False), float(np.sqrt(r2.max()))
        order = np.argsort(ids, kind="stable") if self.exclude_self else None
        todo = np.flatnonzero(need)
        for at in range(0, len(todo), SCORED):
            self._score(todo[at : at + SCORED], ids, codes, r, half, short, far, order)

    def _score(self, mine: np.ndarray, ids: np.ndarray, codes: np.ndarray, r: np.ndarray, half: np.ndarray, short: np.ndarray, far: float, order: np.ndarray | None) -> None:
        q, q2, k, width = self.q[mine], self.q2[mine], self.k, len(half)
        largest = np.finfo(np.float32).max
        rough = q.astype(np.float32) @ short.T
        np.subtract(half, rough, out=rough)  # half the squared distance, less what the query adds to all
        if order is not None:
            first, last = (np.searchsorted(ids, self.rows[mine], side, sorter=order) for side in ("left", "right"))
            for i in np.flatnonzero(last > first).tolist():
                rough[i, order[first[i] : last[i]]] = np.inf
        kth = (np.minimum(self.d2[mine, -1], self.limit[mine]) - q2) / 2
        groups = width // STRIDE
        if groups >= k or (width >= k and not np.isfinite(self.d2[mine, -1]).all()):
            # the k-th least of all is no more than that of the least of every stride
            least = rough[:, : groups * STRIDE].reshape(len(q), STRIDE, groups).min(1) if groups >= k else rough
            own = np.partition(least, k - 1, axis=1)[:, k - 1].astype(np.float64)
            kth = np.minimum(kth, np.where(np.isfinite(own), own, np.inf))
        # single precision rounds: take all within its error of that, then sum these distances exactly
        slack = (q.shape[1] + 8) * 2.0**-22 * (np.sqrt(q2) + far) ** 2
        limit = np.minimum(kth + slack, largest).astype(np.float32)
        i, j = np.divmod(np.flatnonzero(rough <= limit[:, None]), width)
        if not len(i):
            return
        d2 = np.zeros(len(i))
        x, y = q.T.copy(), r.T
        for c in range(q.shape[1]):
            d2 += (x[c][i] - y[c][j]) ** 2
        some = np.unique(i)
        old = mine[some]
        who = np.concatenate([np.repeat(some, k), i])
        all_d, all_id, all_code = (np.concatenate([a[old].ravel(), b]) for a, b in ((self.d2, d2), (self.ids, ids[j]), (self.codes, codes[j])))
        best = np.lexsort((all_id, all_d, who))
        who = who[best]
        keep = best[np.arange(len(who)) - np.searchsorted(who, who) < k]  # k rows of each are there already
        self.d2[old], self.ids[old], self.codes[old] = (a[keep].reshape(len(some), k) for a in (all_d, all_id, all_code))
        self.limit[old] = np.minimum(self.limit[old], self.d2[old, -1])

    def found(self) -> Iterator[pa.RecordBatch]:
        self.flush()
        size = max(1, RETURNED // self.k)
        for at in range(0, len(self.rows), size):
            mine = slice(at, at + size)
            held = np.isfinite(self.d2[mine])
            i, nth = np.nonzero(held)
            code, truth = self.codes[mine][held], self.truths[mine][i]
            cols = [pa.array(self.rows[mine][i]), pa.array(truth.astype(np.int32), mask=truth == _NO_CODE), pa.array(self.ids[mine][held]), pa.array(code.astype(np.int32), mask=code == _NO_CODE), pa.array(self.d2[mine][held]), pa.array((nth + 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["row_id", "truth", "ref_id", "code", "d2", "rank"])

    def work(self) -> Iterator[pa.RecordBatch]:
        self.flush()
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (len(self.rows), self.blocks, self.scored)], ["queries", "sent", "scored"])


def _search(k: int, dim: int, exclude_self: bool, result: str):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Set | None = None
        for b in batches:
            cols = {c: b.column(c) for c in ("number", "q_rows", "q_ids", "q_labels", "q_data", "q_bounds", "rows", "ids", "labels", "data", "centre", "radius")}
            for i in range(b.num_rows):
                at = lambda c, i=i, cols=cols: cols[c][i].as_py()
                if cols["number"][i].as_py() is None:
                    if now:
                        yield from getattr(now, result)()
                    now = _Set(at("q_ids"), at("q_labels"), at("q_data"), at("q_rows"), dim, k, exclude_self, at("q_bounds"))
                else:
                    now.add(at("rows"), at("ids"), at("labels"), at("data"), np.frombuffer(at("centre"), np.float64), at("radius"))
            b = cols = at = None  # what was taken is copied: the batch can go before the next one comes
        if now:
            yield from getattr(now, result)()

    return over


def _run(asks: DataFrame, refs: Index, k: int, exclude_self: bool, result: str, schema: str) -> DataFrame:
    spark = asks.sparkSession
    if not len(refs.centres):
        return spark.createDataFrame([], schema)
    dim = refs.centres.shape[1]
    sc, n = spark.sparkContext, asks.count()
    size = min(ASKS, max(FEWEST, -(-n // (2 * sc.defaultParallelism))))
    sets = max(1, -(-n // size))
    celled = asks.select("row_id", "truth", "vec").mapInArrow(_to_cells(sc.broadcast(refs.centres), ["row_id", "truth"]), "row_id long, truth int, vec binary, cell int, far double")
    ranged = celled.repartitionByRange(sets, "cell", "far", "row_id").sortWithinPartitions("cell", "far", "row_id")
    # a query's own row, however often it is there, is no neighbour of it, so cells promise nothing then
    bound = _bound(None if exclude_self else sc.broadcast((refs.centres, refs.size, refs.reach)), k)
    packs, _ = written(ranged.mapInArrow(_pack(["row_id", "truth"], dim, ASKS, bound=bound), _PACKED), "query-sets")
    about = packs.select("number", "balls").orderBy("number").collect()  # one row a set
    if not about:
        return spark.createDataFrame([], schema)
    balls = [np.frombuffer(r.balls, np.float64).reshape(-1, dim + 2) for r in about]
    every = np.concatenate(balls)
    facts = np.repeat(np.arange(len(about)), [len(b) for b in balls]), every[:, 0], every[:, 1], every[:, 2:]
    pairs = refs.blocks.select("number", "centre", "radius").mapInArrow(_needed(sc.broadcast(facts), dim), "number long, qset long, nearest double")
    blocks = refs.blocks.select("number", "rows", "ids", "labels", "data", "centre", "radius")
    turns = spark.createDataFrame([(r.number, i) for i, r in enumerate(about)], "number long, qset long")
    mine = packs.join(F.broadcast(turns), "number").select("qset", F.lit(-1.0).alias("nearest"), *(F.col(c).alias(f"q_{c}") for c in ("rows", "ids", "labels", "data", "bounds")))
    if refs.bytes <= BROADCAST:
        rows = pairs.unionByName(mine.withColumn("number", F.lit(None).cast("long")), allowMissingColumns=True).repartitionById(len(about), F.col("qset").cast("int")).join(F.broadcast(blocks), "number", "left")
    else:
        rows = pairs.join(blocks, "number").unionByName(mine, allowMissingColumns=True).repartitionById(len(about), F.col("qset").cast("int"))
    found = rows.sortWithinPartitions("qset", "nearest", "number").mapInArrow(_search(k, dim, exclude_self, result), schema)
    # written here, as the size of batches is that of the time at which a plan runs
    with arrow_batches(spark, BATCH):
        return written(found, "searched")[0]


def search(asks: DataFrame, refs: Index, k: int, exclude_self: bool = False) -> DataFrame:
    """row_id, truth, ref_id, code, d2, rank of the k nearest references of each query, ties to the smaller ref_id."""
    return _run(asks, refs, k, exclude_self, "found", "row_id long, truth int, ref_id long, code int, d2 double, rank int")


def work(asks: DataFrame, refs: Index, k: int, exclude_self: bool = False) -> DataFrame:
    """How much of the references a search takes: for each set its queries, the blocks sent to it and the blocks that it scored."""
    return _run(asks, refs, k, exclude_self, "work", "queries long, sent long, scored long")
