"""Exact top-k inner products by block-at-a-time pruning.

Candidates form blocks of rows in the order of their ids. A block has a forward index, its vectors as one matrix, and
each term's (component's) largest and smallest value. A query's bound for a block is the sum over its terms of the
weight times the largest value, or the smallest where the weight is negative. A query takes blocks by falling bound and
stops where the bound is below its k-th score.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import written

#: Rows of a block, queries of a chunk, and blocks that one task takes at a time.
ROWS, QUERIES, BLOCKS = 128, 4096, 64


def as_terms(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null for vectors that are null or hold a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    size = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < size[:, None]] = np.asarray(column.flatten(), np.int64)
    return out


def _pack(rows: int):
    """Rows of one partition in chunks: ids, width and the matrix (int32 where it fits), of one row each."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(t: pa.Table) -> pa.RecordBatch:
            terms = t.column("terms").combine_chunks()
            width = int(np.diff(np.asarray(terms.offsets)).max(initial=0))
            m = _matrix(terms, width)
            small = not m.size or np.abs(m).max() < 2**31
            data = m.astype(np.int32 if small else np.int64).tobytes()
            ids = t.column("vec_id").combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([width], pa.int32()), pa.array([small]), pa.array([data], pa.binary())], ["ids", "width", "small", "data"])

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - n)
                held.append(part)
                n, at = n + part.num_rows, at + part.num_rows
                if n == rows:
                    yield close(pa.Table.from_batches(held))
                    held, n = [], 0
        if held and n:
            yield close(pa.Table.from_batches(held))

    return over


_PACKED = "ids array<bigint>, width int, small boolean, data binary"


def _unpack(t: pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array(t.column("ids")[i].as_py(), np.int64)
    m = np.frombuffer(t.column("data")[i].as_py(), np.int32 if t.column("small")[i].as_py() else np.int64)
    return ids, m.reshape(len(ids), t.column("width")[i].as_py()).astype(np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; through floats where no sum can leave what they hold exactly."""
    k = min(a.shape[1], b.shape[1])
    a, b = a[:, :k], b[:, :k]
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, k)
    if largest < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return np.einsum("ij,kj->ik", a, b)


def _bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    return _product(np.maximum(q, 0), top) + _product(np.minimum(q, 0), low)


def best(query_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each query's k best of the blocks: ids, scores, how many of them there are, and how many blocks were scored in all."""
    n, width = len(q), max([q.shape[1], *(m.shape[1] for _, m in blocks)])
    q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    blocks = [(i, np.pad(m, ((0, 0), (0, width - m.shape[1])))) for i, m in blocks]
    bound = _bounds(q, np.stack([m.max(0) for _, m in blocks]), np.stack([m.min(0) for _, m in blocks]))
    order = np.argsort(-bound, axis=1, kind="stable")
    lowest = np.iinfo(np.int64).min
    ids, scores = np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), lowest)
    active, scored = np.arange(n), 0
    for turn in range(len(blocks)):
        block = order[active, turn]
        # at a bound equal to the k-th score a smaller id may still win
        going = bound[active, block] >= scores[active, -1]
        active, block = active[going], block[going]
        for b in np.unique(block):
            rows = active[block == b]
            own, m = blocks[b]
            s = _product(q[rows], m)
            s = np.where(own == query_ids[rows][:, None], lowest, s)
            all_ids, all_scores = np.concatenate([ids[rows], np.broadcast_to(own, s.shape)], 1), np.concatenate([scores[rows], s], 1)
            first = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]  # ~ falls as scores rise, and can't overflow
            ids[rows], scores[rows] = np.take_along_axis(all_ids, first, 1), np.take_along_axis(all_scores, first, 1)
            scored += len(rows)
    return ids, scores, (scores > lowest).sum(1), scored


def _search(k: int):
    def over(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and blocks.num_rows:
            candidates = [_unpack(blocks, i) for i in range(blocks.num_rows)]
            for i in range(queries.num_rows):
                query_ids, q = _unpack(queries, i)
                ids, scores, n, _ = best(query_ids, q, candidates, k)
                held = np.arange(k) < n[:, None]
                tag = np.broadcast_to(np.arange(len(q))[:, None], held.shape)[held]
                chunk = pa.array(np.full(len(tag), queries.column("chunk")[i].as_py(), np.int64))
                out.append(pa.table([chunk, pa.array(tag), pa.array(query_ids[tag]), pa.array(ids[held]), pa.array(scores[held])], _FOUND))
        return pa.concat_tables(out) if out else pa.table([pa.array([], pa.int64())] * 5, _FOUND)

    return over


_FOUND = ["chunk", "nth", "query_id", "vec_id", "score"]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with all other rows, ties to smaller ids.

    Query chunks and groups of blocks meet pair by pair, each pair of bounded size in a task of its own, and every pair
    hands on k rows a query. ``is_query`` is over the columns of ``vectors``.

    Rows whose vector is null or holds a null or non-finite component, or whose id is null, take no part. A shorter
    vector counts as filled up with zeros. Rows with the query's own id are no candidates for it. Repeated rows are
    candidates each; a repeated query is asked once, and ids with several vectors once for each. Products must fit 64
    bits. An empty table gives an empty result; further columns are ignored.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), as_terms(F.col(vector_col), scale).alias("terms"), is_query.alias("asks")).where("terms is not null")
    ranged = rows.select("vec_id", "terms").repartitionByRange("vec_id", F.xxhash64("terms")).sortWithinPartitions("vec_id", "terms")
    blocks, _ = written(ranged.mapInArrow(_pack(ROWS), _PACKED), "blocks")
    asked = rows.where("asks").select("vec_id", "terms").distinct()
    chunks, _ = written(asked.mapInArrow(_pack(QUERIES), _PACKED), "queries")
    groups, sets = max(1, -(-blocks.count() // BLOCKS)), max(1, chunks.count())
    # groups and sets go by hashes of their contents, so they don't change if a task runs again
    code = F.xxhash64("ids", "data")
    left = chunks.select(code.alias("chunk"), F.pmod(code, F.lit(sets)).alias("qset"), "ids", "width", "small", "data")
    left = left.withColumn("bset", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    # every pair of a set of queries and a group of blocks, both of bounded size: a stated query set against all rows
    right = blocks.select(F.pmod(code, F.lit(groups)).alias("bset"), "ids", "width", "small", "data")
    right = right.withColumn("qset", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sets - 1).cast("long"))))
    found = left.groupBy("bset", "qset").cogroup(right.groupBy("bset", "qset")).applyInArrow(_search(k), "chunk long, nth long, query_id long, vec_id long, score long")
    order = Window.partitionBy("chunk", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
