"""Exact top-k inner products by KD-trees per shard."""

from __future__ import annotations

import functools
import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tripspot.session import Scratch

SHARD_ROWS = 16_384
LEAF_ROWS = 256
QUERY_BLOCK = 2_048
SAMPLE_ROWS = 2_048
FOUND = "query_id long, vec_id long, score long"
LOWEST = -(1 << 63)


class Tree(NamedTuple):
    """Rows ordered by leaf; per node a tight box, its range of rows and its children (-1: leaf)."""

    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    begin: list
    end: list
    left: list
    right: list


def build(ids: np.ndarray, rows: np.ndarray, leaf_rows=LEAF_ROWS) -> Tree:
    """Median splits along the widest side of each node's box, down to leaves of `leaf_rows` rows at most."""
    order, low, high, begin, end, left, right = np.arange(len(ids)), [], [], [], [], [], []

    def node(b, e):
        part = rows[order[b:e]]
        low.append(part.min(axis=0))
        high.append(part.max(axis=0))
        begin.append(b), end.append(e), left.append(-1), right.append(-1)
        return len(begin) - 1

    todo = [node(0, len(ids))] if len(ids) else []
    while todo:
        k = todo.pop()
        b, e = begin[k], end[k]
        side = high[k] - low[k]
        axis = int(side.argmax())
        if e - b <= leaf_rows or not side[axis]:
            continue
        middle = (e - b) // 2
        order[b:e] = order[b:e][np.argpartition(rows[order[b:e], axis], middle)]
        left[k], right[k] = node(b, b + middle), node(b + middle, e)
        todo += [left[k], right[k]]
    shape = (len(begin), rows.shape[1])
    return Tree(ids[order], rows[order], np.array(low).reshape(shape), np.array(high).reshape(shape), begin, end, left, right)


def search(tree: Tree, query_id: int, query: np.ndarray, best: list, k: int, bound: int) -> None:
    """Best-first walk: improves the heap `best` of (score, -id), never scoring a box that cannot reach the kth score.

    `bound` is a kth score known from elsewhere. A box's bound is the largest inner product any point in it could
    have. Equal to the kth score is still scored, as a smaller id would win.
    """
    if not tree.begin:
        return
    # Bounds of all boxes at once; the walk then takes them as it reaches their nodes.
    plus, minus = np.maximum(query, 0), np.minimum(query, 0)
    bounds = tree.high @ plus + tree.low @ minus
    queue = [(-bounds[0], 0)]
    while queue:
        top, node = heapq.heappop(queue)
        kth = max(bound, best[0][0]) if len(best) == k else bound
        if -top < kth:
            return
        if tree.left[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                if bounds[child] >= kth:
                    heapq.heappush(queue, (-bounds[child], child))
            continue
        b, e = tree.begin[node], tree.end[node]
        scores = tree.rows[b:e] @ query
        for i in np.flatnonzero(scores >= kth):
            other, score = int(tree.ids[b + i]), int(scores[i])
            if other == query_id or score < bound:
                continue
            if len(best) < k:
                heapq.heappush(best, (score, -other))
            elif (score, -other) > best[0]:
                heapq.heapreplace(best, (score, -other))


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and integer rows by dimension. Lists that are null, empty or hold a null or non-finite value are out."""
    out = {}
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()])
    for size in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == size)
        values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
        good = np.isfinite(values).all(axis=1)  # a null is not a number here
        out[int(size)] = (at[good], np.floor(1024 * values[good]).astype(np.int64))
    return out


def _exact(queries: np.ndarray, rows: np.ndarray):
    """Whole-number products in doubles where they cannot round, else in 64-bit integers."""
    size = rows.shape[1] * float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    return np.float64 if size < 2**53 else np.int64


def _search(batches, queries, k: int, shard_rows: int):
    """queries: {dimension: (ids, integer vectors, bounds)}. Shards of one task share each query's heap, so a kth score
    found in one prunes the next."""
    heaps = {d: [[] for _ in ids] for d, (ids, _, _) in queries.items()}
    held = {d: ([], []) for d in queries}

    def run(d):
        ids, rows = (np.concatenate(x) for x in held[d])
        held[d][0].clear(), held[d][1].clear()
        for b in range(0, len(ids), shard_rows):
            part = rows[b : b + shard_rows]
            kind = _exact(queries[d][1], part)
            tree = build(ids[b : b + shard_rows], part.astype(kind))
            for query_id, query, bound, best in zip(*queries[d], heaps[d]):
                search(tree, int(query_id), query.astype(kind), best, k, int(bound))

    for batch in batches:
        for d, (at, rows) in _matrix(batch.column("vector")).items():
            if d in held:
                ids = batch.column("id").take(pa.array(at))
                known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
                held[d][0].append(ids.take(pa.array(known)).to_numpy())
                held[d][1].append(rows[known])
                if sum(map(len, held[d][0])) >= shard_rows:
                    run(d)
    for d in queries:
        if held[d][0]:
            run(d)
    for d, (ids, _, _) in queries.items():
        found = [(int(q), -o, s) for q, best in zip(ids, heaps[d]) for s, o in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"]
        )


def _bounds(ids: np.ndarray, queries: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """For each query the kth score among a few rows: the whole table's kth score is no lower."""
    if len(sample_ids) <= k:
        return np.full(len(ids), LOWEST, np.int64)
    kind = _exact(queries, sample)
    scores = (queries.astype(kind) @ sample.astype(kind).T).astype(np.int64)
    scores[ids[:, None] == sample_ids[None, :]] = LOWEST
    return np.partition(scores, len(sample_ids) - k, axis=1)[:, len(sample_ids) - k]


def _table(rows) -> tuple[np.ndarray, pa.Array]:
    return np.array([r["id"] for r in rows], np.int64), pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))


def top_products(
    vectors: DataFrame, queries: DataFrame, scratch: Scratch, k=10, id_col="vec_id", vector_col="embedding",
    block=QUERY_BLOCK, shard_rows=SHARD_ROWS, sample_rows=SAMPLE_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k rows of `vectors` with the highest inner product of
    floor(1024 * x), ties to the smaller id. Exact: trees only leave out what cannot be among them.

    Queries go out in blocks of about `block`; for each block one job passes over the table where it lies, without a
    shuffle. A task cuts its rows into shards of `shard_rows`, builds a KD-tree of each and walks it best first for
    each query; the kth score is carried from shard to shard, and begins with the kth score among `sample_rows` rows.
    Each task returns at most k rows for each query, and Spark's own top-k per query joins them.

    Vectors that are null or empty, or hold a null or non-finite component, and rows with a null id take no part, as
    row or query. A query is compared with rows of its dimension only, and never with rows of its own id, so repeated
    rows of one id do not find each other, while others find each of them; equal queries count once. Too few rows give fewer ranks, none no rows.
    Scores must fit 64 bits.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).filter("id is not null")
    asked = scratch.store(asked.distinct(), "queries")
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    sample_ids, sample = _table(own.filter("id is not null").orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect())
    sample = _matrix(sample)
    found = []
    for number in range(blocks):
        ids, column = _table(asked.filter(F.col("block") == number).drop("block").collect())
        sent = {}
        for d, (at, rows) in _matrix(column).items():
            near_at, near = sample.get(d, (np.zeros(0, int), np.zeros((0, d), np.int64)))
            sent[d] = (ids[at], rows, _bounds(ids[at], rows, sample_ids[near_at], near, k))
        scan = functools.partial(_search, queries=sent, k=k, shard_rows=shard_rows)
        found.append(scratch.store(own.mapInArrow(scan, FOUND), f"block-{number}"))
    every = functools.reduce(DataFrame.unionByName, found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = every.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
