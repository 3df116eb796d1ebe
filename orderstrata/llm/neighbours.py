"""Nearest neighbours by inner product: a join of blocks, quantised first, then exact."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstrata.llm.common import stored

QUERIES_PER_BLOCK = 1024
# Queries whose bounds to a block of candidates are held at a time.
QUERIES_AT_ONCE = 128
ROWS_PER_BLOCK = 8192
# Candidate blocks that one task compares with a block of queries, one after another.
BLOCKS_PER_TASK = 4
# Blocks of queries that go past the same copy of candidate blocks.
ASKED_TOGETHER = 64

BLOCKS = "block long, size int, ids binary, vectors binary, codes binary, scales binary"
FOUND = "query_id long, vec_id long, score double"


def _quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components as whole numbers from -127 to 127, and each vector's step."""
    scales = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scales[:, None])
    return codes.astype(np.int8), scales


def _blocked(table: pa.Table, kind: type) -> pa.Table:
    size = table.column("size")[0].as_py()
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(-1, size)
    _, first = np.unique(np.column_stack((ids, vectors.view(np.int64))), axis=0, return_index=True)
    ids, vectors = ids[first], vectors[first]  # a repeated row counts once
    codes, scales = _quantised(vectors)
    return pa.table(
        {
            "block": table.column("block")[:1],
            "size": pa.array([size], pa.int32()),
            "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
            "codes": pa.array([codes.tobytes()], pa.binary()),
            "scales": pa.array([scales.tobytes()], pa.binary()),
        }
    )


def _block_count(rows: int, per_block: int) -> int:
    return max(1, ceil(rows / per_block))


def _blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows by the hash of their id and vector into blocks of one vector length each."""
    kind = np.float32 if dict(rows.dtypes)["vector"] == "array<float>" else np.float64

    def blocked(table: pa.Table) -> pa.Table:
        return _blocked(table, kind)

    number = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block")
    placed = rows.select("vec_id", "vector", F.size("vector").alias("size"), number)
    return placed.groupBy("size", "block").applyInArrow(blocked, BLOCKS)


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(rows))
    for a, column in zip(query, rows.T, strict=True):
        total += a * column
    return total


def _tile(queries, candidates, tops: list[list[tuple[float, int]]], k: int) -> None:
    """Brings the best of a block of candidates into each query's heap.

    For q = sq*cq + eq and x = sx*cx + ex, each error at most half a step per
    component, the product differs from sq*sx*(cq.cx) by no more than
    sq/2 * |x|1 + sx/2 * |q|1 + size * sq*sx/4. A row whose upper bound is below the
    k-th best lower bound, or below the k-th best found so far, can't be among the k.
    """
    q_ids, q_vectors, q_codes, q_scales = queries
    ids, vectors, codes, scales = candidates
    # whole numbers of up to size * 127 * 127 are exact in single precision to size 1040
    work = np.float32 if codes.shape[1] <= 1040 else np.float64
    columns = codes.astype(work).T
    sums, q_sums = np.abs(vectors).sum(axis=1), np.abs(q_vectors).sum(axis=1)
    for at in range(0, len(q_ids), QUERIES_AT_ONCE):
        cut = slice(at, at + QUERIES_AT_ONCE)
        steps = q_scales[cut, None] * scales
        near = (q_codes[cut].astype(work) @ columns) * steps
        error = 0.5 * (q_scales[cut, None] * sums + q_sums[cut, None] * scales)
        error = (error + codes.shape[1] * 0.25 * steps) * (1 + 1e-9)
        low, high = near - error, near + error
        own = ids[None, :] == q_ids[cut, None]
        low[own] = high[own] = -np.inf
        bars = np.full(len(low), -np.inf)
        if len(ids) > k:
            bars = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
        for row, bar in enumerate(bars.tolist()):
            heap = tops[at + row]
            if len(heap) == k:
                bar = max(bar, heap[0][0])
            alive = np.flatnonzero((high[row] >= bar) & ~own[row])
            scores = _exact(q_vectors[at + row], vectors[alive])
            for score, other in zip(scores.tolist(), (-ids[alive]).tolist(), strict=True):
                # of equal scores the smaller id is better: ids count downwards
                if len(heap) < k:
                    heapq.heappush(heap, (score, other))
                elif (score, other) > heap[0]:
                    heapq.heapreplace(heap, (score, other))


def _arrays(size, ids, vectors, codes, scales, kind):
    return (
        np.frombuffer(ids, "<i8"),
        np.frombuffer(vectors, kind).reshape(-1, size).astype(np.float64),
        np.frombuffer(codes, np.int8).reshape(-1, size),
        np.frombuffer(scales, np.float64),
    )


def _search(batches: Iterable[pa.RecordBatch], k: int, kind: type) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by query block; each holds a block of queries and of candidates."""
    current, queries, tops = None, None, []

    def best() -> pa.RecordBatch:
        rows = [
            (query_id, -other, score)
            for query_id, heap in zip(queries[0].tolist(), tops, strict=True)
            for score, other in heap
        ]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    for batch in batches:
        for row in range(batch.num_rows):
            values = [c[row].as_py() for c in batch.columns]
            key, size, ask, offer = values[:3], values[0], values[3:7], values[7:11]
            if key != current:
                if current is not None:
                    yield best()
                current, queries = key, _arrays(size, *ask, kind)
                tops = [[] for _ in queries[0]]
            _tile(queries, _arrays(size, *offer, kind), tops, k)
    if current is not None:
        yield best()


def usable(vector: Column) -> Column:
    """Vectors that are there, not all zero, and hold finite numbers only."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each query row its ``k`` nearest rows.

    Nearness is the largest inner product, in double precision, ties to the smaller id;
    all rows but those with the query's own id are candidates. Exact: the quantised
    products only rule out rows whose error bound can't reach the best. NULL ids, and
    vectors that are NULL, zero or hold a NULL, NaN or infinite component, take no
    part; vectors are compared with those of equal length. Rows that repeat a query's
    id ask each for itself, as one with all their answers: the best ``k`` of them. Other
    columns play no part. An empty table gives an empty one.

    Queries and candidates are cut into blocks of bounded size. Each block of queries is
    sent to every group of four candidate blocks; these stay where they are but for a copy for
    every 64 blocks of queries, which bounds what one task has to do. It brings its candidates
    through the heaps of one block of queries after the other, so what travels is blocks,
    never pairs of rows.
    """
    rows = vectors.select(
        F.col(id_column).cast("long"), F.col(vector_column), is_query
    ).toDF("vec_id", "vector", "asks")
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    asking = rows.where("asks")
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).head()
    kind = np.float32 if dict(rows.dtypes)["vector"] == "array<float>" else np.float64
    q_blocks, blocks = _block_count(counts.q, QUERIES_PER_BLOCK), _block_count(counts.n, ROWS_PER_BLOCK)
    parts = ceil(blocks / BLOCKS_PER_TASK)
    columns = ("ids", "vectors", "codes", "scales")
    groups = ceil(q_blocks / ASKED_TOGETHER)
    asks = _blocks(asking, q_blocks).select(
        "size",
        F.col("block").alias("asking"),
        F.expr(f"CAST(block DIV {ASKED_TOGETHER} AS BIGINT)").alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        *[F.col(c).alias(f"q_{c}") for c in columns],
    )
    offers = stored(_blocks(rows, blocks), "vectors").select(
        "size",
        F.explode(F.sequence(*(F.lit(n).cast("long") for n in (0, groups - 1)))).alias("group"),
        F.pmod("block", F.lit(parts)).cast("int").alias("part"),
        *columns,
    )
    key = ["size", "group", "part"]
    # sorted for the heaps of one block at a time; a block met twice is merged below
    tiles = asks.join(offers, key).sortWithinPartitions(*key, "asking")
    found = tiles.select("size", "asking", "part", *[f"q_{c}" for c in columns], *columns).mapInArrow(
        lambda it: _search(it, k, kind), FOUND
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
