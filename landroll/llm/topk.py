"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are integer weights on signed terms (dimension i positive, dimension i
negative).  Candidates, in order of vec_id, form shards and within them
document-range blocks; a block keeps a forward index (ids and weights of its
rows) and the largest weight of each term.  For a query, the sum over its
terms of weight times block maximum bounds every score of the block.  Blocks
are taken by descending bound, scored through their forward index, and the
rest of the shard is skipped once the bound falls below the query's k-th best
score (an equal bound is still scored, as ties go to the smaller vec_id).

Every chunk of queries meets every shard of candidates once, as two bounded
tables in one task; a shard returns at most k rows a query, and those are
ranked per query.

Defined results: vectors that are null or hold a null or non-finite component
take no part; components that one of two vectors lacks count as zero; rows
that repeat a vec_id are candidates of their own, but not for queries of that
vec_id; a query that is repeated unchanged is answered once; an empty table
gives an empty result; other columns are ignored.  Scores are exact while
they fit in a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BLOCK_ROWS = 512
SHARD_ROWS = 8_192
CHUNK_QUERIES = 2_048
_EXACT = 1 << 53        # doubles add integers exactly below this


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
              scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of every finite vector."""
    v = F.col(vector_column)
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
                        F.lit(False))
    return (vectors.where(F.col(id_column).isNotNull() & finite)
            .select(F.col(id_column).cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias("v")))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list<long> array, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == width).all():
        return flat[ends[0]:ends[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        out[i, :b - a] = flat[a:b]
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer q @ x.T, in doubles where these are exact."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < _EXACT:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


def forward_blocks(candidates: DataFrame, n_shards: int, width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(shard, ids, weights, top, low): one row per document-range block, as packed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        ids, rows = np.empty(0, np.int64), np.empty((0, width), np.int64)

        def packed(i: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
            cells = (i.tobytes(), np.ascontiguousarray(w).tobytes(), w.max(axis=0).tobytes(), w.min(axis=0).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
                ["shard", "ids", "weights", "top", "low"])

        for batch in batches:
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            rows = np.concatenate([rows, _matrix(batch.column(1), width)])
            while len(ids) >= block_rows:
                yield packed(ids[:block_rows], rows[:block_rows])
                ids, rows = ids[block_rows:], rows[block_rows:]
        if len(ids):
            yield packed(ids, rows)

    return (candidates.repartitionByRange(n_shards, "vec_id").sortWithinPartitions("vec_id")
            .mapInArrow(run, "shard int, ids binary, weights binary, top binary, low binary"))


def search_shard(query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, ...]],
                 k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query number, vec_id, score) of the k best of one shard per query, and the (query, block) pairs scored.

    A block is (ids, weights, top, low), its ids ascending.
    """
    top, low = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bound = _products(np.maximum(queries, 0), top) + _products(np.minimum(queries, 0), low)
    order = np.argsort(-bound, axis=1, kind="stable")
    n = len(queries)
    best: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # (-score, vec_id), ascending
    kth = np.full(n, np.iinfo(np.int64).min)
    live, scored = np.arange(n), 0
    for turn in range(len(blocks)):
        live = live[bound[live, order[live, turn]] >= kth[live]]
        if not len(live):
            break
        scored += len(live)
        at = order[live, turn]
        for number in np.unique(at):
            own = live[at == number]
            ids, weights = blocks[number][:2]
            scores = _products(queries[own], weights)
            for q, row in zip(own, scores):
                floor, others = kth[q], ids != query_ids[q]
                row = np.where(others, row, np.iinfo(np.int64).min)  # any number of rows may have the query's id
                if len(ids) > k:
                    floor = max(floor, np.partition(row, -k)[-k])
                hits = np.flatnonzero((row >= floor) & others)
                if len(hits):
                    hits = hits[np.argsort(-row[hits], kind="stable")[:k]]
                    merged = sorted(best[q] + [(-int(row[h]), int(ids[h])) for h in hits])[:k]
                    best[q] = merged
                    if len(merged) == k:
                        kth[q] = -merged[-1][0]
    flat = [(q, v, -s) for q, found in enumerate(best) for s, v in found]
    q, v, s = (np.array(x, np.int64) for x in zip(*flat)) if flat else (np.empty(0, np.int64),) * 3
    return q, v, s, scored


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``, both (vec_id, v)."""
    vectors = staged(vectors, "vectors")
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    asked = staged(queries.distinct(), "queries")
    n_queries = asked.count()
    width = max(width or 0, asked.agg(F.max(F.size("v"))).first()[0] or 0)
    blocks = staged(forward_blocks(vectors, max(1, math.ceil(n / SHARD_ROWS)), width), "blocks")
    last_shard = blocks.agg(F.max("shard")).first()[0]
    n_chunks = max(1, math.ceil(n_queries / CHUNK_QUERIES))

    chunk: Column = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_chunks)).cast("int")
    asking = asked.select(F.explode(F.sequence(F.lit(0), F.lit(last_shard or 0))).alias("shard"),
                          chunk.alias("chunk"), F.col("vec_id").alias("query_id"),
                          F.xxhash64("v").alias("query_key"), "v")
    offered = blocks.select("shard", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"),
                            "ids", "weights", "top", "low")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            unpack = [[np.frombuffer(x, np.int64) for x in left.column(c).to_pylist()]
                      for c in ("ids", "weights", "top", "low")]
            found = sorted(((i, w.reshape(len(i), -1), t, lo) for i, w, t, lo in zip(*unpack)), key=lambda b: b[0][0])
            ids, keys = right.column("query_id").to_numpy(), right.column("query_key").to_numpy()
            q, v, s, _ = search_shard(ids, _matrix(right.column("v"), width), found, k)
        else:
            ids = keys = q = v = s = np.empty(0, np.int64)
        return pa.table({"query_id": ids[q], "query_key": keys[q], "vec_id": v, "score": s})

    found = (offered.groupBy("shard", "chunk").cogroup(asking.groupBy("shard", "chunk"))
             .applyInArrow(run, "query_id long, query_key long, vec_id long, score long"))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
