"""Exact top-k by inner product: MaxScore over shards of items, shards merged by rank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Items of a shard, queries of a block, and items scored at a time; a task holds one shard and one block.
SHARD, BLOCK, SLICE = 4096, 1024, 512
#: Share of the threshold that the bounds of the non-essential terms may reach together.
REST = 0.5


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null when the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * scale)))


def _dense(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    array = vectors.combine_chunks()
    sizes = np.diff(array.offsets.to_numpy())
    out = np.zeros((len(array), width), np.int64)
    rows = np.repeat(np.arange(len(array)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = array.flatten().to_numpy()
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    """Terms (dimension, sign) with weights of 0 or more: a query and an item gain where they share a term."""
    return np.concatenate([np.maximum(x, 0), np.maximum(-x, 0)], axis=1)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.searchsorted(q, q)
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[keep], scores[keep]


def maxscore(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, items: np.ndarray, k: int, rest: float = REST, step: int = SLICE):
    """(query row, item id, score) of the ``k`` best items of each query; ``ids`` ascending.

    A query's terms are split by their greatest possible gain: those of least gain whose sum stays within ``rest``
    of the query's threshold (its k-th score so far) are non-essential. The postings of the essential terms, and of
    the terms that can only lower a score, are traversed; an item is probed in the other terms, those of most gain
    first, while what is left could lift it over the threshold. Items come by id, so one that only reaches the
    threshold loses the tie.
    """
    width = queries.shape[1]
    peak = float(np.abs(queries).max(initial=0)) * float(np.abs(items).max(initial=0)) * max(1, width)
    kind = np.float64 if peak < 2**53 else np.int64  # doubles are exact here, and faster
    gain, weight = _signed(items).astype(kind), _signed(queries).astype(kind)
    loss = np.concatenate([weight[:, width:], weight[:, :width]], axis=1)
    bound = weight * gain.max(axis=0, initial=0)
    order = np.argsort(bound, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(bound, order, axis=1), axis=1, dtype=np.float64)
    rank = np.argsort(order, axis=1)
    low = -np.inf
    floor = np.full(len(queries), low)
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, kind))
    for a in range(0, len(items), step):
        part = gain[a : a + step]
        spare = (sums <= (rest * floor)[:, None]).sum(axis=1)  # non-essential: the first of the order
        left = np.where(spare > 0, np.take_along_axis(sums, np.maximum(spare - 1, 0)[:, None], axis=1)[:, 0], 0.0)
        score = (np.where(rank >= spare[:, None], weight, 0) - loss) @ part.T
        q, d = np.nonzero((score + left[:, None] > floor[:, None]) & (query_ids[:, None] != ids[a : a + step]))
        s, at, more = score[q, d], spare[q], left[q]
        while len(q) and at.max() > 0:
            live = np.flatnonzero(at > 0)
            term = order[q[live], at[live] - 1]
            s[live] += weight[q[live], term] * part[d[live], term]
            at[live] -= 1
            more[live] = np.where(at[live] > 0, sums[q[live], np.maximum(at[live] - 1, 0)], 0.0)
            on = s + more > floor[q]
            q, d, s, at, more = q[on], d[on], s[on], at[on], more[on]
        if len(q):
            best = _best(np.concatenate([best[0], q]), np.concatenate([best[1], ids[a + d]]), np.concatenate([best[2], s]), k)
            full = np.bincount(best[0], minlength=len(queries)) >= k
            last = np.searchsorted(best[0], np.arange(len(queries)), "right") - 1
            floor = np.where(full, best[2][np.maximum(last, 0)], low).astype(np.float64)
    return best


def _shard(k: int):
    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy()
        width = max(1, max((len(v) for v in table.column("vector")), default=1))
        ids, x = table.column("id").to_numpy(), _dense(table.column("vector"), width)
        order = np.argsort(ids[~is_query], kind="stable")
        q, d, s = maxscore(ids[is_query], x[is_query], ids[~is_query][order], x[~is_query][order], k)
        return pa.table({"query_id": ids[is_query][q], "vec_id": d, "score": s.astype(np.int64)})

    return run


def top_k(items: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` items of greatest inner product of each query (all, if fewer).

    ``items`` and ``queries``: id long, vector array<long>, of any sizes (missing components are 0). An item with
    the query's id is no candidate. Ties go to the smaller id. Each shard of items meets each block of queries in
    one task; the shards' best are merged by rank. Rows without id or vector take no part. Rows that share an id
    count as one, with the smallest vector. No item or no query: no row. Products must fit a long.
    """
    one = lambda df: df.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    items, queries = one(items.select("id", "vector")), one(queries.select("id", "vector"))
    shards, blocks = max(1, -(-items.count() // shard)), max(1, -(-queries.count() // block))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = items.select("id", "vector", F.lit(False).alias("is_query"), place(shards).alias("shard"), each(blocks).alias("block"))
    right = queries.select("id", "vector", F.lit(True).alias("is_query"), each(shards).alias("shard"), place(blocks).alias("block"))
    found = left.unionAll(right).groupBy("shard", "block").applyInArrow(_shard(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
