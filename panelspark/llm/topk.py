"""Exact top-k inner products: tiled matrix products of query blocks and candidate shards, merged as a tree.

Queries are taken in blocks of at most ``block`` rows, the only data that is broadcast. A task cuts its candidates into
shards and multiplies each with tiles of the queries; a tile keeps k candidates per query by partial selection, and the
task keeps one running list per query. The lists of the tasks are merged in groups of ``fan_in`` until one is left.
Components are whole numbers; sums are exact in doubles up to 2^53, larger ones use Python's whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

LISTS = "query_id long, vec_id long, score long, part long"
SHARD, TILE = 4096, 256
_EXACT = 1 << 53


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """vec_id and v, the array of floor(scale * x).

    Rows with a NULL id, a NULL or empty vector, or a NULL or non-finite component take no part.
    """
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)) & ~F.isnan(e))
    return (vectors.filter(F.col(id_col).isNotNull() & (F.size(x) > 0) & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda e: F.floor(e * scale)).alias("v")))


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row: highest score, then smallest id. ``ids`` are sorted (one row or as scores)."""
    n = scores.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), scores.shape)
    if scores.dtype != object and np.abs(scores).max(initial=0) < _EXACT // (2 * n):
        key = scores * n - np.arange(n)  # no two are equal, so the selection has no ties
        return np.argpartition(-key, k - 1, axis=1)[:, :k]
    return np.stack([np.lexsort((np.arange(n), np.array([-int(s) for s in row], object)))[:k] for row in scores])


def _search(batches: Iterator[pa.RecordBatch], q_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    part, dim = TaskContext.get().partitionId(), q.shape[1]
    none = np.iinfo(np.int64).max
    best_s = np.full((len(q_ids), 0), 0, q.dtype)
    best_i = np.full((len(q_ids), 0), none, np.int64)
    q_max = np.abs(q).max(initial=0)
    for b in batches:
        lists = b.column(1)
        fits = np.flatnonzero(np.diff(lists.offsets.to_numpy()) == dim)
        for at in range(0, len(fits), SHARD):
            some = pa.array(fits[at:at + SHARD])
            ids = b.column(0).take(some).to_numpy()
            c = lists.take(some).flatten().to_numpy().reshape(-1, dim)
            order = np.argsort(ids, kind="stable")
            ids, c = ids[order], c[order]
            exact = float(q_max) * float(np.abs(c.astype(float)).max(initial=0)) * dim < _EXACT
            c = c.astype(float if exact else object)
            found_s, found_i = [], []
            for t in range(0, len(q_ids), TILE):
                s = (q[t:t + TILE] if exact else q[t:t + TILE].astype(np.int64).astype(object)) @ c.T
                own = ids[None, :] == q_ids[t:t + TILE, None]
                # below every score of the tile, and no further, so that the selection stays in the exact range
                s = np.where(own, s.min(initial=0) - 1, s)
                pick = _top(s, ids, min(k + 1, len(ids)))
                found_s.append(np.take_along_axis(s, pick, 1))
                found_i.append(np.where(np.take_along_axis(own, pick, 1), none, ids[pick]))
            s = np.concatenate([best_s, np.concatenate(found_s)], axis=1)
            i = np.concatenate([best_i, np.concatenate(found_i)], axis=1)
            order = np.lexsort((i, -s), axis=1)[:, :k + 1] if s.dtype != object else np.stack(
                [np.lexsort((x, np.array([-int(y) for y in row], object)))[:k + 1] for row, x in zip(s, i)])
            best_s, best_i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
    r, col = np.nonzero(best_i != none)
    yield pa.RecordBatch.from_pydict({
        "query_id": pa.array(q_ids[r]), "vec_id": pa.array(best_i[r, col]),
        "score": pa.array([int(x) for x in best_s[r, col]], pa.int64()), "part": pa.array(np.full(len(r), part, np.int64))})


def _cuts(asked: DataFrame, n: int, block: int) -> list[tuple[int, int]]:
    """Ranges of the hash h with ``block`` queries at most; only the queries of one hash can be more."""
    if n <= block:
        return [(0, (1 << 20) - 1)]
    step = 1 << 8
    by = {r["g"]: r["n"] for r in asked.groupBy((F.col("h") / step).cast("int").alias("g")).agg(F.count("*").alias("n")).collect()}
    cuts, low, total = [], 0, 0
    for g in sorted(by):  # 4 096 at most
        if total and total + by[g] > block:
            cuts.append((low, g * step - 1))
            low, total = g * step, 0
        total += by[g]
    return [*cuts, (low, (1 << 20) - 1)]


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = 16_384, fan_in: int = 32) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query, its own id left out.

    Both frames have vec_id and v (see :func:`whole_vectors`). Ties go to the smaller vec_id. A query id that repeats is
    asked once, with its smallest vector; candidates that repeat an id are separate rows. Vectors of other lengths than
    a query's do not meet it. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    vectors = stage(vectors.select("vec_id", "v"), "vectors")
    asked = stage(queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
                  .withColumn("h", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))), "queries")
    blocks = []
    for dim, n in [(r.dim, r.n) for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()]:
        mine = asked.filter(F.col("dim") == dim)
        for low, high in _cuts(mine, n, block):
            rows = mine.filter(F.col("h").between(low, high)).select("vec_id", "v").toPandas()
            if len(rows):
                ids, q = rows["vec_id"].to_numpy(np.int64), np.stack(rows["v"]).astype(float)
                sent = spark.sparkContext.broadcast((ids, q))
                blocks.append(stage(vectors.select("vec_id", "v").mapInArrow(
                    lambda batches, sent=sent: _search(batches, *sent.value, k), LISTS), "lists"))
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    lists = blocks[0]
    for more in blocks[1:]:
        lists = lists.unionByName(more)
    groups = (lists.agg(F.max("part")).first()[0] or 0) + 1
    best = F.row_number().over(Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id"))
    while True:
        groups = -(-groups // fan_in)
        lists = (lists.withColumn("part", F.floor(F.col("part") / fan_in)).withColumn("rank", best)
                 .filter(F.col("rank") <= k))
        if groups == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
