"""Centroid clustering of integer vectors over a VA-file.

Each component of a vector is also kept as the number of one of 64 cells, 6 bits. For a set of centroids, lookup tables
give the least and the largest squared distance that a cell allows per dimension, so their sums bound the distance of a
vector to every centroid. A round reads the cells alone; whole vectors are fetched only where the intervals of several
centroids overlap, and where a vector changes its cluster, since sums are kept by what enters and leaves. All numbers are
integers and exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stage

#: Bits of a cell, and vectors from which the cells' borders are taken (those of least row hash). Borders decide how
#: often vectors are fetched, never a result.
CELL_BITS, BORDER_SAMPLE = 6, 4096

# Factor of the components, components, centroids, rounds, salt of the start
FACTOR, WIDTH, CENTROIDS, ROUNDS, SALT = 64, 64, 16, 3, "1:"

#: Components are held within this, so that every squared distance of 64 of them fits a long.
REACH = 1 << 27


def _rows(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def whole_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH,
                  factor: int = FACTOR) -> DataFrame:
    """Stored rid, vec_id, v of the vectors with ``width`` components, none NULL, NaN or infinite."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            lists = b.column(1)
            ok = np.diff(lists.offsets.to_numpy()) == width
            ok &= ~lists.is_null().to_numpy(zero_copy_only=False)
            some = b.filter(pa.array(ok))
            flat = some.column(1).flatten().cast(pa.float64())
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, width)  # NULL becomes NaN
            fine = np.isfinite(x).all(axis=1)
            v = np.clip(np.floor(x[fine] * factor), -REACH, REACH).astype(np.int64)
            at = np.arange(rid, rid + len(v), dtype=np.int64)
            rid += len(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), some.column(0).filter(pa.array(fine)), _lists(v)], ["rid", "vec_id", "v"])

    kept = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    return stage(kept.mapInArrow(take, "rid long, vec_id long, v array<long>"), "vectors")


def _lists(v: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32), v.ravel())


class Cells:
    """Borders of the cells of each dimension and the packing of cell numbers."""

    def __init__(self, borders: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int):
        self.borders, self.bits = borders, bits
        self.least = np.concatenate([low[:, None], np.maximum(borders, low[:, None])], axis=1)
        self.most = np.concatenate([np.minimum(borders - 1, high[:, None]), high[:, None]], axis=1)

    def codes(self, v: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, x, "right") for b, x in zip(self.borders, v.T)], axis=1).astype(np.uint8)

    def pack(self, codes: np.ndarray) -> pa.Array:
        bits = np.unpackbits(codes[:, :, None], axis=2, bitorder="little", count=self.bits)
        packed = np.packbits(bits.reshape(len(codes), -1), axis=1, bitorder="little")
        return pa.array([p.tobytes() for p in packed], pa.binary())

    def unpack(self, column: pa.Array) -> np.ndarray:
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
        n = len(self.borders)
        bits = np.unpackbits(raw, axis=1, bitorder="little", count=n * self.bits).reshape(len(raw), n, self.bits)
        return np.packbits(bits, axis=2, bitorder="little")[:, :, 0]

    def candidates(self, codes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Per vector and centroid: whether it may be the nearest, by the intervals of the distances."""
        low = np.zeros((len(codes), len(centroids)), np.int64)
        high = np.zeros_like(low)
        for d in range(codes.shape[1]):
            c = centroids[:, d][None, :]
            a, b = self.least[d][:, None], self.most[d][:, None]
            gap = np.maximum(np.maximum(a - c, c - b), 0)
            far = np.maximum(np.abs(a - c), np.abs(b - c))
            low += (gap * gap)[codes[:, d]]
            high += (far * far)[codes[:, d]]
        return low <= high.min(axis=1, keepdims=True)


def nearest(v: np.ndarray, centroids: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid among the candidates (the smaller number on a tie) and its squared distance."""
    best = np.full(len(v), np.iinfo(np.int64).max)
    own = np.zeros(len(v), np.int32)
    for k, c in enumerate(centroids):
        at = np.flatnonzero(may[:, k])
        d = ((v[at] - c) ** 2).sum(axis=1)
        less = d < best[at]
        best[at[less]], own[at[less]] = d[less], k
    return own, best


def fit_cells(vectors: DataFrame, bits: int = CELL_BITS, sample: int = BORDER_SAMPLE) -> Cells:
    """Cells between the exact ends of each dimension, with equal steps between two quantiles of a bounded sample."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for b in batches:
            if b.num_rows:
                v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                low = v.min(axis=0) if low is None else np.minimum(low, v.min(axis=0))
                high = v.max(axis=0) if high is None else np.maximum(high, v.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high)],
                                             ["d", "low", "high"])

    by = (vectors.select("v").mapInArrow(ends, "d int, low long, high long").groupBy("d")
          .agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect())  # one row a dimension
    some = vectors.orderBy(F.xxhash64("rid")).select("v").limit(sample).collect()
    x = np.array([r.v for r in some], np.int64)
    near, far = np.quantile(x, [0.001, 0.999], axis=0)  # an outlier widens the two outer cells only
    borders = np.ceil(np.linspace(near, far + 1, (1 << bits) + 1, axis=1)[:, 1:-1]).astype(np.int64)
    return Cells(borders, np.array([r.low for r in by]), np.array([r.high for r in by]), bits)


def _sums(rows: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum by cluster of rows old, new, v: what enters ``new``, less what leaves ``old``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            old, new = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            v = _rows(b.column(2), width)
            v = np.concatenate([np.ones((len(v), 1), np.int64), v], axis=1)
            for side, sign in ((new, 1), (old, -1)):
                for k in np.unique(side[side >= 0]).tolist():
                    total[k] = total.get(k, 0) + sign * v[side == k].sum(axis=0)
        for k, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), k, np.int32)),
                                              pa.array(np.arange(len(t), dtype=np.int32)), pa.array(t)], ["k", "d", "s"])

    out: dict[int, list[int]] = {}
    parts = rows.select("old", "new", "v").mapInArrow(add, "k int, d int, s long")
    for r in parts.groupBy("k", "d").agg(F.sum(F.col("s").cast("decimal(28,0)")).alias("s")).collect():
        out.setdefault(r.k, [0] * (width + 1))[r.d] = int(r.s)  # one row per centroid and dimension
    return {k: (s[0], s[1:]) for k, s in out.items()}


def cluster(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH,
            centroids: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT, bits: int = CELL_BITS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part.

    NULL vectors, those of another length and those with a NULL or non-finite component take no part; a component of
    more than 2^27 after scaling counts as 2^27. Rows that repeat are separate vectors; rows with equal ids start in the
    order of their components, a NULL id never starts a centroid unless ids run out. With fewer vectors than centroids
    there are as many centroids as vectors; an empty table gives no rows. Other columns are ignored. Inertia that does
    not fit a long is NULL.
    """
    vectors = whole_vectors(embeddings, id_col, vector_col, width)
    spark = vectors.sparkSession
    start = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    seeds = vectors.select("v", start.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(centroids).collect()
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    where = np.array([r.v for r in seeds], np.int64)
    cells = fit_cells(vectors, bits)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _rows(b.column(1), width)
            codes = cells.codes(v)
            own, _ = nearest(v, where, cells.candidates(codes, where))
            yield pa.RecordBatch.from_arrays([b.column(0), cells.pack(codes), pa.array(own)], ["rid", "cells", "cluster"])

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _rows(b.column(0), width)
            own, _ = nearest(v, where, cells.candidates(cells.codes(v), where))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), -1, np.int32)), pa.array(own), b.column(0)],
                                             ["old", "new", "v"])

    # the first round meets every vector, as all of them enter a cluster
    state = stage(vectors.select("rid", "v").mapInArrow(encode, "rid long, cells binary, cluster int"), "va-file")
    sums = _sums(vectors.select("v").mapInArrow(enter, "old int, new int, v array<long>"), width)
    for n in range(rounds):
        if n:
            state, moved = _reassign(state, vectors, cells, where, width)
            for k, (count, s) in moved.items():
                was, total = sums.get(k, (0, [0] * width))
                sums[k] = was + count, [a + b for a, b in zip(total, s)]
        where = np.array([[x // sums[k][0] for x in sums[k][1]] if k in sums and sums[k][0] else c.tolist()
                          for k, c in enumerate(where)], np.int64)
    return _final(vectors, cells, where, width)


def _reassign(state: DataFrame, vectors: DataFrame, cells: Cells, where: np.ndarray, width: int
              ) -> tuple[DataFrame, dict[int, tuple[int, list[int]]]]:
    """Assignments to new centroids by cells, whole vectors only for overlaps and moves; and the change of the sums."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            may = cells.candidates(cells.unpack(b.column(1)), where)
            sure = np.where(may.sum(axis=1) == 1, may.argmax(axis=1), -1).astype(np.int32)
            mask = (may.astype(np.int64) << np.arange(len(where))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sure), pa.array(mask)],
                                             ["rid", "cells", "cluster", "sure", "may"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _rows(b.column(3), width)
            may = (b.column(2).to_numpy()[:, None] >> np.arange(len(where))) & 1 == 1
            own, _ = nearest(v, where, may)
            old = b.column(1).to_numpy()
            moves = pa.array(own != old)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(own), pc.if_else(moves, b.column(3), pa.scalar(None, b.column(3).type))],
                ["rid", "old", "new", "v"])

    seen = stage(state.select("rid", "cells", "cluster").mapInArrow(
        look, "rid long, cells binary, cluster int, sure int, may long"), "va-look")
    asked = seen.filter("sure <> cluster").select("rid", F.col("cluster").alias("old"), "may")
    found = _fetched(asked, vectors).select("rid", "old", "may", "v").mapInArrow(
        fetch, "rid long, old int, new int, v array<long>")
    found = stage(found, "va-fetched")
    sums = _sums(found.filter("v IS NOT NULL"), width)
    after = lookup_join(seen, found.select("rid", "new"), ["rid"]).select(
        "rid", "cells", F.coalesce("new", "sure").alias("cluster"))
    return stage(after, "va-file"), sums


def _fetched(asked: DataFrame, vectors: DataFrame) -> DataFrame:
    """Asked rows with their whole vectors."""
    return lookup_join(vectors.select("rid", "v"), asked, ["rid"], "inner")


def _final(vectors: DataFrame, cells: Cells, where: np.ndarray, width: int) -> DataFrame:
    """The last assignment, with distances, which need every vector."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _rows(b.column(1), width)
            own, best = nearest(v, where, cells.candidates(cells.codes(v), where))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own), pa.array(best)], ["vec_id", "cluster", "distance"])

    rows = stage(vectors.select("vec_id", "v").mapInArrow(measure, "vec_id long, cluster int, distance long"), "assigned")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()
    whole = sum(int(r.s) for r in sums)
    known = [(r.cluster, _long(int(r.s)), _long(whole),
              hashlib.sha256(",".join(map(str, where[r.cluster].tolist())).encode()).hexdigest()) for r in sums]
    names = rows.sparkSession.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(names), "cluster").select(  # one row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(n: int) -> int | None:
    return n if n < 1 << 63 else None


def _oracle() -> str:
    """The same rounds in SQL, every vector against every centroid."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""d{r} AS (SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - x[i]) * (v[i] - x[i]))) AS d
  FROM v, c{r}),
a{r} AS (SELECT vec_id, v, c, CAST(d AS BIGINT) AS d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""e{r} AS (SELECT c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY c, i),
n{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM e{r} GROUP BY c),
c{r + 1} AS (SELECT c{r}.c, coalesce(n{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN n{r} ON n{r}.c = c{r}.c)""")
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS c, v AS x FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= {CENTROIDS}),
{", ".join(steps)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} k ON k.c = a.c
"""


ORACLE = _oracle()
