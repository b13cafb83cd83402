"""Regression forests of very many groups at once, from histograms that Spark adds up.

Features are cut into bins per group. All trees of all groups grow level by level: a task finds the node of each of its
rows in every tree, and sums weights and targets by (group, tree, node, feature, bin); a shuffle adds these up, and the
best split of a node is a running sum over its bins. So a group's rows may lie anywhere, no group is ever in one task, and
a job serves all groups. Only the chosen splits, one row a node, reach the driver; groups come in blocks that bound them.

A selection stores its rows once, dealt at random to blocks, each of one group. A round's shadows are the bins of a block in
another order, drawn in the task, so that they need no shuffle and the forests of many rounds share each pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import parts_for, reliable_checkpoint

#: Bins of a feature, and nodes of all trees that are sent to the tasks at a time.
BINS, MOST_NODES = 32, 1 << 20

#: Sums that a task keeps until its end, and rows that it counts at a time.
DENSE_CELLS, BUFFER_ROWS = 1 << 22, 1 << 17

#: Rows among which a shadow is drawn, on average.
SHADOW_ROWS = 1024

#: Rows of a stored block, about.
BLOCK_ROWS = 1 << 15

#: Columns of the sums that tasks hand on.
SUMS = "at long, f int, s binary"


def binned(df: DataFrame, group: str, features: Sequence[str], target: str, ids: Sequence[str], bins: int = BINS) -> DataFrame:
    """Stored rid, grp, y, b: rows with a target, their features as bin numbers of their group; NULL is a bin of its own."""
    known = df.where(F.col(target).isNotNull() & F.col(group).isNotNull())
    known = reliable_checkpoint(known.select(*dict.fromkeys([*ids, group, target, *features])), "known")  # read for the cuts and the bins
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = known.groupBy(F.col(group).alias("_g")).agg(*[
        F.array_distinct(F.percentile_approx(F.col(f).cast("double"), shares, F.lit(1000))).alias(f"_c_{f}") for f in features])
    cuts = reliable_checkpoint(cuts, "cuts")
    rows = known.join(cuts, F.col(group) == F.col("_g"))

    def place(f: str) -> Column:
        x = F.col(f).cast("double")
        return F.when(x.isNull(), bins).otherwise(F.size(F.filter(f"_c_{f}", lambda c: c < x)))
    return reliable_checkpoint(rows.select(
        F.xxhash64(*ids).alias("rid"), F.col(group).cast("long").alias("grp"), F.col(target).cast("double").alias("y"),
        F.array(*[place(f) for f in features]).cast("array<tinyint>").alias("b")), "binned")


def with_shadows(rows: DataFrame, seed: int) -> DataFrame:
    """Add to each row's bins those of another row of its group, drawn among about SHADOW_ROWS of them."""
    sizes = rows.groupBy("grp").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / SHADOW_ROWS)).alias("_parts"))
    h = F.xxhash64("rid", F.lit(seed))
    dealt = (rows.join(sizes, "grp").withColumn("_h", F.xxhash64("rid", F.lit(~seed)))
             .withColumn("_part", F.pmod(h, F.col("_parts"))))
    w = Window.partitionBy("grp", "_part").orderBy("_h", "rid")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lag("b").over(w), F.last("b").over(whole))
    return dealt.withColumn("_s", other).select("rid", "grp", "y", F.concat("b", "_s").alias("b"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Chances of at most 0, 1, 2, ... draws of a row in a sample with replacement (Poisson with mean one).
_DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1, 9)]))


def _weights(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    h = _mixed(rid.view(np.uint64) + np.uint64((seed * 1_000_003 + tree * 7919 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    u, w = (h >> np.uint64(11)).astype(np.float64) / 2.0 ** 53, np.zeros(len(rid))
    for d in _DRAWS:
        w += u >= d
    return w


def _xxhash64(rid: np.ndarray, number: int) -> np.ndarray:
    """Spark's xxhash64 of a long and an int."""
    a, b, c, d, e = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    def ended(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(33))) * b
        h = (h ^ (h >> np.uint64(29))) * c
        return h ^ (h >> np.uint64(32))

    h = turned(rid.view(np.uint64) * b, 31) * a ^ np.uint64(0x27D4EB2F165667C5 + 8 + 42)
    h = ended(turned(h, 27) * a + d)
    h = (h + e + np.uint64(4)) ^ np.uint64((number & 0xFFFFFFFF) * 0x9E3779B185EBCA87 & (1 << 64) - 1)
    return ended(turned(h, 23) * b + c).view(np.int64)


def _shadow_rows(rid: np.ndarray, seed: int, among: int) -> np.ndarray:
    """Row whose bins are each row's shadow, as ``with_shadows`` draws them; rows are in the order of rid."""
    parts = max(1, -(-len(rid) // among))
    part = np.mod(_xxhash64(rid, seed), parts)
    order = np.argsort(_xxhash64(rid, ~seed), kind="stable")
    order = order[np.argsort(part[order].astype(np.uint16) if parts < 1 << 16 else part[order], kind="stable")]
    new = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0])
    before = np.r_[0, order[:-1]]
    before[new] = order[np.r_[new[1:], len(order)] - 1]
    other = np.empty(len(rid), np.int64)
    other[order] = before
    return other


def _nodes(group: np.ndarray, bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, tree: int, level: int) -> np.ndarray:
    """Node of each row at a level of a tree (root 0; children 2n + 1, 2n + 2), -1 where its branch has ended."""
    node = np.zeros(len(group), np.int64)
    for _ in range(level):
        f = np.where(node >= 0, feature[group, tree, np.maximum(node, 0)], -1)
        go = f >= 0
        right = bins[np.arange(len(group)), np.maximum(f, 0)] > cut[group, tree, np.maximum(node, 0)]
        node = np.where(go, 2 * node + 1 + right, -1)
    return node


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches together, about BUFFER_ROWS rows at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= BUFFER_ROWS:
            yield held
            held = []
    if held:
        yield held


def splits(rows: DataFrame, groups: Sequence[int], n_features: int, trees: int, depth: int, seed: int,
           bins: int = BINS) -> list[tuple[int, int, int, int, int, float]]:
    """(group number, tree, node, feature, bin, gain) of all splits of the groups' trees; rows go right above the bin."""
    nodes = (1 << depth) - 1
    names = np.array(groups, np.int64)
    feature = np.full((len(names), trees, nodes), -1, np.int16)
    cut = np.zeros((len(names), trees, nodes), np.int16)
    out: list[tuple[int, int, int, int, int, float]] = []
    width = bins + 1
    for level in range(depth):
        sent = rows.sparkSession.sparkContext.broadcast((names, feature, cut))

        first, at_level = (1 << level) - 1, 1 << level
        cells = len(names) * at_level * width  # of one feature and tree
        dense = cells * trees * n_features <= DENSE_CELLS

        def tallied(buffer: list[pa.RecordBatch], sent=sent, level=level, at_level=at_level, first=first
                    ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
            """tree, feature, cell of each live row, its weight, its weighted target."""
            known, feat, cuts = sent.value
            batch = pa.Table.from_batches(buffer).combine_chunks()
            grp = batch.column(1).to_numpy()
            at = np.minimum(np.searchsorted(known, grp), len(known) - 1)
            keep = np.flatnonzero(known[at] == grp)
            if not len(keep):
                return
            g, rid = at[keep], batch.column(0).to_numpy()[keep]
            y = batch.column(2).to_numpy()[keep]
            b = batch.column(3).combine_chunks().flatten().to_numpy().reshape(batch.num_rows, -1)[keep]
            for tree in range(trees):
                node = _nodes(g, b, feat, cuts, tree, level)
                w = _weights(rid, tree, seed)
                live = np.flatnonzero((node >= 0) & (w > 0))
                base = (g[live] * at_level + node[live] - first) * width
                for f in range(n_features):
                    yield tree, f, base + b[live, f], w[live], w[live] * y[live]

        def rows_of(tree: int, f: int, cell: np.ndarray, w: np.ndarray, s: np.ndarray, at_level=at_level, first=first) -> pa.RecordBatch:
            slot, row = np.unique(cell // width, return_inverse=True)
            sums = np.zeros((len(slot), 2, width))
            sums[row, 0, cell % width], sums[row, 1, cell % width] = w, s
            return _packed((slot // at_level * trees + tree) * nodes + first + slot % at_level, np.full(len(slot), f, np.int32), sums)

        def gather(batches: Iterator[pa.RecordBatch], cells=cells, dense=dense, tallied=tallied, rows_of=rows_of) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, trees, n_features, cells)) if dense else None
            for buffer in _buffers(batches):
                for tree, f, cell, w, s in tallied(buffer):
                    if dense:  # sums of the whole task, handed on once
                        total[0, tree, f] += np.bincount(cell, w, cells)
                        total[1, tree, f] += np.bincount(cell, s, cells)
                    elif len(cell):
                        key, back = np.unique(cell, return_inverse=True)
                        yield rows_of(tree, f, key, np.bincount(back, w), np.bincount(back, s))
            if dense:
                for tree in range(trees):
                    for f in range(n_features):
                        key = np.flatnonzero(total[0, tree, f])
                        if len(key):
                            yield rows_of(tree, f, key, total[0, tree, f, key], total[1, tree, f, key])

        sums = rows.select("rid", "grp", "y", "b").mapInArrow(gather, SUMS)
        for r in best_splits(sums).collect():  # one row a node
            group, rest = divmod(r["at"], trees * nodes)
            tree, node = divmod(rest, nodes)
            feature[group, tree, node], cut[group, tree, node] = r["f"], r["bin"]
            out.append((group, tree, node, r["f"], r["bin"], r["gain"]))
    return out


def _packed(at: np.ndarray, f: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """One row a node and column, the sums of weights and weighted targets of its bins as doubles."""
    size = 8 * sums[0].size if len(sums) else 0
    ends = pa.py_buffer(np.arange(0, size * len(at) + 1, max(size, 1), np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int64)), pa.array(f.astype(np.int32)),
         pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, ends, pa.py_buffer(np.ascontiguousarray(sums))])], ["at", "f", "s"])


def best_splits(sums: DataFrame) -> DataFrame:
    """at, f, bin, gain of the split of each node that lowers the squared error most; ties to the smaller feature, bin.

    ``sums`` has a row for each node and column of a task. They meet by node and are added up as arrays.
    """
    def best(at: np.ndarray, f: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(f) != 0)])
        at, f, (w, s) = at[edges], f[edges], np.add.reduceat(s, edges, axis=0).cumsum(axis=2).transpose(1, 0, 2)
        left, rest = w[:, -1:] - w, s[:, -1:] - s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.round(s * s / w + rest * rest / left - s[:, -1:] * s[:, -1:] / w[:, -1:], 9)
        gain = np.where((w > 0) & (left > 0) & (gain > 1e-9), gain, 0)
        cut, gain = gain.argmax(axis=1), gain.max(axis=1)
        order = np.lexsort((f, -gain, at))
        first = order[np.r_[True, np.diff(at[order]) != 0]]
        first = first[gain[first] > 0]
        return pa.RecordBatch.from_arrays([pa.array(at[first]), pa.array(f[first]), pa.array(cut[first].astype(np.int32)), pa.array(gain[first])],
                                          ["at", "f", "bin", "gain"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(2)
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
            own = (batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                   np.frombuffer(column.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0]))).reshape(len(column), 2, -1))
            if held is not None:
                own = tuple(map(np.concatenate, zip(held, own)))
            last = int(np.searchsorted(own[0], own[0][-1]))  # more of this node may follow
            if last:
                yield best(*(x[:last] for x in own))
            held = tuple(x[last:].copy() for x in own)
        if held is not None:
            yield best(*held)

    return sums.repartition("at").sortWithinPartitions("at", "f").mapInArrow(add_up, "at long, f int, bin int, gain double")


def keyed_selection(df: DataFrame, group: str, features: Sequence[str], target: str, ids: Sequence[str], *,
                    rounds: int = 20, trees: int = 200, depth: int = 7, alpha: float = 0.05, seed: int = 42,
                    bins: int = BINS) -> DataFrame:
    """All-relevant selection for every group: group, feature, hits, selected, rank.

    Each round draws shadows anew and counts the features whose gain is above that of the group's best shadow. The forests of
    all groups and of as many rounds as a task can hold sums of grow together, one pass over the rows a level. Counts decide by a binomial test, corrected for the number of features. Groups
    without a row with a target are left out; a constant target selects nothing.
    """
    blocks, names = grouped_blocks(binned(df, group, features, target, ids, bins))
    n = len(features)
    hits = np.zeros((len(names), n), int)
    shares = _shares(blocks)
    for some in _lots(rounds, trees, 2 * n, depth, bins, shares):
        block = max(1, MOST_NODES // (len(some) * trees << depth))
        for at in range(0, len(names), block):
            gain = _forests(blocks, names[at:at + block], some, trees, depth, seed, 2 * n, 2 * n, bins, shares)
            gain = gain.reshape(len(gain), len(some), trees, 2 * n).sum(axis=2)
            hits[at:at + block] += (gain[:, :, :n] > gain[:, :, n:].max(axis=2, keepdims=True)).sum(axis=1)
    level = alpha / max(n, 1)
    out = []
    for g, mine in zip(names, hits.tolist()):
        chosen = [_binomial_tail(x, rounds) < level for x in mine]
        dropped = [_binomial_tail(rounds - x, rounds) < level for x in mine]
        order = sorted({x for x, d in zip(mine, dropped) if d}, reverse=True)
        out += [(g, features[f], mine[f], chosen[f], 1 if chosen[f] else 3 + order.index(mine[f]) if dropped[f] else 2)
                for f in range(n)]
    return df.sparkSession.createDataFrame(out, f"{group} long, feature string, hits int, selected boolean, rank int")


def selection_records(ranks: DataFrame, group: str, run_date: Column | None = None, model_type: str = "shadow") -> DataFrame:
    """One record per group with the chosen names and the ranks, as the stored selections have it."""
    key = {c: F.col(group).cast("int") if c == group else F.lit(None).cast("int") for c in ("company_id", "sector_id")}
    return ranks.groupBy(group).agg(
        F.array_sort(F.collect_list(F.when(F.col("selected"), F.col("feature")))).alias("selected_features"),
        F.count(F.lit(1)).cast("int").alias("total_features"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "rank")))).alias("feature_importances")).select(
        key["company_id"].alias("company_id"), key["sector_id"].alias("sector_id"),
        (F.current_date() if run_date is None else run_date).alias("run_date"), F.lit(model_type).alias("model_type"),
        "selected_features", "total_features", "feature_importances")


def random_blocks(df: DataFrame, features: Sequence[str], target: str, ids: Sequence[str], bins: int = BINS) -> DataFrame:
    """Stored grp, block, chunk, y, b, and rid without a value: rows, all of group 0, dealt to blocks by a hash of their ids, a block in one row.

    ``y`` holds the targets less their mean as doubles, ``b`` a byte for each feature of each row: its bin; NULL is a bin of
    its own, NaN is in the last.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    n, mean, *found = df.agg(F.count(F.lit(1)), F.avg(F.col(target).cast("double")), *[
        F.array_distinct(F.percentile_approx(F.col(f).cast("double"), shares, F.lit(1000))) for f in features]).first()
    if not n:
        raise ValueError("no row has a target")
    cuts, wide = [np.array(c or [], float) for c in found], len(features)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.empty((batch.num_rows, wide), np.uint8)
            for i, c in enumerate(cuts):
                column = batch.column(2 + i)
                b[:, i] = np.searchsorted(c, column.to_numpy(zero_copy_only=False))
                b[column.is_null().to_numpy(zero_copy_only=False), i] = bins
            ends = pa.py_buffer(np.arange(0, wide * batch.num_rows + 1, wide, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(b)])],
                ["rid", "y", "b"])

    rows = df.select(F.xxhash64(*ids).alias("rid"), (F.col(target).cast("double") - mean).alias("y"), *[
        F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]).mapInArrow(place, "rid long, y double, b binary")
    number = F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(-(-n // BLOCK_ROWS)))
    return _stored_blocks(rows.select(F.lit(0).cast("long").alias("grp"), number.alias("block"), "y", "b", "rid"), n, False)


def grouped_blocks(rows: DataFrame) -> tuple[DataFrame, list[int]]:
    """Stored grp, block, chunk, y, b, rid of the rows of ``binned``, a block of one group in one row; and the groups.

    Draws follow the ids, so a group that fits a block gets those of ``with_shadows`` and ``splits``. Blocks are numbered through all groups; ``y`` holds the targets less their group's mean.
    """
    found = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")).orderBy("grp").collect()  # one row a group
    parts = [-(-r["n"] // BLOCK_ROWS) for r in found]
    sizes = rows.sparkSession.createDataFrame(
        [(r["grp"], r["mean"], p, sum_ - p) for r, p, sum_ in zip(found, parts, accumulate(parts))], "grp long, _mean double, _parts long, _first long")
    number = F.col("_first") + F.pmod(F.xxhash64("rid", F.lit(7)), F.col("_parts"))
    dealt = rows.join(sizes, "grp").select("grp", number.alias("block"), (F.col("y") - F.col("_mean")).alias("y"), "b", "rid")
    return _stored_blocks(dealt, sum(r["n"] for r in found), True), [r["grp"] for r in found]


def _stored_blocks(dealt: DataFrame, n: int, ids: bool) -> DataFrame:
    """The n rows grp, block, y, b, rid as one row a block; one of more than twice its rows (equal ids) is cut into chunks."""
    most = 2 * BLOCK_ROWS

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk, held, size = None, 0, [], 0

        def done() -> pa.RecordBatch:
            y, b, rid = (b"".join(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([own[0]], pa.int64()), pa.array([own[1]], pa.int64()), pa.array([chunk], pa.int32()),
                                               *(pa.array([x], pa.binary()) for x in (y, b, rid if ids else None))],
                                              ["grp", "block", "chunk", "y", "b", "rid"])

        for batch in batches:
            grp, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for lo, hi in zip(edges, edges[1:]):
                while lo < hi:
                    now = (int(grp[lo]), int(block[lo]))
                    if held and (now != own or size == most):
                        yield done()
                        chunk, held, size = chunk + 1 if now == own else 0, [], 0
                    own, end = now, min(hi, lo + most - size)
                    y, b = batch.column(2).slice(lo, end - lo).to_numpy(), batch.column(3).slice(lo, end - lo)
                    if pa.types.is_binary(b.type):
                        ends = np.frombuffer(b.buffers()[1], np.int32)[b.offset:b.offset + len(b) + 1]
                        packed = b.buffers()[2][int(ends[0]):int(ends[-1])].to_pybytes()
                    else:
                        packed = b.flatten().to_numpy().tobytes()
                    held.append((y.tobytes(), packed, batch.column(4).slice(lo, end - lo).to_numpy().tobytes() if ids else b""))
                    lo, size = end, size + end - lo
        if held:
            yield done()

    spread = (dealt.repartition(parts_for(dealt.sparkSession, n) or 1, "block").sortWithinPartitions("block", "rid", "y", "b")
              .select("grp", "block", "y", "b", "rid"))
    return reliable_checkpoint(spread.mapInArrow(gather, "grp long, block long, chunk int, y binary, b binary, rid binary"), "blocks")


#: Weight of each of 65536 equally likely draws: how often a sample with replacement takes a row.
_DRAWN = np.searchsorted(_DRAWS, (np.arange(1 << 16) + 0.5) / (1 << 16), "right").astype(np.float64)


def _lots(rounds: int, trees: int, tried: int, depth: int, bins: int, shares: int) -> list[range]:
    """The rounds, in lots whose forests a task can hold its share of the sums of."""
    lot = max(1, DENSE_CELLS * shares // (trees * tried * (bins + 1) << depth - 1))
    return [range(start, min(start + lot, rounds)) for start in range(0, rounds, lot)]


def shadow_gains(blocks: DataFrame, n_features: int, rounds: int, trees: int, depth: int, seed: int, bins: int = BINS) -> np.ndarray:
    """Gain of each feature, then of each one's shadow, in the forest of each round; a tree's gains sum to one, or to none.

    A node chooses among a third of all columns. Forests of as many rounds as a task can hold sums of grow together.
    """
    columns = 2 * n_features
    tried = columns if trees == 1 else -(-columns // 3)
    out, shares = np.zeros((rounds, columns)), _shares(blocks)
    for some in _lots(rounds, trees, tried, depth, bins, shares):
        gain = _forests(blocks, [0], some, trees, depth, seed, columns, tried, bins, shares)[0]
        whole = gain.sum(axis=1, keepdims=True)
        out[some.start:some.stop] = (gain / np.where(whole > 0, whole, 1)).reshape(len(some), trees, columns).sum(axis=1)
    return out


def _shares(blocks: DataFrame) -> int:
    """Tasks that read the same blocks and share the trees, where the blocks are few."""
    return max(1, blocks.sparkSession.sparkContext.defaultParallelism // max(1, blocks.rdd.getNumPartitions()))


def _forests(blocks: DataFrame, names: Sequence[int], rounds: range, trees: int, depth: int, seed: int, columns: int, tried: int,
             bins: int, shares: int) -> np.ndarray:
    """Gain of each column in each tree of the rounds' forests, by group; a node chooses among ``tried`` columns."""
    nodes, width, n = (1 << depth) - 1, bins + 1, len(rounds) * trees
    feature, cut = np.full((len(names), n, nodes), -1, np.int16), np.zeros((len(names), n, nodes), np.int16)
    order = np.concatenate([np.random.default_rng([seed, r]).random((trees, nodes, columns)).argsort(axis=2) for r in rounds])
    choice = np.sort(order[:, :, :tried], axis=2).astype(np.int16)
    gain = np.zeros((len(names), n, columns))
    mine = blocks.where(F.col("grp").between(names[0], names[-1]))
    share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))) if shares > 1 else F.lit(0)
    mine = mine.select("grp", "block", "chunk", "y", "b", "rid", share.alias("share"))
    if shares > 1:
        mine = mine.repartitionById(shares, "share")
    for level in range(depth):
        sent = blocks.sparkSession.sparkContext.broadcast((np.array(names, np.int64), feature, cut, choice))
        sums = mine.mapInArrow(_tally(sent, rounds, trees, level, nodes, width, seed, shares), SUMS)
        at, f, b, x = (c.to_numpy() for c in best_splits(sums).toArrow().columns)  # one row a node
        tree, node = np.divmod(at, nodes)
        group, tree = np.divmod(tree, n)
        feature[group, tree, node], cut[group, tree, node] = f, b
        np.add.at(gain, (group, tree, f), x)
    return gain


def _tally(sent, rounds: range, trees: int, level: int, nodes: int, width: int, seed: int, shares: int):
    """Sums of weights and weighted targets by group, tree, node of the level and tried column, over all blocks of a task.

    A task counts every ``shares``-th tree, from the number of its share on.
    """
    first, at_level, among = (1 << level) - 1, 1 << level, SHADOW_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, features, cuts, choice = sent.value
        n, tried, cells = features.shape[1], choice.shape[2], at_level * width
        total, own = np.zeros((2, -(-n // shares), tried, cells)), None

        def done() -> Iterator[pa.RecordBatch]:
            sums = total.reshape(2, -1, tried, at_level, width)
            kept, node = np.nonzero(sums[0, :, 0].any(axis=2))
            step = max(1, BUFFER_ROWS // (4 * tried))
            for lo in range(0, len(kept), step):
                k, v = kept[lo:lo + step], node[lo:lo + step]
                s, t = sums[:, k, :, v].transpose(0, 2, 1, 3), k * shares + own[1]  # by node and column
                yield _packed(np.repeat((own[0] * n + t) * nodes + first + v, tried), choice[t, first + v].ravel(), s.reshape(-1, 2, width))

        for batch in batches:
            for at in range(batch.num_rows):
                grp, block, chunk, y, b, rid, share = (batch.column(i)[at].as_py() for i in range(7))
                group = int(np.searchsorted(names, grp))
                if (group, share) != own:  # a task's blocks come by group
                    if own is not None:
                        yield from done()
                        total[:] = 0
                    own = (group, share)
                feature, cut = features[group], cuts[group]
                y = np.frombuffer(y)
                b = np.frombuffer(b, np.uint8).reshape(len(y), -1)
                rid = None if rid is None else np.frombuffer(rid, np.int64)
                for i, r in enumerate(rounds):
                    if rid is None:
                        other = np.random.default_rng([seed, r, block, chunk]).permutation(len(y))
                    else:
                        other = _shadow_rows(rid, seed + r, among)
                    both = np.concatenate([b, b[other]], axis=1)
                    bin_of, columns = both.ravel(), both.shape[1]
                    for tree in range(i * trees + (share - i * trees) % shares, (i + 1) * trees, shares):
                        if rid is None:
                            draw = np.random.default_rng([seed, r, block, chunk, tree - i * trees + 1])
                            w = _DRAWN[draw.integers(0, 1 << 16, len(y), np.uint16)]
                        else:
                            w = _weights(rid, tree - i * trees, seed + r)
                        live = np.flatnonzero(w)
                        w, s, row = w[live], y[live] * w[live], live * columns
                        node = np.zeros(len(live), np.int64)
                        for _ in range(level):
                            f = feature[tree, node]
                            if (f < 0).any():  # branches that have ended
                                on = f >= 0
                                f, w, s, row, node = f[on], w[on], s[on], row[on], node[on]
                            node = 2 * node + 1 + (bin_of[row + f] > cut[tree, node])
                        cell = (node - first) * width
                        for j in range(tried):
                            here = cell + bin_of[row + choice[tree, node, j]]
                            total[0, tree // shares, j] += np.bincount(here, w, cells)
                            total[1, tree // shares, j] += np.bincount(here, s, cells)
        if own is not None:
            yield from done()
    return run


def _binomial_tail(hits: int, n: int) -> float:
    """P(X >= hits) for n fair trials."""
    return sum(math.comb(n, k) for k in range(hits, n + 1)) / 2.0 ** n
