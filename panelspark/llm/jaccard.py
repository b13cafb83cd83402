"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its 4-word shingles, as 64-bit fingerprints (``shingles``). Shingles are ordered from rare to
frequent; in that order a set's prefix is just long enough that a set which is similar enough must share a signature
inside both prefixes. A rare shingle is a signature by itself. Frequent shingles fall into classes of two or three: their
signatures are pairs or triples of shingles from one group of the class, and the prefix is extended for what a group
loses (a group of c shingles with signatures of k stands for c - k + 1). Groups grow in number with the set, so that a
prefix holds a few combinations for each shingle that may be missing; sets are dealt to levels by size, those near a
border to both, so that two similar sets always use the same groups.

Sets that are equal are one node. Nodes are dealt to blocks by their least scrambled shingle, and two blocks that share a
signature make a tile, in which the sets concerned are compared with each other by a product of 0/1 matrices: pairs are
never rows, and a set travels once a tile. Blocks come alone first; signatures whose nodes are then one component are
done. A quarter of each set decides most comparisons, whole sets the rest. Texts are read again for each step, so no texts are shuffled, and sets only of
documents that share a signature.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.ordering import running_totals

from . import filters
from .common import lookup_join, stage
from .shingles import mix, text_blocks, words
from .simhash import components

# Words of a shingle and least similarity in percent
SHINGLE, PERCENT = 4, 85

#: Documents from which a shingle is frequent (signatures of two), and the factor to the next class (of three).
FREQUENT, NEXT_CLASS = 2, 128

#: Filter bits of a shared signature: a set has many signatures, and one stranger among them would keep it.
SHARED_BITS = 32

#: Frequent shingles kept at most; above, FREQUENT is doubled until they fit. This moves work, not results.
MOST_FREQUENT = 16_000_000

#: Shingles of a set per group of a class, by the size of the class's signatures.
GROUP_WIDTH = {2: 4, 3: 5}

#: Bits of a shingle's fingerprint by which documents are counted, bits of those that name a slice of the counters,
#: and counts gathered by a task before it sends them.
COUNT_BITS, SLICE_LOG, FLUSH = 32, 12, 1 << 21

#: Fingerprints from here on, a quarter of all, are compared first.
PART_FROM = np.uint64(3 << 62)

#: Shingles of a block and least weight of a set in it; columns of shared shingles multiplied at a time.
BLOCK_WEIGHT, LEAST_WEIGHT, COLUMNS = 1 << 18, 1 << 10, 4096


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct fingerprints of each text's shingles; a text with fewer words is one shingle, without words none."""
    w = words(column)
    n = len(column)
    counts = np.bincount(w.rows, minlength=n)
    first, prints = w.runs(size)
    rows = w.rows[first]
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        if len(short):
            at = np.searchsorted(w.rows, short)
            one, value = w.runs(k)
            rows = np.concatenate([rows, short])
            prints = np.concatenate([prints, value[np.searchsorted(one, at)]])
    order = np.argsort(rows, kind="stable")
    ends = np.searchsorted(rows[order], np.arange(1, n))
    return [np.unique(p) for p in np.split(prints[order], ends)]


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed longs."""
    h = xxhash.xxh3_128_intdigest(s.tobytes())
    return _signed(h >> 64), _signed(h & (1 << 64) - 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for b in text_blocks(batch, 0):
            yield b, shingle_sets(b.column(0), size)


def keyed(docs: DataFrame, size: int) -> DataFrame:
    """Stored rid, doc_id, n, k1, k2 of every row of text, doc_id."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for b, sets in _sets(batches, size):
            keys = np.array([set_key(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rid, rid + len(sets), dtype=np.int64)), b.column(1),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                ["rid", "doc_id", "n", "k1", "k2"])
            rid += len(sets)

    return stage(docs.select("text", "doc_id").mapInArrow(read, "rid long, doc_id long, n long, k1 long, k2 long"), "sets")


def frequencies(docs: DataFrame, size: int, least: int = FREQUENT) -> DataFrame:
    """Stored cell, level (log2 of the documents) of the cells of 2^32 that at least ``least`` documents share.

    A task sends the sorted cells of its shingles as compressed differences, by slice; a slice is added up in counters
    of a fixed number, however many documents there are.
    """
    low = np.uint32((1 << (COUNT_BITS - SLICE_LOG)) - 1)

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        cells = np.sort(np.concatenate(held))
        names = cells >> np.uint32(COUNT_BITS - SLICE_LOG)
        cuts = np.flatnonzero(np.diff(names)) + 1
        pack = zstandard.ZstdCompressor(level=1)
        slices, blobs = [], []
        for part in np.split(cells, cuts):
            slices.append(int(part[0]) >> (COUNT_BITS - SLICE_LOG))
            steps = np.diff(part & low, prepend=np.uint32(0)).astype("<u4")
            blobs.append(pack.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(blobs, pa.binary())], ["slice", "cells"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, sets in _sets(batches, size):
            held += [(s >> np.uint64(64 - COUNT_BITS)).astype(np.uint32) for s in sets]
            n += sum(map(len, sets))
            if n > FLUSH:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = None, None
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for name, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != own:
                    if own is not None:
                        yield _frequent(own, total, least)
                    own, total = name, np.zeros(int(low) + 1, np.int64)
                planes = np.frombuffer(unpack.decompress(blob), np.uint8).reshape(4, -1)
                cells = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)
                np.add.at(total, cells, 1)
        if own is not None:
            yield _frequent(own, total, least)

    counted = (docs.select("text").mapInArrow(gather, "slice int, cells binary").repartition("slice")
               .sortWithinPartitions("slice").mapInArrow(add, "cell long, level int"))
    return stage(counted, "frequent-shingles")


def _frequent(name: int, total: np.ndarray, least: int) -> pa.RecordBatch:
    at = np.flatnonzero(total >= least)
    cells = mix((np.uint64(name) << np.uint64(COUNT_BITS - SLICE_LOG)) + at.astype(np.uint64))
    levels = np.log2(total[at]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(cells.view(np.int64)), pa.array(levels)], ["cell", "level"])


class Classes:
    """Class of a shingle: 1 for rare ones, 2 and 3 by two filters of frequent cells.

    ``alone`` is true if every shingle of class 1 is in one document only: the filters hold all cells of two documents
    and more, and a filter never misses a member.
    """

    def __init__(self, twos: filters.Bloom, threes: filters.Bloom, alone: bool = False):
        self.twos, self.threes, self.alone = twos, threes, alone

    def of(self, prints: np.ndarray) -> np.ndarray:
        cells = mix(prints >> np.uint64(64 - COUNT_BITS))
        two = self.twos.has(cells)
        return 1 + two.astype(np.int8) + (two & self.threes.has(cells)).astype(np.int8)


def classes(cells: DataFrame, least: int, most: int = MOST_FREQUENT) -> Classes:
    """Filters of the frequent cells (of ``least`` documents); the least level rises until ``most`` cells remain."""
    by = {r.level: r.n for r in cells.groupBy("level").agg(F.count("*").alias("n")).collect()}  # at most 63 rows
    level = min(by, default=0)
    while sum(n for k, n in by.items() if k >= level) > most:
        level += 1
    step = NEXT_CLASS.bit_length() - 1
    return Classes(filters.build(cells.filter(F.col("level") >= level), "cell"),
                   filters.build(cells.filter(F.col("level") >= level + step), "cell"), least == 2 and level <= 1)


class Prefixes:
    """Signatures of sets for one similarity in percent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.base = next(n for n in range(1, 1 << 20) if n * 100 // percent > n)  # smaller sets link with equal ones only
        for n in range(self.base, 40 * self.base):
            for level in self.levels(n):
                lost = sum((k - 1) * self.groups(level, k) for k in GROUP_WIDTH)
                if n - lost < self.missing(n) + 1:
                    raise ValueError(f"groups of {GROUP_WIDTH} are too small for {percent} percent")

    def missing(self, n: int) -> int:
        """Shingles of a set of ``n`` that a similar set may lack."""
        return n - -(-n * self.percent // 100)

    def levels(self, n: int) -> range:
        """Level of a set by size, and that of the largest similar set."""
        return range((n // self.base).bit_length() - 1, (n * 100 // self.percent // self.base).bit_length())

    def groups(self, level: int, k: int) -> int:
        return max(1, (self.base << level) // GROUP_WIDTH[k])

    def signatures(self, s: np.ndarray, kind: np.ndarray, alone: bool = False) -> np.ndarray:
        """Signatures of a set with the classes of its shingles; none for sets that can only have equals.

        With ``alone``, rare shingles fill the prefix but are no signatures, as no other set has them.
        """
        n = len(s)
        if n < self.base:
            return np.zeros(0, np.uint64)
        need = self.missing(n) + 1
        out = []
        rare = s[kind == 1][:need]  # sorted by fingerprint: the same order in every set
        for level in self.levels(n):
            salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            out.append(mix((rare if not alone else rare[:0]) ^ salt))
            left = need - len(rare)
            for k in GROUP_WIDTH:
                if left <= 0:
                    break
                some = s[kind == k]
                group = (mix(some + np.uint64(k)) % np.uint64(self.groups(level, k))).astype(np.int64)
                order = np.argsort(group, kind="stable")
                some, group = some[order], group[order]
                # shingles of earlier groups stand for c - k + 1 each; the last group is cut where the prefix is enough
                size = np.bincount(group)
                full = np.cumsum(np.maximum(size - k + 1, 0))
                ends = np.cumsum(size)
                last = int(np.searchsorted(full, left))
                for g in np.flatnonzero(size[:last + 1] >= k).tolist():
                    part = some[ends[g] - size[g]:ends[g]]
                    if g == last:
                        part = part[:left - int(full[g] - max(size[g] - k + 1, 0)) + k - 1]
                    picks = np.array(list(combinations(range(len(part)), k)))
                    value = np.full(len(picks), salt + np.uint64(k))
                    for column in picks.T:
                        value = mix(value ^ part[column])
                    out.append(value)
                left -= int(full[-1]) if len(full) else 0
        return np.concatenate(out)


def signatures(docs: DataFrame, size: int, kinds: Classes, prefixes: Prefixes) -> DataFrame:
    """sig, k1 of every set, once a task for equal sets."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _sets(batches, size):
            flat = kinds.of(np.concatenate(sets)) if sets else np.zeros(0, np.int8)
            sigs, keys, at = [], [], 0
            for s in sets:
                kind, at = flat[at:at + len(s)], at + len(s)
                key = set_key(s)[0]
                if len(s) < prefixes.base or key in seen:
                    continue
                seen.add(key)
                sig = np.unique(prefixes.signatures(s, kind, kinds.alone))
                sigs.append(sig)
                keys.append(np.full(len(sig), key, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(keys))], ["sig", "k1"])

    return docs.select("text").mapInArrow(read, "sig long, k1 long")


def _owner(keys: np.ndarray, doc_ids: pa.Array) -> np.ndarray:
    """Fingerprints of (set, document id), which single out the row that speaks for a set."""
    ids = doc_ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return mix(mix(ids.view(np.uint64)) ^ keys.view(np.uint64))


def candidates(docs: DataFrame, nodes: DataFrame, size: int, kinds: Classes, prefixes: Prefixes, shared: DataFrame
               ) -> DataFrame:
    """Stored k1, k2, n, mark, part, rest, sigs of the sets with a shared signature, once a node.

    A set is kept as the bytes of its sorted fingerprints: ``part`` holds those in the highest quarter of all values,
    ``rest`` the others. ``mark`` is the least of its scrambled fingerprints, which similar sets mostly share.
    """
    may_share = filters.build(shared, "sig", key_bits=SHARED_BITS)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner = _owner(b.column(0).to_numpy(zero_copy_only=False), b.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(owner.view(np.int64))], ["owner"])

    owners = filters.build(stage(nodes.filter(F.col("n") >= prefixes.base).select("k1", "least").mapInArrow(
        name, "owner long"), "owners"), "owner")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b, sets in _sets(batches, size):
            if not sets:
                continue
            keys = [set_key(s) for s in sets]
            speaks = owners.has(_owner(np.array([k[0] for k in keys], np.int64), b.column(1)))
            flat, at = kinds.of(np.concatenate(sets)), 0
            k1, k2, n, mark, part, rest, sigs = [], [], [], [], [], [], []
            for i, s in enumerate(sets):
                kind, at = flat[at:at + len(s)], at + len(s)
                if not speaks[i] or len(s) < prefixes.base or keys[i] in seen:
                    continue
                seen.add(keys[i])
                sig = np.unique(prefixes.signatures(s, kind, kinds.alone))
                sig = sig[may_share.has(sig)]
                if len(sig):
                    cut = int(np.searchsorted(s, PART_FROM))
                    k1.append(keys[i][0])
                    k2.append(keys[i][1])
                    n.append(len(s))
                    mark.append(int(mix(s).min() >> np.uint64(1)))
                    part.append(s[cut:].tobytes())
                    rest.append(s[:cut].tobytes())
                    sigs.append(sig.view(np.int64))
            ends = np.cumsum([0, *map(len, sigs)])
            flat_sigs = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(n, pa.int64()), pa.array(mark, pa.int64()),
                 pa.array(part, pa.binary()), pa.array(rest, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat_sigs))],
                ["k1", "k2", "n", "mark", "part", "rest", "sigs"])

    return stage(docs.select("text", "doc_id").mapInArrow(
        read, "k1 long, k2 long, n long, mark long, part binary, rest binary, sigs array<long>"), "candidates")


def blocks(sets: DataFrame, index: DataFrame) -> DataFrame:
    """Stored k1, block: sets in an order in which similar ones mostly follow each other.

    A signature takes the least mark of its sets, and a set the mark that most of its signatures have: a group of
    similar sets agrees on one, though their own marks differ. A block holds 256 sets or 2^18 shingles, whichever comes
    first, and one set more at most.
    """
    keys = sets.select("k1", "mark", "n").groupBy("k1").agg(F.min("mark").alias("mark"), F.max("n").alias("n"))
    keys = stage(keys, "marks")
    least = index.join(keys.select("k1", "mark"), "k1").groupBy("sig").agg(F.min("mark").alias("home"))
    votes = index.join(least, "sig").groupBy("k1", "home").agg(F.count("*").alias("votes"))
    homes = votes.groupBy("k1").agg(F.max(F.struct("votes", "home")).alias("v")).select("k1", "v.home")
    rows = keys.join(homes, "k1").select(F.struct("home", "mark", "k1").alias("place"),
                                         F.greatest("n", F.lit(LEAST_WEIGHT)).alias("w"))
    return stage(running_totals(rows, "place", ["w"]).select(
        "place.k1", F.floor(F.col("w_before") / BLOCK_WEIGHT).alias("block")), "blocks")


def _meetings(rest: DataFrame) -> DataFrame:
    """a, b, k1: the tiles of a set, made of its block and every other block that one of its signatures reaches.

    A signature hands on its blocks as one list, and the lists of a set are united while its rows stream by.
    """
    reach = rest.groupBy("sig").agg(F.collect_set("block").alias("blocks"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block, held = None, 0, []

        def send() -> pa.RecordBatch:
            other = np.unique(np.concatenate(held))
            other = other[other != block]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(other, block)), pa.array(np.maximum(other, block)),
                 pa.array(np.full(len(other), own, np.int64))], ["a", "b", "k1"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if keys[lo] != own:
                    if own is not None:
                        yield send()
                    own, block, held = int(keys[lo]), int(at[lo]), []
                held.append(np.unique(flat[lists[lo]:lists[hi]]))
        if own is not None:
            yield send()

    rows = rest.join(reach, "sig").select("k1", "block", "blocks").repartition("k1").sortWithinPartitions("k1")
    return rows.mapInArrow(unite, "a long, b long, k1 long")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    row, token = row[shared], (np.cumsum(count > 1) - 1)[token[shared]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    out = np.zeros((n, n), np.float32)  # counts stay far below 2^24, so they are exact
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
        lo, hi = np.searchsorted(token, [first, first + COLUMNS])
        m = np.zeros((n, COLUMNS), np.float32)
        m[row[lo:hi], token[lo:hi] - first] = 1
        out += m @ m.T
    return out.astype(np.int64)


def _tiles(rows: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """Compare all sets of a tile: rows a, b, k1, k2, n, prints (b last), sorted into tiles by Spark.

    With ``spanning``, returns a1, a2, b1, b2 of links that connect what is connected in the tile. Otherwise ``prints`` is
    part of a set, and what returns is a, b, k1, k2 of the sets that may have a similar one here, if all that was left out
    were common as far as the sizes allow.
    """
    def compare(tile: tuple[int, int], keys: list[tuple[int, int]], n: list[int], sets: list[np.ndarray]) -> Iterator[tuple]:
        if len(sets) < 2:
            return
        size, left = np.array(n, np.int64), np.array(n, np.int64) - [len(s) for s in sets]
        most = _overlaps(sets) + np.minimum(left[:, None], left[None, :])
        near = 100 * most >= percent * (size[:, None] + size[None, :] - most)
        np.fill_diagonal(near, False)
        if not spanning:
            yield from ((*tile, *keys[i]) for i in np.flatnonzero(near.any(axis=1)).tolist())
            return
        todo = set(range(len(sets)))
        while todo:
            wave = [todo.pop()]
            while wave:
                at = wave.pop()
                for j in np.flatnonzero(near[at]).tolist():
                    if j in todo:
                        todo.remove(j)
                        wave.append(j)
                        yield (*keys[at], *keys[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, keys, n, sets = None, [], [], []
        for batch in batches:
            out: list[tuple] = []
            a, b, k1, k2, size = (batch.column(i).to_pylist() for i in range(5))
            for i, data in enumerate(batch.column(5)):
                if (a[i], b[i]) != tile:
                    if tile is not None:
                        out += compare(tile, keys, n, sets)
                    tile, keys, n, sets = (a[i], b[i]), [], [], []
                if (k1[i], k2[i]) not in keys[-1:]:  # sorted: a set that came twice stands side by side
                    keys.append((k1[i], k2[i]))
                    n.append(size[i])
                    sets.append(np.frombuffer(data.as_py(), np.uint64))
            yield _four(out, names)
        if tile is not None:
            yield _four(list(compare(tile, keys, n, sets)), names)

    names = ["a1", "a2", "b1", "b2"] if spanning else ["a", "b", "k1", "k2"]
    dealt = (rows.select("a", "b", "k1", "k2", "n", "prints").repartition("a", "b")
             .sortWithinPartitions("a", "b", "k1", "k2"))
    return stage(dealt.mapInArrow(run, ", ".join(f"{x} long" for x in names)), "tiles")


def _four(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names)


def linked(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Stored a1, a2, b1, b2: links between similar sets that meet in a tile; ``members`` has a, b, k1.

    A quarter of each set comes first; whole sets travel only where that leaves a partner possible.
    """
    members = stage(members, "members")
    part = members.join(sets.select("k1", "k2", "n", F.col("part").alias("prints")), "k1")
    some = _tiles(part, percent, spanning=False)
    whole = some.join(sets.select("k1", "k2", "n", F.concat("rest", "part").alias("prints")), ["k1", "k2"])
    return _tiles(whole, percent, spanning=True)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                      percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id per row.

    Texts without words and NULL texts have no shingles and are linked with nothing: their component is their own id.
    component_id is the smallest id reachable; NULL ids never count (NULL if there is no other). Repeated rows stay
    separate, ties and other columns do not matter, an empty table gives no rows, and texts are taken whole at any
    length. Shingles are compared by 64-bit fingerprints, sets are named by 128 bits.
    """
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    rows = keyed(docs, size)
    nodes = stage(rows.filter("n > 0").groupBy("k1", "k2").agg(
        F.min("rid").alias("node"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.count("*").alias("many")), "nodes")
    found = _links(docs, nodes, size, Prefixes(percent), frequent)
    labels = components(stage(found, "links"))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"), F.sum("many").alias("members"))
    # only rows with company meet the table of names
    shared = stage(named.join(least.filter("members > 1"), "label").select("k1", "k2", "component_id", F.lit(True).alias("with")),
                   "shared-names")
    out = lookup_join(rows, shared, ["k1", "k2"])
    own = F.when(F.col("with") & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _links(docs: DataFrame, nodes: DataFrame, size: int, prefixes: Prefixes, frequent: int) -> DataFrame:
    """Links a, b between nodes: enough of them to connect all that are connected."""
    kinds = classes(frequencies(docs, size, frequent), frequent)
    ends = signatures(docs, size, kinds, prefixes).groupBy("sig").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"))
    shared = stage(ends.filter("lo < hi").select("sig"), "shared-signatures")
    if shared.limit(1).count() == 0:
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    sets = candidates(docs, nodes, size, kinds, prefixes, shared)
    index = stage(sets.select("k1", F.explode("sigs").alias("sig")).join(shared, "sig").select("sig", "k1").distinct(),
                  "shared-index")

    def ids(links: DataFrame) -> DataFrame:
        a = nodes.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("node").alias("a"))
        b = nodes.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("node").alias("b"))
        return links.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("a", "b")

    # first every block by itself: what is alike is mostly there
    where = stage(index.join(blocks(sets, index), "k1").select("sig", "k1", "block"), "index")
    own = where.select(F.col("block").alias("a"), F.col("block").alias("b"), "k1").distinct()
    near = stage(ids(linked(sets, own, prefixes.percent)), "block-links")
    labels = components(near)
    known = nodes.join(labels, "node", "left").groupBy("k1").agg(F.min(F.coalesce("label", "node")).alias("label"))
    # then, for signatures that still join several components, the blocks of one signature meet each other
    where = stage(where.join(known, "k1").select("sig", "k1", "block", "label"), "labelled-index")
    open_ = where.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("sig")
    rest = stage(where.join(open_, "sig").select("sig", "k1", "block"), "open-index")
    met = _meetings(rest)
    return near.unionByName(stage(ids(linked(sets, met, prefixes.percent)), "tile-links"))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT rid, s FROM (SELECT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM t)),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
o AS (SELECT a.rid AS a, b.rid AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL),
link AS (SELECT a, b FROM o JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach AS (SELECT rid AS a, rid AS b FROM t UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM t LEFT JOIN n ON n.rid = t.rid
JOIN (SELECT r.a, min(u.doc_id) AS component_id FROM reach r JOIN t u ON u.rid = r.b GROUP BY r.a) c ON c.a = t.rid
"""
