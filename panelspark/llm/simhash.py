"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits are cut into two segments of 32 bits. Two fingerprints within two bits either differ by at most
one bit in the high segment, or agree in the low one. Each fingerprint therefore looks up the high table at the ball of
radius one around its high segment (only the flips of set bits: the partner makes the others) and the low table at
radius zero; whole distances are then checked. Where more than ``HOT_BUCKET`` fingerprints share a segment, the lookup
enumerates the ball of the other segment too and asks for whole fingerprints, so candidates grow with the rows and not
with the square of a bucket. Equal fingerprints are one node. Components come from rounds of minimum labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lookup_join, packed, stage, text_bytes

#: Words of a shingle, seed of its hash, bits by which linked fingerprints differ at most.
SHINGLE, SEED, RADIUS = 3, 42, 2

#: Fingerprints of a segment value up to which they are compared one by one; above, whole fingerprints are looked up.
HOT_BUCKET = 64

#: Bits of a row's number inside its task, as Spark gives them out.
ROW_BITS = 33

#: Bytes of the bitmaps of kept rows up to which they are sent to the tasks.
BITMAP_BYTES = 1 << 26

#: Shingles hashed in one step; bounds the memory of a very long text.
STEP = 65_536


def fingerprint(data: bytes) -> int:
    """Fingerprint of one text's UTF-8 bytes; 0 for a text without words."""
    words = data.lower().split()  # on bytes: lower-cases A-Z only, splits at ASCII white space
    n = len(words) - SHINGLE + 1
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, max(n, 1), STEP):
        some = words[at:at + STEP + SHINGLE - 1]
        parts = list(zip(*[some[k:] for k in range(SHINGLE)])) if n > 0 else [words]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in parts], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > max(n, 1)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with _rid (a number of the row) and _fp (the fingerprint as a signed number). No shuffle.

    Store the result before using _rid, which depends on how the input is split.
    """
    names, place = docs.columns, docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            fps = np.array([fingerprint(d) for d in text_bytes(b.column(place))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.arange(rid, rid + b.num_rows, dtype=np.int64)), pa.array(fps, pa.int64())],
                [*names, "_rid", "_fp"])
            rid += b.num_rows

    kinds = T.StructType([*docs.schema.fields, T.StructField("_rid", T.LongType()), T.StructField("_fp", T.LongType())])
    return docs.mapInArrow(add, kinds)


def print_of(text: Column) -> Column:
    """Fingerprint of a text column as a signed number; other columns of the row stay in the JVM."""
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(d) for d in text_bytes(texts)], np.uint64).view(np.int64), pa.int64())

    return fingerprints(text)


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).between(1, RADIUS)


def _ball(shift: int, radius: int) -> Column:
    """All masks of 1 to ``radius`` bits inside the 32 bits from ``shift``, as an array of longs."""
    one = [1 << (shift + i) for i in range(32)]
    masks = one + ([a | b for i, a in enumerate(one) for b in one[:i]] if radius > 1 else [])
    return F.array(*[F.lit(m - (1 << 64) if m >= 1 << 63 else m).cast("long") for m in masks])


def links(prints: DataFrame) -> DataFrame:
    """Pairs a < b of stored distinct fingerprints (column fp) that differ by one or two bits, each pair once."""
    spread = F.explode(F.array(F.struct(F.lit(0).alias("seg"), _high(F.col("fp")).alias("key")),
                               F.struct(F.lit(1).alias("seg"), _low(F.col("fp")).alias("key"))))
    index = prints.select("fp", spread.alias("k")).select("fp", "k.seg", "k.key")
    hot = stage(index.groupBy("seg", "key").count().filter(F.col("count") > HOT_BUCKET)
                .select("seg", "key", F.lit(True).alias("hot")), "hot-segments")
    index = lookup_join(index, hot, ["seg", "key"])
    high = _high(F.col("fp"))
    flips = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(
        F.lit(0).alias("seg"), high.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)).alias("key"),
        F.lit(1).alias("used"))), lambda x: x["key"] < high)
    own = F.array(F.struct(F.lit(0).alias("seg"), high.alias("key"), F.lit(0).alias("used")),
                  F.struct(F.lit(1).alias("seg"), _low(F.col("fp")).alias("key"), F.lit(0).alias("used")))
    probes = prints.select("fp", F.explode(F.concat(own, flips)).alias("k")).select("fp", "k.seg", "k.key", "k.used")
    probes = lookup_join(probes, hot, ["seg", "key"])
    # the same bucket is met by both partners (used = 0): the smaller fingerprint asks; agreeing high segments are seg 0's
    cold = (probes.filter("hot IS NULL").select("fp", "seg", "key", "used")
            .join(index.filter("hot IS NULL").select(F.col("fp").alias("other"), "seg", "key"), ["seg", "key"])
            .filter(_near(F.col("fp"), F.col("other")) & ((F.col("used") == 1) | (F.col("fp") < F.col("other"))))
            .filter((F.col("seg") == 0) | (F.bit_count(_high(F.col("fp")).bitwiseXOR(_high(F.col("other")))) == 2)))
    # hot buckets: the whole fingerprints that may be there
    there = (F.when(F.col("seg") == 1, F.col("fp"))
             .otherwise(F.shiftleft("key", 32).bitwiseOR(_low(F.col("fp")))))
    masks = (F.when(F.col("seg") == 1, _ball(32, 2)).when(F.col("used") == 0, _ball(0, 2))
             .otherwise(F.concat(F.array(F.lit(0).cast("long")), _ball(0, 1))))
    asked = (probes.filter("hot").select("fp", "seg", "used", there.alias("there"), F.explode(masks).alias("m"))
             .filter((F.col("seg") == 0) | (F.bit_count("m") == 2))
             .select("fp", "used", F.col("there").bitwiseXOR(F.col("m")).alias("other"))
             .filter((F.col("used") == 1) | (F.col("fp") < F.col("other"))))
    warm = asked.join(prints.select(F.col("fp").alias("other")), "other")
    both = cold.select("fp", "other").unionByName(warm.select("fp", "other"))
    return both.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """node and label (smallest node reachable) of stored pairs a, b.

    A round gives each node, and its label's node, the smallest label among the neighbours, then follows the label
    once. A node has at most 2080 neighbours (the ball of radius two), so no node's edges are an unbounded group. Each
    round is written to the shared folder; rounds end when no label changes.
    """
    ways = stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                 .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "ways")
    labels = stage(ways.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        seen = ways.join(labels.select(F.col("node").alias("v"), F.col("label").alias("to")), "v")
        least = seen.groupBy(F.col("u").alias("node")).agg(F.min("to").alias("to"))
        own = labels.join(least, "node", "left").select(
            "node", "label", F.least("label", F.coalesce("to", "label")).alias("to"))
        offers = own.select(F.explode(F.array(
            F.struct("node", F.col("to")), F.struct(F.col("label").alias("node"), F.col("to")))).alias("o")).select("o.*")
        hooked = stage(offers.groupBy("node").agg(F.min("to").alias("label")), "hooked")
        jump = hooked.join(hooked.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
        after = stage(jump.select("node", F.coalesce("next", "label").alias("label")), "labels")
        moved = after.join(labels.withColumnRenamed("label", "was"), "node").filter("label <> was").limit(1).count()
        labels = after
        if not moved:
            return labels


def classes(rows: DataFrame) -> DataFrame:
    """fp and class (a fingerprint that names the component) of every distinct _fp of a stored table."""
    prints = stage(rows.select(F.col("_fp").alias("fp")).distinct(), "prints")
    found = components(stage(links(prints), "links"))
    return prints.join(found, prints.fp == found.node, "left").select("fp", F.coalesce("label", "fp").alias("class"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id per row.

    NULL and empty texts and texts of white space have fingerprint zero and are linked like others. component_id is the
    smallest id reachable; NULL ids never count (NULL if there is no other). Repeated rows stay separate; other columns
    are ignored; an empty table gives no rows.
    """
    rows = stage(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
                 .drop("text"), "fingerprints")
    kinds = stage(classes(rows), "classes")
    least = rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("doc_id").alias("least")).join(kinds, "fp")
    least = stage(least, "least")
    names = least.join(least.groupBy("class").agg(F.min("least").alias("component_id")), "class").select(
        F.col("fp").alias("_fp"), "component_id")
    return rows.join(names, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component with its columns as they were: the smallest id (NULL last), then the first row.

    Input columns may have any names. Rows that are kept are numbered in bitmaps, one per task that wrote the rows, so
    whole rows are not shuffled as long as the bitmaps are small enough to send.
    """
    rows = stage(packed(docs, text_col).select("row", F.monotonically_increasing_id().alias("_rid"),
                                               print_of(F.col(text_col)).alias("_fp")), "with-fingerprints")
    narrow = rows.select("_rid", "_fp", F.col("row")[id_col].alias("id"))
    kinds = stage(classes(narrow.select("_fp")), "classes")
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col("_rid").alias("rid"))
    best = narrow.groupBy(F.col("_fp").alias("fp")).agg(F.min(order).alias("best")).join(kinds, "fp")
    keep = stage(best.groupBy("class").agg(F.min("best").alias("best")).select(F.col("best.rid").alias("_rid")), "kept")
    maps = stage(_bitmaps(keep), "bitmaps")
    size = maps.agg(F.sum(F.octet_length("bits")).alias("b")).first()["b"] or 0
    if size > BITMAP_BYTES:
        return rows.join(keep, "_rid", "left_semi").select("row.*")
    nth = F.col("_rid").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(nth / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumn("_w", F.shiftright("_rid", ROW_BITS)).join(F.broadcast(maps), "_w")
    return marked.filter(F.call_function("shiftright", byte, (nth % 8).cast("int")).bitwiseAND(F.lit(1)) == 1).select("row.*")


def _bitmaps(keep: DataFrame) -> DataFrame:
    """_w (the task that numbered the rows) and bits, one bit for each of its rows up to the last that is kept."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = None, []
        for b in batches:
            rid = b.column(1).to_numpy(zero_copy_only=False)
            task, nth = rid >> ROW_BITS, rid & ((1 << ROW_BITS) - 1)
            cuts = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), len(task)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                if task[lo] != own:
                    if own is not None:
                        yield _bits(own, at)
                    own, at = int(task[lo]), []
                at.append(nth[lo:hi])
        if own is not None:
            yield _bits(own, at)

    return (keep.select(F.shiftright("_rid", ROW_BITS).alias("_w"), "_rid").repartition("_w").sortWithinPartitions("_w")
            .mapInArrow(fill, "_w long, bits binary"))


def _bits(task: int, at: list[np.ndarray]) -> pa.RecordBatch:
    nth = np.concatenate(at)
    flags = np.zeros(int(nth.max()) + 1, bool)
    flags[nth] = True
    return pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array(
        [np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["_w", "bits"])
