"""Best-fit packing of documents into sequences of at most ``capacity`` tokens, by a tree of residual bins.

Round 0: pieces are dealt at random into groups of about ``group_items`` and packed best-fit decreasing inside each.
Bins with at most ``slack`` free tokens are emitted. Rounds 1 to n: the underfull bins of ``fan_in`` groups meet as
items and are packed best-fit again, until one group is left. In a round an underfull bin is emitted if it is nearly
full, or if it is more than half full and no other bin of the round fitted it. After best-fit at most one bin of a
group is half full or less, so a round's tasks get few rows whatever the sizes are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stage
from .encoding import encoder

PIECES = "slot long, doc_id long, piece int, start long, length long, ids_crc32 long"
_INDEX_BITS = 20


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    Open bins are kept by free space; the bits of one integer say which spaces exist, so the tightest fit is the lowest
    set bit at or above the item's size. Equal sizes keep their order.
    """
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    fill: list[int] = []
    by_space: dict[int, list[int]] = {}
    spaces = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        fits = spaces >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                spaces &= ~(1 << space)
        else:
            b, space = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        by_space.setdefault(space - size, []).append(b)
        spaces |= 1 << (space - size)
    return bins, offsets, fill


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each document's ids and the end id; no shuffle.

    A NULL text is empty (its piece is the end id alone); repeated rows each give their own pieces.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, slot = int(end_id).to_bytes(4, "little"), TaskContext.get().partitionId() << 36
        for b in batches:
            out = {k: [] for k in ("slot", "doc_id", "piece", "start", "length", "ids_crc32")}
            texts = (t.as_py() for t in b.column(1))
            for doc, ids in zip(b.column(0).to_pylist(), encoder(tokenizer).encode_many(texts)):
                data = ids + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    ids = data[at:at + 4 * capacity]
                    for k, v in zip(out, (slot, doc, piece, at // 4, len(ids) // 4, zlib.crc32(ids))):
                        out[k].append(v)
                    slot += 1
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = 2048, group_items: int = 16_384, slack: int = 8,
         fan_in: int = 8) -> DataFrame:
    """Give every stored piece (see :func:`token_pieces`) a sequence and an offset.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Sequences have no gaps. Pieces of full length
    are sequences of their own (negative numbers). An empty table gives no rows.
    """
    open_pieces = pieces.filter(F.col("length") < capacity)
    n_groups = max(1, -(-open_pieces.count() // group_items))
    if group_items * 4 >= 1 << _INDEX_BITS:
        raise ValueError("group_items is too large for the numbering of bins")

    def first_round(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", kind="stable")
        bins, offsets, fill = best_fit(pdf["length"].to_numpy(), capacity)
        pdf["bin"] = (pdf["_group"].to_numpy() << _INDEX_BITS) + bins
        pdf["offset"] = offsets
        pdf["fill"] = np.array(fill, np.int64)[bins]
        return pdf

    grouped = open_pieces.withColumn("_group", F.pmod(F.xxhash64("slot"), F.lit(n_groups)))
    packed = stage(grouped.groupBy("_group").applyInPandas(
        first_round, PIECES + ", _group long, bin long, offset long, fill long"), "packed")
    rest = (packed.filter((F.col("fill") < capacity - slack) & (F.col("offset") == 0))
            .select("bin", F.col("bin").alias("host"), F.lit(0).cast("long").alias("base"),
                    F.col("fill").alias("host_fill"), "_group", F.lit(False).alias("done")))
    columns = "bin long, host long, base long, host_fill long, _group long, done boolean"

    def merge_round(pdf: pd.DataFrame, last: bool) -> pd.DataFrame:
        pdf = pdf.sort_values(["host", "base"], kind="stable")
        hosts, first, which = np.unique(pdf["host"].to_numpy(), return_index=True, return_inverse=True)
        bins, offsets, fill = best_fit(pdf["host_fill"].to_numpy()[first], capacity)
        total = np.array(fill, np.int64)[bins]
        lead = np.zeros(len(fill), np.int64)
        lead[bins[offsets == 0]] = hosts[offsets == 0]
        alone = np.bincount(bins, minlength=len(fill))[bins] == 1
        done = (total >= capacity - slack) | (alone & (2 * total > capacity)) | last
        pdf["base"] = pdf["base"].to_numpy() + offsets[which]
        pdf["host"], pdf["host_fill"], pdf["done"] = lead[bins][which], total[which], done[which]
        return pdf

    def merger(last: bool):
        return lambda pdf: merge_round(pdf, last)  # one argument: with two, Spark would pass the key first

    finals, groups = [], n_groups
    while groups > 1:
        groups = -(-groups // fan_in)
        last = groups == 1
        level = stage(rest.withColumn("_group", F.floor(F.col("_group") / fan_in)).groupBy("_group").applyInPandas(
            merger(last), columns), "merged")
        finals.append(level.filter("done"))
        rest = level.filter("NOT done")
    out = packed
    if finals:
        moved = finals[0]
        for f in finals[1:]:
            moved = moved.unionByName(f)
        out = lookup_join(packed, moved.select("bin", "host", "base"), ["bin"])
    else:
        out = packed.withColumns({"host": F.lit(None).cast("long"), "base": F.lit(None).cast("long")})
    done = ["doc_id", "piece", "start", "length", "ids_crc32"]
    small = out.select(*done, F.coalesce("host", "bin").alias("sequence_id"),
                       (F.coalesce("base", F.lit(0)) + F.col("offset")).alias("offset"))
    full = pieces.filter(F.col("length") >= capacity).select(
        *done, (-1 - F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return small.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, **options) -> DataFrame:
    """Cut whole documents to pieces, store them, and pack them."""
    return pack(stage(token_pieces(docs, tokenizer, capacity), "pieces"), capacity, **options)
