"""Token ids on disk: one zstandard frame per document, a shared dictionary, and an offset index.

A store is a folder with two Parquet tables, so that any store Spark reaches will do:

* ``dictionary``: one row with the zstandard dictionary, its SHA-256 and the width of an id in bytes;
* ``segments``: rows of up to ``segment_docs`` documents in ascending id order. ``frames`` holds their frames one after
  the other, ``frame_ends`` is the offset index, ``part`` and ``rel_start`` give the place in the order of all ids.

The first and last id of a segment are Parquet statistics, so looking up a few documents reads a few row groups and
decompresses only the wanted frames.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encoding import encoder

SEGMENTS = ("part long, first_doc long, last_doc long, rel_start long, n_tokens long, doc_ids array<long>, "
            "doc_tokens array<long>, frame_ends array<long>, frames binary, dict_hash string")
DECODED = "doc_id long, part long, rel_start long, n_tokens long, ids_crc32 long, dict_hash string"

#: Bytes of ids of one sampled document that dictionary training looks at.
TRAIN_BYTES = 65_536


#: Characters of a text by which rows of one id are dealt to ranges.
OPENING = 16


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids


def _wide(data: bytes, width: int) -> bytes:
    return np.frombuffer(data, "<u2").astype("<u4").tobytes() if width == 2 else data


def id_width(tokenizer: str) -> int:
    """Two bytes if every id of the vocabulary fits, else four."""
    return 2 if encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True) <= 65_536 else 4


def _document_ids(text: str | None, tokenizer: str, end_id: int) -> bytes:
    return encoder(tokenizer).encode(text or "") + int(end_id).to_bytes(4, "little")


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int, dict_bytes: int, sample: int) -> bytes:
    """A zstandard dictionary from the ``sample`` documents with the smallest hashed ids.

    Only compression depends on it, no result does. Training runs in one task on at most ``TRAIN_BYTES`` bytes of each
    sampled document; a sample too small to train on gives an empty dictionary.
    """
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for b in batches:
            for text in b.column(0).to_pylist():
                samples.append(_narrow(_document_ids(text, tokenizer, end_id), width)[:TRAIN_BYTES])
        try:
            data = zstandard.train_dictionary(dict_bytes, samples).as_bytes() if len(samples) > 7 else b""
        except zstandard.ZstdError:
            data = b""
        yield pa.RecordBatch.from_pydict({"data": pa.array([data], pa.binary())})

    rows = (docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("text")
            .mapInArrow(train, "data binary").collect())
    return max((bytes(r.data) for r in rows), default=b"")


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
          dict_bytes: int = 65_536, sample: int = 512, segment_docs: int = 256, segment_bytes: int = 1 << 20,
          level: int = 3) -> None:
    """Encode whole texts and write a store.

    Each document's ids are followed by ``end_id``. A NULL text is empty. Repeated ids stay separate rows, ordered by
    text. A NULL id sorts first. Other columns are ignored. An empty table gives an empty store.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    width = id_width(tokenizer)
    dictionary = train_dictionary(docs, tokenizer, end_id, width, dict_bytes, sample)
    digest = hashlib.sha256(dictionary).hexdigest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True)
        part, before, end = TaskContext.get().partitionId(), 0, int(end_id).to_bytes(4, "little")
        ids, tokens, frames = [], [], []

        def segment() -> pa.RecordBatch:
            known = [i for i in ids if i is not None]
            row = {"part": part, "first_doc": min(known, default=None), "last_doc": max(known, default=None),
                   "rel_start": before, "n_tokens": sum(tokens), "doc_ids": list(ids), "doc_tokens": list(tokens),
                   "frame_ends": np.cumsum([len(f) for f in frames]).tolist(), "frames": b"".join(frames),
                   "dict_hash": digest}
            kinds = {"doc_ids": pa.list_(pa.int64()), "doc_tokens": pa.list_(pa.int64()),
                     "frame_ends": pa.list_(pa.int64()), "frames": pa.binary(), "dict_hash": pa.string()}
            return pa.RecordBatch.from_pydict({k: pa.array([v], kinds.get(k, pa.int64())) for k, v in row.items()})

        size = 0
        for b in batches:
            texts = (t.as_py() for t in b.column(1))
            for doc, known in zip(b.column(0).to_pylist(), encoder(tokenizer).encode_many(texts)):
                data = known + end
                frame = packer.compress(_narrow(data, width))
                ids.append(doc)
                tokens.append(len(data) // 4)
                frames.append(frame)
                size += len(frame)
                if len(ids) >= segment_docs or size >= segment_bytes:
                    yield segment()
                    before += sum(tokens)
                    ids, tokens, frames, size = [], [], [], 0
        if ids:
            yield segment()

    spark = docs.sparkSession
    # as many ranges as the scan has parts, so that a task's share does not grow with the table; the opening of a text
    # splits the rows of one id where very many have it, in the order that they are sorted by anyway
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    dealt = docs.repartitionByRange(ranges, F.col("doc_id"), F.substring("text", 1, OPENING))
    (dealt.sortWithinPartitions("doc_id", "text").mapInArrow(encode, SEGMENTS)
     .write.option("compression", "none").parquet(f"{path}/segments"))
    (spark.createDataFrame([(digest, width, bytearray(dictionary))], "dict_hash string, width int, data binary")
     .coalesce(1).write.parquet(f"{path}/dictionary"))


def _decoded(spark: SparkSession, path: str, wanted: list[int] | None, schema: str, with_ids: bool) -> DataFrame:
    kept = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, width, digest = bytes(kept.data), kept.width, kept.dict_hash
    if hashlib.sha256(dictionary).hexdigest() != digest:
        raise ValueError("the dictionary does not match its hash")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpacker = zstandard.ZstdDecompressor(dict_data=shared)
        want = None if wanted is None else set(wanted)
        for b in batches:
            for row in b.to_pylist():
                if row["dict_hash"] != digest:
                    raise ValueError(f"segment of dictionary {row['dict_hash']}, the store has {digest}")
                out = {k: [] for k in ("doc_id", "part", "rel_start", "n_tokens", "ids_crc32", "dict_hash", "ids")}
                at, start, frames = row["rel_start"], 0, memoryview(row["frames"])
                for doc, n, end in zip(row["doc_ids"], row["doc_tokens"], row["frame_ends"]):
                    if want is None or doc in want:
                        data = _wide(unpacker.decompress(frames[start:end]), width)
                        one = (doc, row["part"], at, len(data) // 4, zlib.crc32(data), digest)
                        for k, v in zip(out, one):
                            out[k].append(v)
                        if with_ids:
                            out["ids"].append(np.frombuffer(data, "<u4"))
                    at, start = at + n, end
                cols = {k: pa.array(v, pa.string() if k == "dict_hash" else pa.int64())
                        for k, v in out.items() if k != "ids"}
                if with_ids:
                    cols["ids"] = pa.array(out["ids"], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(cols)

    segments = spark.read.parquet(f"{path}/segments")
    if wanted is not None:
        hit = F.lit(False)
        for i in sorted(set(wanted)):
            hit = hit | ((F.col("first_doc") <= i) & (F.col("last_doc") >= i))
        segments = segments.filter(hit)
    return segments.mapInArrow(decode, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store: id, start in the order of all ids, length, crc32 of its ids, dictionary hash.

    Starts are sums over parts plus the place inside the part. There are at most as many parts as the store's writer
    had shuffle partitions, which bounds the broadcast table of part starts.
    """
    parts = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    docs = _decoded(spark, path, None, DECODED, False)
    return (docs.join(F.broadcast(starts), docs.part == starts._part)
            .select("doc_id", (F.col("_base") + F.col("rel_start")).alias("start"), "n_tokens", "ids_crc32",
                    "dict_hash"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of a few documents; only segments that can hold them are read and only their frames unpacked."""
    return (_decoded(spark, path, list(doc_ids), DECODED + ", ids array<long>", True)
            .select("doc_id", "n_tokens", "ids_crc32", "ids"))
