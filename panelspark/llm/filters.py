"""Bloom filter of 64-bit fingerprints, built by Spark in slices; at most ``MOST_BITS`` bits reach the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Bits per fingerprint, probes of one, bits of a slice, and the bound of a whole filter (32 MB).
KEY_BITS, PROBES, SLICE_BITS, MOST_BITS = 12, 4, 1 << 20, 1 << 28

#: Positions gathered by a task before it sends them on.
FLUSH = 1 << 21

_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _positions(prints: np.ndarray, log_bits: int) -> Iterator[np.ndarray]:
    for factor in _FACTORS[:PROBES]:
        yield (prints * np.uint64(factor)) >> np.uint64(64 - log_bits)


class Bloom:
    """Membership of fingerprints: never wrong for a member, sometimes true for another."""

    def __init__(self, data: Broadcast | None, log_bits: int):
        self.data, self.log_bits = data, log_bits

    def has(self, prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), bool)
        if self.data is None:
            return ~found
        bits = np.frombuffer(self.data.value, np.uint8)
        for at in _positions(prints, self.log_bits):
            found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def build(prints: DataFrame, column: str, most_bits: int = MOST_BITS, key_bits: int = KEY_BITS) -> Bloom:
    """Filter of a stored table's fingerprints (longs).

    Its size follows the row count up to ``most_bits``; beyond it more strangers pass, so that users must check
    what passes. Tasks send positions by slice; a slice is a fixed number of bits however many positions it gets.
    """
    n = prints.count()
    if n == 0:
        return Bloom(None, 0)
    log_bits = min(max(key_bits * n, 1 << 16).bit_length(), most_bits.bit_length() - 1)
    slice_log = min(SLICE_BITS.bit_length() - 1, log_bits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            at = np.unique(np.concatenate(held))
            cuts = np.flatnonzero(np.diff(at >> np.uint64(slice_log))) + 1
            parts = np.split(at, cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p[0]) >> slice_log for p in parts], pa.int32()),
                 pa.array([(p & np.uint64((1 << slice_log) - 1)).astype("<u4").tobytes() for p in parts], pa.binary())],
                ["slice", "places"])

        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in _positions(h, log_bits):
                held.append(np.unique(at))
                size += len(held[-1])
            if size > FLUSH:
                yield from send()
                held, size = [], 0
        if size:
            yield from send()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bits = None, None
        for b in batches:
            for name, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != own:
                    if own is not None:
                        yield _packed(own, bits)
                    own, bits = name, np.zeros(1 << slice_log, bool)
                bits[np.frombuffer(places, "<u4")] = True
        if own is not None:
            yield _packed(own, bits)

    slices = (prints.select(column).mapInArrow(place, "slice int, places binary").repartition("slice")
              .sortWithinPartitions("slice").mapInArrow(fill, "slice int, bits binary"))
    whole, width = bytearray(1 << (log_bits - 3)), 1 << (slice_log - 3)
    for r in slices.collect():  # at most most_bits in all
        whole[r["slice"] * width:(r["slice"] + 1) * width] = r["bits"]
    return Bloom(prints.sparkSession.sparkContext.broadcast(bytes(whole)), log_bits)


def _packed(name: int, bits: np.ndarray) -> pa.RecordBatch:
    data = np.packbits(bits, bitorder="little").tobytes()
    return pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), pa.array([data], pa.binary())], ["slice", "bits"])
