"""Words and word runs of whole texts as 64-bit polynomial fingerprints, in numpy.

The bytes of many texts lie in one buffer. A prefix sum of byte * BASE^i modulo 2^64 gives the polynomial of any word
as one difference, moved to exponent zero by the inverse power; a second prefix sum over mixed word fingerprints gives
those of runs of words in the same way. Nothing loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bases of the two polynomials: odd, so that they have inverses modulo 2^64.
BASE, RUN_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95

#: Bytes of text taken in one step; only a single longer word makes a step longer.
STEP = 1 << 19

SPACE = b" \t\n\v\f\r"


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (shifts and odd factors)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next call."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        row = np.full(max(n, 1 << 12), base, np.uint64)
        row[0] = 1
        _POWERS[base] = known = np.multiply.accumulate(row)
    return known[:n]


def run_values(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomials of terms[start:end] for each pair of positions, by one prefix sum."""
    prefix = np.zeros(len(terms) + 1, np.uint64)
    np.cumsum(terms * powers(base, len(terms)), out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * powers(pow(base, -1, 1 << 64), len(terms) + 1)[starts]


_CLASSES: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _classes(space: bytes, stop: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lookup tables by byte: its lower case, whether it is outside words, whether it ends a piece."""
    if (space, stop) not in _CLASSES:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        outside, ends = np.zeros(256, bool), np.zeros(256, bool)
        outside[list(space + stop)] = True
        ends[list(stop)] = True
        _CLASSES[space, stop] = lower, outside, ends
    return _CLASSES[space, stop]


@dataclass
class Words:
    """Words of some texts: place in ``data`` (lower case), fingerprint, number of the piece and of the text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    prints: np.ndarray
    pieces: np.ndarray
    rows: np.ndarray

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of every run of ``n`` words inside one piece, and the runs' fingerprints."""
        first = np.arange(max(len(self.prints) - n + 1, 0))
        first = first[self.pieces[first] == self.pieces[first + n - 1]]
        if n == 1:
            return first, mix(self.prints + np.uint64(1))
        return first, mix(run_values(self.prints, first, first + n, RUN_BASE) + np.uint64(n))

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        """The runs of ``n`` words from each word of ``first`` on, their words joined by single spaces."""
        size = (self.ends - self.starts)
        long = [size[first + k] for k in range(n)]
        total = sum(long) + (n - 1) if len(first) else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(total)]).astype(np.int64)
        out = np.full(int(offsets[-1]), 32, np.uint8)
        at = offsets[:-1].copy()
        for k in range(n):
            inside = np.arange(int(long[k].sum()), dtype=np.int64) - np.repeat(np.cumsum(long[k]) - long[k], long[k])
            out[np.repeat(at, long[k]) + inside] = self.data[np.repeat(self.starts[first + k], long[k]) + inside]
            at += long[k] + 1
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])

    def text(self, word: int, n: int) -> bytes:
        """The ``n`` words from ``word`` on, joined by single spaces."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(
            self.starts[word:word + n].tolist(), self.ends[word:word + n].tolist()))


def _cut(data: np.ndarray, outside: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Ranges of about STEP bytes of data[first:last] that end outside words."""
    while first < last:
        end = min(first + STEP, last)
        while end < last and not outside[data[end]]:
            gap = np.flatnonzero(outside[data[end:end + STEP]])
            end = end + int(gap[0]) if len(gap) else min(end + STEP, last)
        yield first, end
        first = end


def words(column: pa.Array, space: bytes = SPACE, stop: bytes = b"") -> Words:
    """Words of every text of an Arrow column; NULL texts have none. ``stop`` bytes split a text into pieces."""
    lower, outside, ends_piece = _classes(space, stop)
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    whole = column.buffers()[2]
    raw = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    base = int(offsets[0]) if n else 0
    data = lower[raw[base:int(offsets[-1])]] if n else np.zeros(0, np.uint8)
    offsets = offsets - base
    void = column.is_null().to_numpy(zero_copy_only=False)
    starts, ends, prints = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    # texts touch each other in the buffer: a word also ends where its text ends
    for lo, hi in _cut(data, outside, 0, len(data)):
        part = data[lo:hi]
        gap = np.ones(len(part) + 1, bool)
        np.take(outside, part, out=gap[:-1])
        inside = ~gap[:-1]
        inner = offsets[np.searchsorted(offsets, lo, "right"):np.searchsorted(offsets, hi, "left")] - lo
        begins = inside.copy()
        begins[1:] &= gap[:-2]
        begins[inner] = inside[inner]
        finishes = inside & gap[1:]
        before = inner[inner > 0] - 1
        finishes[before] = inside[before]
        s, e = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        value = run_values(part.astype(np.uint64) + np.uint64(1), s, e, BASE)
        starts.append(s + lo)
        ends.append(e + lo)
        prints.append(mix(value + (e - s).astype(np.uint64)))
    s, e = np.concatenate(starts), np.concatenate(ends)
    rows = np.searchsorted(offsets, s, "right") - 1
    stops = np.flatnonzero(ends_piece[data]) if stop else np.zeros(0, np.int64)
    pieces = np.searchsorted(stops, s, "left") + rows  # both grow along the buffer, so their sum tells pieces apart
    if void.any():
        keep = ~void[rows]
        s, e, rows, pieces = s[keep], e[keep], rows[keep], pieces[keep]
        return Words(data, s, e, np.concatenate(prints)[keep], pieces, rows)
    return Words(data, s, e, np.concatenate(prints), pieces, rows)


def text_blocks(batch: pa.RecordBatch, place: int, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (column ``place``) hold ``limit`` bytes at most, or a single longer text."""
    sizes = np.zeros(batch.num_rows, np.int64)
    column = batch.column(place)
    if batch.num_rows:
        kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
        sizes = np.diff(np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + batch.num_rows + 1])
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
