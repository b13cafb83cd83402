"""Language identification by language-bitmask n-gram filters.

Training counts the 4-byte windows of the letters of all texts, by language. A language's set holds the windows that it
uses at half the rate, or more, of the language that uses them most. All sets go into one bit-sliced Bloom filter: a slot
is a mask with one bit per language, and the AND of a window's slots gives every language that may hold it. Spark sets the
bits; the filter's size follows the windows up to a bound, past which it only grows fuller. Per language the hits of a
text are counted and corrected for the filter's false positives; the highest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, lookup_join, stage

#: Part of the highest rate at which a language keeps a window.
MIN_SHARE = 0.5
#: Slots per stored window, hashes per window, bytes of the whole filter at most.
SLOTS, HASHES, MOST_BYTES = 16, 3, 1 << 25
UNKNOWN = "und"

_OTHER = regex.compile(r"\P{L}+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def windows(text: str | None) -> np.ndarray:
    """Every 4-byte window of the lower-cased letters, with one space between runs and at both ends.

    Letters are those of Unicode's letter categories. A single short letter is filled up to one window; a text without
    letters has none.
    """
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    if not letters:
        return np.zeros(0, np.uint32)
    data = f" {letters} ".encode().ljust(4)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    return b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24


def _slots(grams: np.ndarray, bits: int, i: int) -> np.ndarray:
    x = (grams.astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[i]
    x ^= x >> np.uint64(29)
    return (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)


class Filter:
    """Bit-sliced Bloom filter over languages: ``tables`` holds the masks of 64 languages a row."""

    def __init__(self, langs: list[str], tables: np.ndarray) -> None:
        self.langs, self.tables = langs, tables
        self.bits = tables.shape[1].bit_length() - 1
        fill = [float(((tables[n // 64] >> np.uint64(n % 64)) & np.uint64(1)).mean()) for n in range(len(langs))]
        self.false_rate = np.minimum(np.array(fill) ** HASHES, 1 - 1e-9)

    def shares(self, grams: np.ndarray) -> np.ndarray:
        """Per language the corrected share of windows that it holds."""
        hits = np.zeros(len(self.langs))
        at = [_slots(grams, self.bits, i) for i in range(HASHES)]
        for w, t in enumerate(self.tables):
            mask = t[at[0]]
            for a in at[1:]:
                mask &= t[a]
            for n in range(64 * w, min(64 * w + 64, len(self.langs))):
                hits[n] = np.count_nonzero(mask & np.uint64(1 << (n % 64)))
        share = hits / max(1, len(grams))
        return np.clip((share - self.false_rate) / (1 - self.false_rate), 0, 1)


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", most_bytes: int = MOST_BYTES) -> Filter:
    """Filter from all rows with a language, however many languages. No rows give a filter without languages."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(b.column(0), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(windows(text.as_py()))
            for lang, parts in by.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()),
                                                  "gram": pa.array(grams.astype(np.int64)), "n": pa.array(n)})

    counts = stage(rows.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
                   .mapInArrow(count, "lang string, gram long, n long")
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "windows")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    langs = sorted(r["lang"] for r in totals.select("lang").collect())  # one row a language
    if not langs:
        return Filter([], np.zeros((1, 1 << 10), np.uint64))
    names = rows.sparkSession.createDataFrame(list(zip(langs, range(len(langs)))), "lang string, nth long")
    totals = stage(totals.join(names, "lang"), "languages")
    rates = lookup_join(counts, totals, ["lang"]).select("nth", "gram", (F.col("n") / F.col("total")).alias("rate"))
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    kept = stage(rates.join(most, "gram").filter(F.col("rate") >= MIN_SHARE * F.col("most")).select("nth", "gram"), "kept")
    words = -(-len(langs) // 64)
    bits = min(max(10, (SLOTS * kept.count()).bit_length()), (most_bytes // 8 // words).bit_length() - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nth, grams = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint32)
            for i in range(HASHES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nth // 64), pa.array(_slots(grams, bits, i).astype(np.int64)),
                     pa.array((np.uint64(1) << (nth % 64).astype(np.uint64)).view(np.int64))], ["word", "slot", "mask"])

    masks = (kept.mapInArrow(place, "word long, slot long, mask long").groupBy("word", "slot")
             .agg(F.bit_or("mask").alias("mask")).toPandas())  # most_bytes / 8 rows at most
    tables = np.zeros((words, 1 << bits), np.uint64)
    tables[masks["word"].to_numpy(), masks["slot"].to_numpy()] = masks["mask"].to_numpy(np.int64).view(np.uint64)
    return Filter(langs, tables)


def predict(docs: DataFrame, model: Filter, text_col: str = "text",
            out_cols: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """``docs`` with the language and its share (``out_cols``); no shuffle.

    A NULL text, one without a letter, and any text if no language was learned give ``und`` and 0; every other text gets
    a learned language, however short it is, and whole texts are looked at however long. Ties go to the smaller name. Rows
    and columns stay as they are; columns named like the new ones are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            out = []
            for text in texts:
                grams = windows(text)
                share = sent.value.shares(grams) if len(grams) and sent.value.langs else np.zeros(0)
                best = int(share.argmax()) if len(share) else -1
                out.append((sent.value.langs[best], float(share[best])) if best >= 0 else (UNKNOWN, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "lang_score"])

    rest, made = [c for c in docs.columns if c not in out_cols], fresh(docs.columns, "_guess")
    return docs.withColumn(made, guess(F.col(text_col))).select(
        *rest, F.col(made)["lang_pred"].alias(out_cols[0]), F.col(made)["lang_score"].alias(out_cols[1]))


def kept(rows: DataFrame, min_score: float = 0.3, cols: tuple[str, str] = ("lang_pred", "lang_score")) -> Column:
    """True for rows in a learned language: it was found, and holds at least ``min_score`` of the text's windows."""
    return (rows[cols[0]] != UNKNOWN) & (rows[cols[1]] >= min_score)
