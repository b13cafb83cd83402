"""Phrase collocations from Rabin-Karp fingerprints.

Every run of one to four words gets a fingerprint from prefix polynomials (``shingles``), mixed with its language. Tasks
add up the runs of a block of texts and keep a pointer to the first one; a shuffle adds up fingerprints and keeps the
least pointer. Words and pairs are counted first. A longer run can only be frequent if all its pairs are, so those runs
whose pairs pass a Bloom filter of the frequent pairs are counted in a second scan. A last scan goes back to the text of
every run with a frequent fingerprint: inside a block each occurrence is compared with the text under the block's
pointer, and what is counted across blocks is the text itself, so a collision of fingerprints makes two phrases and not
one. Only frequent runs ever become text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import filters
from .common import lookup_join, stage
from .shingles import Words, mix, text_blocks, words

#: Bytes between words, and bytes that end a piece.
SPACE, STOP = b" \t", b".,;:!?\n\v\f\r"

# Longest phrase, least count, factor of the score, percentage at which a longer phrase replaces a shorter
LONGEST, LEAST, FACTOR, COVERED = 4, 30, 2_000_000, 80

#: Bytes of text looked at together, unless a single text is longer.
BLOCK_BYTES = 1 << 20

#: Fingerprints of one length that a task holds before it sends their counts.
HELD = 1 << 19

#: Buckets of a language whose best rows are found apart, before the best of all.
RANK_BUCKETS = 64


def _text_and_language(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def _blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES
            ) -> Iterator[tuple[Words, list[str], np.ndarray, np.ndarray]]:
    """Words of a block of texts, its languages, the number of each text's language, and the languages' hashes."""
    for batch in batches:
        for b in text_blocks(batch, 0, limit):
            names = b.column(1).dictionary_encode()
            langs = names.dictionary.to_pylist()
            salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)
            yield words(b.column(0), SPACE, STOP), langs, names.indices.to_numpy(zero_copy_only=False), salt


def _runs(w: Words, n: int, code: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the runs of ``n`` words and their fingerprints, which differ between languages."""
    first, prints = w.runs(n)
    return first, (mix(prints ^ salt[code[w.rows[first]]]) if len(first) else prints)


def _pairs_pass(w: Words, first: np.ndarray, n: int, good: np.ndarray) -> np.ndarray:
    """Whether all pairs inside each run are marked good (by first word)."""
    keep = np.ones(len(first), bool)
    for k in range(n - 1):
        keep &= good[first + k]
    return keep


def _summed(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> pa.RecordBatch:
    """Counts of some blocks of texts by fingerprint, with the first pointer of each."""
    prints, many, at = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(prints, kind="stable")  # pointers grow from block to block: the first stays the least
    prints = prints[order]
    starts = np.flatnonzero(np.diff(prints, prepend=~prints[:1])) if len(prints) else order
    total = np.add.reduceat(many[order], starts) if len(prints) else many
    return pa.RecordBatch.from_arrays(
        [pa.array(prints[starts].view(np.int64)), pa.array(np.full(len(starts), n, np.int8)), pa.array(total),
         pa.array(at[order][starts])], ["fp", "n_words", "count", "at"])


def _counts(texts: DataFrame, lengths: tuple[int, ...], pairs: filters.Bloom | None = None) -> DataFrame:
    """fp, n_words, count, at (a pointer: task and number of the word) of every run; longer ones only with frequent pairs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 42
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {n: [] for n in lengths}
        for w, _, code, salt in _blocks(batches):
            if pairs is not None:
                start, prints = _runs(w, 2, code, salt)
                good = np.zeros(len(w.prints) + LONGEST, bool)
                good[start[pairs.has(prints)]] = True
            for n in lengths:
                first, prints = _runs(w, n, code, salt)
                if pairs is not None:
                    keep = _pairs_pass(w, first, n, good)
                    first, prints = first[keep], prints[keep]
                prints, where, many = np.unique(prints, return_index=True, return_counts=True)
                held[n].append((prints, many, at + first[where]))
                if sum(len(h[0]) for h in held[n]) > HELD:
                    yield _summed(held[n], n)
                    held[n] = []
            at += len(w.prints)
        for n, rest in held.items():
            if rest:
                yield _summed(rest, n)

    rows = texts.mapInArrow(count, "fp long, n_words byte, count long, at long")
    return rows.groupBy("fp", "n_words").agg(F.sum("count").alias("count"), F.min("at").alias("at"))


def _word_classes(w: Words) -> np.ndarray:
    """A number per word that is equal only for words of equal bytes: the first place of such a word.

    Words with one fingerprint are compared byte by byte with the first of them; those that differ get their own class.
    """
    _, where, inverse = np.unique(w.prints, return_index=True, return_inverse=True)
    rep = where[inverse]
    size = w.ends - w.starts
    same = size == size[rep]
    total = np.where(same, size, 0)
    first = np.cumsum(total) - total
    inside = np.arange(int(total.sum()), dtype=np.int64) - np.repeat(first, total)
    differ = w.data[np.repeat(w.starts, total) + inside] != w.data[np.repeat(w.starts[rep], total) + inside]
    same[np.repeat(np.arange(len(size)), total)[differ]] = False
    own: dict[bytes, int] = {}
    for i in np.flatnonzero(~same).tolist():  # collisions of 64-bit fingerprints: all but never any
        rep[i] = own.setdefault(w.text(i, 1), i)
    return rep


def _texts_of(texts: DataFrame, frequent: filters.Bloom, pairs: filters.Bloom) -> DataFrame:
    """lang, phrase, n_words, count: exact counts by text of runs whose fingerprint may be frequent.

    The row with a NULL phrase holds the number of all words of its language.
    """
    def send(langs: list[str], code: np.ndarray, phrase: pa.Array, n: int, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(code)), phrase.cast(pa.binary()),
             pa.array(np.full(len(code), n, np.int32)), pa.array(count.astype(np.int64))], ["lang", "phrase", "n_words", "count"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, langs, code, salt in _blocks(batches):
            rep = _word_classes(w)
            lang = code[w.rows]
            yield send(langs, np.arange(len(langs)), pa.nulls(len(langs), pa.large_binary()), 0,
                       np.bincount(lang, minlength=len(langs)))
            start, prints = _runs(w, 2, code, salt)
            good = np.zeros(len(w.prints) + LONGEST, bool)
            good[start[pairs.has(prints)]] = True
            for n in range(1, LONGEST + 1):
                first, prints = _runs(w, n, code, salt)
                if n > 2:
                    keep = _pairs_pass(w, first, n, good)
                    first, prints = first[keep], prints[keep]
                keep = frequent.has(prints)
                first, prints = first[keep], prints[keep]
                _, where, inverse, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
                pointer = first[where]  # the block's first occurrence, against whose text the others are read
                differ = lang[first] != lang[pointer][inverse]
                for k in range(n):
                    differ |= rep[first + k] != rep[pointer + k][inverse]
                count = count - np.bincount(inverse[differ], minlength=len(count))
                yield send(langs, lang[pointer], w.texts(pointer, n), n, count)
                if differ.any():  # collisions: other texts under the same fingerprint, counted by themselves
                    other = first[differ]
                    yield send(langs, lang[other], w.texts(other, n), n, np.ones(len(other)))

    rows = texts.mapInArrow(read, "lang string, phrase binary, n_words int, count long")
    rows = rows.withColumn("phrase", F.col("phrase").cast("string"))
    return rows.groupBy("lang", "n_words", "phrase").agg(F.sum("count").alias("a"))


def _whole(x: Column | str) -> Column:
    """A count as a decimal, so that products stay exact."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(28,0)")


def frequent_runs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """Stored lang, n_words, phrase, a of all runs of 1 to 4 words with a >= ``least``, and the words of a language
    under a NULL phrase."""
    texts = _text_and_language(docs, text_col, lang_col)
    short = stage(_counts(texts, (1, 2)).filter(F.col("count") >= least), "short-runs")
    pairs = filters.build(short.filter("n_words = 2"), "fp")
    long = stage(_counts(texts, tuple(range(3, LONGEST + 1)), pairs).filter(F.col("count") >= least), "long-runs")
    found = filters.build(short.select("fp").unionByName(long.select("fp")), "fp")
    return stage(_texts_of(texts, found, pairs).filter((F.col("a") >= least) | F.col("phrase").isNull()), "runs")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of 2 to 4 words.

    A NULL language counts as ``und``, a NULL text as empty; texts without words, repeated rows (each counts) and other
    columns, whatever their names, need no care; an empty table gives no rows. Texts are cut at piece ends into words
    whatever their length. Ties of the score go to the larger count, then to the phrase that is less by bytes.
    """
    runs = frequent_runs(docs, text_col, lang_col, least)
    known = runs.filter("phrase IS NOT NULL")
    candidates = known.filter("n_words > 1")
    parts = F.split("phrase", " ")

    def joined(start: Column, size: Column) -> Column:
        return F.array_join(F.slice(parts, start, size), " ")

    cuts = candidates.select("lang", "phrase", "n_words", "a", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("n_words") - 1), lambda k: F.struct(
            joined(F.lit(1), k).alias("head"), joined(k + 1, F.col("n_words") - k).alias("tail")))).alias("k", "cut"))
    cuts = cuts.select("lang", "phrase", "n_words", "a", "k", "cut.head", "cut.tail")
    side = known.select("lang", "phrase", "a")
    cuts = lookup_join(cuts, side.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = lookup_join(cuts, side.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cuts = cuts.withColumn("wide", _whole("l") + _whole("r")).withColumn("many", F.lit(FACTOR).cast("decimal(8,0)") * _whole("a"))
    scored = cuts.withColumn("score", F.expr("many div wide"))
    lowest = scored.groupBy("lang", "phrase", "n_words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    size = F.col("n_words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: joined(i, m))))
    over = (candidates.filter("n_words > 2").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    lowest = lookup_join(lowest, stage(over, "covering"), ["lang", "phrase"])
    kept = lowest.filter(F.col("longer").isNull() | (_whole("longer") * 100 < _whole("a") * COVERED))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS)))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    rows = rows.filter(F.col("place") <= first)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    total = runs.filter("phrase IS NULL").select("lang", F.col("a").alias("n"))
    return (lookup_join(rows.filter(F.col("rank") <= first), total, ["lang"])
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, k.n_words, unnest(range(1, len(w) - k.n_words + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS n_words) k
  WHERE len(w) >= k.n_words),
f AS (SELECT lang, n_words, array_to_string(w[i:i + n_words - 1], ' ') AS phrase, CAST(count(*) AS BIGINT) AS a
  FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE n_words > 1),
cut AS (SELECT c.*, k.k, array_to_string(s[1:k.k], ' ') AS head, array_to_string(s[k.k + 1:], ' ') AS tail
  FROM c JOIN (SELECT unnest([1, 2, 3]) AS k) k ON k.k < c.n_words),
sc AS (SELECT cut.lang, cut.phrase, cut.a, cut.k, x.a AS l, y.a AS r, (2000000::HUGEINT * cut.a) // (x.a + y.a) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.head AND x.n_words = cut.k
  JOIN f y ON y.lang = cut.lang AND y.phrase = cut.tail AND y.n_words = cut.n_words - cut.k),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (SELECT DISTINCT c.lang, c.a AS longer, array_to_string(c.s[b.i:b.i + b.m - 1], ' ') AS phrase
  FROM c JOIN (SELECT m, i FROM (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)) b
  ON b.m < c.n_words AND b.i + b.m - 1 <= c.n_words),
kept AS (SELECT low.* FROM low WHERE NOT EXISTS (SELECT 1 FROM sub WHERE sub.lang = low.lang AND sub.phrase = low.phrase
  AND 100 * sub.longer >= 80 * low.a)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, CAST(r.score AS BIGINT) AS score FROM r JOIN n ON n.lang = r.lang
WHERE r.rank <= 2000
"""
