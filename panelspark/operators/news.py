"""News labelling: alias matches, best topic, sentiment, link rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from .joins import anti_existing
from .matching import holding

#: Bytes of the vectors of one block of tags, on average, and articles multiplied with it at a time.
TAG_BLOCK_BYTES, ARTICLE_ROWS = 1 << 24, 256


def alias_phrases(news: DataFrame, aliases: DataFrame, text: str = "text", id_col: str = "id") -> DataFrame:
    """(article, company) pairs where an alias occurs as a run of whole tokens, each once.

    Texts and aliases are written as tokens between single blanks, and the automaton of :mod:`matching` finds the aliases
    with a blank at both ends: one pass over each text, and no join on a run that very many texts share.
    """
    def spaced(c: Column) -> Column:
        return F.concat(F.lit(" "), F.array_join(tokens(F.lower(c)), " "), F.lit(" "))
    pats = aliases.select("company_id", spaced(F.col("alias")).alias("_a")).where(F.trim("_a") != "")
    docs = news.select(F.col(id_col).alias("_id"), spaced(F.col(text)).alias("_text"))
    out = holding(docs, "_id", "_text", pats, "_a", "company_id")
    return out.select(F.col("_id").alias("news_article_id"), F.col("_v").alias("company_id"))


def alias_substrings(news: DataFrame, aliases: DataFrame, text: str = "text", id_col: str = "id") -> DataFrame:
    """(article, company) pairs where an alias occurs anywhere in the lower-case text, each once.

    All aliases are searched together, in one pass over each text, by :mod:`matching`; blank aliases match nothing.
    """
    pats = aliases.select("company_id", F.lower("alias").alias("_a")).where(F.trim("_a") != "")
    docs = news.select(F.col(id_col).alias("_id"), F.lower(text).alias("_text"))
    out = holding(docs, "_id", "_text", pats, "_a", "company_id")
    return out.select(F.col("_id").alias("news_article_id"), F.col("_v").alias("company_id"))


def best_topic(vectors: DataFrame, tags: DataFrame, id_col: str = "id", block_bytes: int = TAG_BLOCK_BYTES) -> DataFrame:
    """Most similar tag of each article and its score; the lowest tag id wins a tie.

    Tags become blocks of unit vectors of bounded size, sent one by one. The articles stream past the blocks in one scan:
    each block is a matrix product, and a row keeps its best tag so far, so neither vectors nor pairs are shuffled.
    Candidates that differ by rounding alone are measured again one by one. An article with a NULL or zero vector has no
    score; tags with such vectors, or of other lengths than the article's vector, are not compared.
    """
    unit = tags.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    size = unit.agg(F.sum(F.size("vector") * 8).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // block_bytes))
    ident = vectors.schema[id_col].dataType.simpleString()
    out = vectors.select(F.col(id_col).alias("_id"), F.col("vector").cast("array<double>").alias("_v"),
                         F.lit(None).cast("double").alias("_s"), F.lit(None).cast("long").alias("_tag"))
    kinds = f"_id {ident}, _v array<double>, _s double, _tag long"
    for k in range(blocks):
        rows = unit.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        sent = vectors.sparkSession.sparkContext.broadcast(_tag_blocks(rows))
        out = out.mapInArrow(_closest(sent), kinds)
    kind = tags.schema["id"].dataType
    return out.select(F.col("_id").alias("news_article_id"), F.col("_tag").cast(kind).alias("context_tag_id"),
                      F.col("_s").alias("confidence_score"))


def _tag_blocks(rows: Sequence) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids in ascending order and vectors by length, without NULL and zero vectors."""
    by: dict[int, list] = {}
    for r in rows:
        v = r["vector"]
        if r["id"] is not None and v and None not in v and any(v):
            by.setdefault(len(v), []).append((r["id"], v))
    out = {}
    for n, some in by.items():
        some.sort()
        out[n] = np.array([i for i, _ in some], np.int64), np.array([v for _, v in some], np.float64)
    return out


def _closest(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cos(v: np.ndarray, t: np.ndarray) -> float:
        return float((v * t).sum() / (np.sqrt((v * v).sum()) * np.sqrt((t * t).sum())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {n: (ids, t, t / np.sqrt((t * t).sum(axis=1))[:, None]) for n, (ids, t) in sent.value.items()}
        for b in batches:
            lists = b.column(1)
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(lists.offsets.to_numpy()))
            score, tag = b.column(2).to_pylist(), b.column(3).to_pylist()
            for n, (ids, whole, units) in blocks.items():
                rows = np.flatnonzero(sizes == n)
                for at in range(0, len(rows), ARTICLE_ROWS):
                    some = rows[at:at + ARTICLE_ROWS]
                    v = lists.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                    length = np.sqrt((v * v).sum(axis=1))
                    fine = np.flatnonzero(np.isfinite(length) & (length > 0))
                    if not len(fine):
                        continue
                    dots = (v[fine] @ units.T) / length[fine][:, None]
                    near = dots >= dots.max(axis=1, keepdims=True) - 1e-9
                    for j, row in enumerate(fine.tolist()):
                        i = int(some[row])
                        for c in np.flatnonzero(near[j]).tolist():
                            s, t = cos(v[row], whole[c]), int(ids[c])
                            if score[i] is None or s > score[i] or (s == score[i] and t < tag[i]):
                                score[i], tag[i] = s, t
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(score, pa.float64()), pa.array(tag, pa.int64())],
                                             ["_id", "_v", "_s", "_tag"])
    return run


#: A small lexicon for texts without one of their own; give a table to :func:`sentiment_from_table` for any other.
POSITIVE_WORDS = ["gain", "growth", "profit", "rise", "record", "good", "et", "the", "las"]
NEGATIVE_WORDS = ["loss", "fall", "debt", "decline", "risk", "bad", "de", "of", "und"]


def lexicon_sentiment(text: Column | str, positive: Sequence[str] = tuple(POSITIVE_WORDS),
                      negative: Sequence[str] = tuple(NEGATIVE_WORDS)) -> tuple[Column, Column]:
    """Label and score of a text from word counts, as plain column expressions.

    The score is the winning share of all lexicon words, 0.5 when they balance.
    """
    t = tokens(F.lower(text))

    def hits(words: Sequence[str]) -> Column:
        return F.size(F.filter(t, lambda w: w.isin(*words)))
    p, n = hits(positive), hits(negative)
    label = F.when(p > n, "positive").when(p < n, "negative").otherwise("neutral")
    score = F.when(p == n, F.lit(0.5)).otherwise(F.greatest(p, n) / (p + n))
    return label, score


def sentiment_from_table(news: DataFrame, lexicon: DataFrame, text: str = "text", id_col: str = "id") -> DataFrame:
    """id, sentiment_label, sentiment_score from a table of (word, polarity), polarity above or below 0.

    Words of a text are counted inside the row first; the table is joined, so it may be of any size.
    """
    sides = lexicon.select(F.lower("word").alias("_w"), F.signum("polarity").cast("int").alias("_p")).where("_p <> 0").distinct()
    words = news.select(id_col, F.explode(tokens(F.lower(text))).alias("_w")).groupBy(id_col, "_w").agg(F.count("*").alias("_n"))
    sums = words.join(sides, "_w").groupBy(id_col).agg(
        F.sum(F.when(F.col("_p") > 0, F.col("_n")).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col("_p") < 0, F.col("_n")).otherwise(0)).alias("_neg"))
    p, n = F.coalesce("_pos", F.lit(0)), F.coalesce("_neg", F.lit(0))
    label = F.when(p > n, "positive").when(p < n, "negative").otherwise("neutral")
    score = F.when(p == n, F.lit(0.5)).otherwise(F.greatest(p, n) / (p + n))
    return news.select(id_col).join(sums, id_col, "left").select(
        id_col, label.alias("sentiment_label"), score.alias("sentiment_score"))


def score_with_model(df: DataFrame, text: str, load: Callable[[], Callable[[pd.Series], pd.DataFrame]]
                     ) -> DataFrame:
    """Add ``sentiment_label`` and ``sentiment_score`` from a model of the caller.

    ``load`` runs once per task and returns a function from a batch of texts to
    a frame with columns label and score; batches arrive through Arrow.
    """
    @F.pandas_udf("sentiment_label string, sentiment_score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            out = model(batch)
            yield pd.DataFrame({"sentiment_label": out["label"].str.lower(),
                                "sentiment_score": out["score"].astype(float)})
    return df.withColumn("_s", score(F.col(text))).select(*df.columns, "_s.*")


def link_rows(matches: DataFrame, labels: DataFrame, companies: DataFrame,
              stored: DataFrame | None = None) -> DataFrame:
    """Link rows for new (article, company) pairs, with sector and article labels."""
    pair = ["news_article_id", "company_id"]
    out = matches.select(*pair).distinct()
    if stored is not None:
        out = anti_existing(out, stored, pair)
    sector = companies.select(F.col("id").alias("company_id"), "sector_id")
    return out.join(sector, "company_id", "left").join(labels, "news_article_id", "left")
