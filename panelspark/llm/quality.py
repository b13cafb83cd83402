"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are hashed trigrams of character classes and the count of words that repeat the word before; a text is the
weighted, scaled vector of its terms. A truncated SVD of the labelled sample gives the latent space. The sample's vectors
are broadcast; every document meets all of them in blocked products, and its nearest neighbours vote, weighted by cosine.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join

#: Labelled rows of each class at most: the bound of the sample, of the broadcast and of the driver's share.
PER_CLASS = 1024
TERMS, RANK, NEIGHBOURS, BLOCK = 2048, 48, 15, 512

# Classes of bytes (upper, other letters, digits, blanks); other bytes stand for themselves
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[65:91] = 65
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[48:58] = 48
_CLASS[[9, 11, 12, 13]] = 32


def terms(text: str | None) -> np.ndarray:
    """Shares of the hashed terms in a text; zeros for an empty one."""
    data = (text or "").encode()
    out = np.zeros(TERMS + 1, np.float32)
    if len(data) < 1:
        return out
    c = _CLASS[np.frombuffer(b"\n\n" + data, np.uint8)]
    code = (c[:-2] << 16 | c[1:-1] << 8 | c[2:]) * np.uint32(2654435761)
    out[:TERMS] = np.bincount(code >> 21, minlength=TERMS) / len(data)
    words = data.split()
    out[TERMS] = 4 * sum(map(operator.eq, words, words[1:])) / max(1, len(words))
    return np.log1p(100 * out)


@dataclass
class Voters:
    """Latent space and labelled vectors; ``prior`` is the score where nothing is similar."""

    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, x: np.ndarray) -> np.ndarray:
        z = (x * self.weights) @ self.space
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), self.prior)
        cos = np.maximum(self.latent(x) @ self.vectors.T, 0)
        k = min(NEIGHBOURS, cos.shape[1])
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        w = np.take_along_axis(cos, near, 1).astype(float) ** 4
        total = w.sum(axis=1)
        vote = (w * self.labels[near]).sum(axis=1)
        return np.where(total > 1e-9, np.clip(vote / np.maximum(total, 1e-9), 0, 1), self.prior)


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Voters:
    """Voters from the ``per_class`` labelled ids of each class with the smallest hash.

    ``usable`` filters ``labels`` (column id). Rows with a NULL id or label are not used; an id labelled or written
    twice counts once, with its smallest label and text. Without labelled documents every score is 0.5.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.filter("id IS NOT NULL AND y IN (0, 1)")
    known = known.filter(usable) if usable is not None else known
    known = known.groupBy("id").agg(F.min("y").alias("y"))
    prior = known.agg(F.avg("y")).first()[0]
    sample = None
    for y in (0, 1):
        some = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
        sample = some if sample is None else sample.unionByName(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    @F.pandas_udf("binary")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield pd.Series([terms(t).astype(np.float16).tobytes() for t in p], dtype=object)

    rows = (lookup_join(texts, sample, ["id"], "inner").groupBy("id").agg(F.min("text").alias("t"), F.min("y").alias("y"))
            .select("id", "y", encode("t").alias("x")).toPandas().sort_values("id"))
    x = np.stack([np.frombuffer(b, np.float16) for b in rows["x"]]).astype(np.float32) if len(rows) else \
        np.zeros((0, TERMS + 1), np.float32)
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    space = np.zeros((TERMS + 1, 1), np.float32)
    if len(x):
        rng = np.random.default_rng(7)
        a = x * weights
        y = rng.standard_normal((a.shape[1], min(RANK + 16, len(a)))).astype(np.float32)
        for _ in range(4):
            y = np.linalg.qr(a.T @ (a @ y))[0]
        u, _, _ = np.linalg.svd((a @ y).T @ (a @ y))
        space = (y @ u)[:, :RANK]
    model = Voters(weights, space, np.zeros((0, space.shape[1]), np.float32), rows["y"].to_numpy(float),
                   0.5 if prior is None else float(prior))
    model.vectors = model.latent(x)
    return model


def score(docs: DataFrame, model: Voters, text_col: str = "text", out_col: str = "quality_score") -> DataFrame:
    """``docs`` with ``out_col`` (0 to 1); no shuffle. NULL and empty texts get the share of label 1.

    Rows and columns stay as they are; a column named like the new one is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            out = [sent.value.score(np.stack([terms(t) for t in p.iloc[i:i + BLOCK]])) for i in range(0, len(p), BLOCK)]
            yield pd.Series(np.concatenate(out) if out else [], dtype=float)

    return docs.withColumn(out_col, vote(F.col(text_col)))
