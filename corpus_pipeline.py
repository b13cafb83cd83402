"""Corpus pipeline: stages of operators over documents, each written as Parquet and read again by the next.

Every stage but the last returns the columns of its input, whatever other names these have: rows travel whole beside what
a stage adds. NULLs, empty texts and repeated rows are handled as the operators say; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import language, mixing, packing, quality, simhash
from panelspark.llm.common import packed, stage, table, text_batches

#: Score below which the quality classifier rejects a document.
MIN_QUALITY = 0.3


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours vote for quality; the labels are those of kept and lost documents alike."""
    text_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows = quality.score(packed(docs, "text"), model)
    return rows.filter(F.col("quality_score") >= MIN_QUALITY).select("row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the table's own texts teach; texts without letters go."""
    text_batches(spark)
    rows = language.predict(packed(docs, "text"), language.train(docs))
    return rows.filter(language.kept(rows)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints: the one with the smallest id."""
    text_batches(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice. Equal rows share their fate."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets."""
    text_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", classify_quality),
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: No DuckDB text: neither the votes nor the fingerprints can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is stored and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, build in STAGES:
        docs = stage(build(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
