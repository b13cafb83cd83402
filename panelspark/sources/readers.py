"""Readers with declared schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Text with a header; fields may hold doubled quotes and line ends."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_text_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per landed file, with its whole content in ``payload``."""
    return spark.read.option("wholetext", True).text(glob).withColumnRenamed("value", "payload")


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
