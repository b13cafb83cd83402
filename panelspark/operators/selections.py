"""Stored feature selections: written as records, read back, and applied to a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import append
from .dedup import latest_per_key

#: Columns that stay whatever a selection names.
ALWAYS = ("company_id", "date", "close", "sector_id")

RECORD = ("company_id int, sector_id int, run_date date, model_type string, selected_features array<string>, "
          "total_features int, feature_importances map<string,int>")


def store_selection(record: DataFrame, path: str) -> None:
    """Add selection records to the stored table, with their ranks."""
    names = [f.split(" ")[0] for f in RECORD.split(", ")]
    append(record.select(*names), path, ["model_type"])


def stored_selections(spark: SparkSession, path: str) -> DataFrame:
    """All stored records, ranks included."""
    return spark.read.schema(RECORD).parquet(path)


def latest_selections(stored: DataFrame, model_type: str, key: str = "sector_id") -> DataFrame:
    """The newest record of each sector (or company) of one model type."""
    return latest_per_key(stored.where((F.col("model_type") == model_type) & F.col(key).isNotNull()), [key], "run_date")


def ranks(record: DataFrame) -> DataFrame:
    """One row per record and feature with its rank and whether it was chosen."""
    entries = F.explode(F.map_entries("feature_importances")).alias("e")
    return record.select("company_id", "sector_id", "run_date", "model_type", "selected_features", entries).select(
        "company_id", "sector_id", "run_date", "model_type", F.col("e.key").alias("feature"), F.col("e.value").alias("rank"),
        F.array_contains("selected_features", F.col("e.key")).alias("selected"))


def selected_columns(panel: DataFrame, record: DataFrame) -> DataFrame:
    """Columns of a panel that one record names, beside those that always stay; no record names none."""
    row = record.select("selected_features").first()
    chosen = set(row["selected_features"] or []) if row else set()
    return panel.select(*[c for c in panel.columns if c in ALWAYS or c in chosen])


def selected_values(panel: DataFrame, records: DataFrame, features: list[str], key: str = "sector_id") -> DataFrame:
    """(company, date, key, feature, value) of the features that the record of the row's key names.

    Every key has a choice of its own, so the answer is long; the records are one row a key and small beside the panel.
    """
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    rows = panel.select("company_id", "date", key, each.alias("_all")).join(
        records.select(key, F.col("selected_features").alias("_chosen")), key)
    kept = F.filter("_all", lambda x: F.array_contains("_chosen", x["feature"]))
    return rows.select("company_id", "date", key, F.explode(kept).alias("x")).select("company_id", "date", key, "x.*")
