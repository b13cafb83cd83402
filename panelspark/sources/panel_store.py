"""A panel kept as Parquet: a directory per year, files cut and sorted by key and date.

A filter on dates prunes directories, one on the key reaches the scan as a pushed predicate that row-group statistics
answer, because a file holds a narrow range of keys. A merge rewrites the years that a batch touches and no other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reads import in_list, read_where
from ..session import reliable_checkpoint
from .writers import overwrite_partitions

YEAR = "year"


def _laid_out(df: DataFrame, key: str, on: str, parts: int | None = None) -> DataFrame:
    cut = [YEAR, key, on]
    return (df.withColumn(YEAR, F.year(on)).repartitionByRange(*([parts] if parts else []), *cut).sortWithinPartitions(*cut))


def write_panel(df: DataFrame, path: str, key: str = "company_id", on: str = "date", parts: int | None = None) -> None:
    """Store a panel in ``parts`` ranges; rows without a date are kept apart in their own directory."""
    _laid_out(df, key, on, parts).write.mode("overwrite").partitionBy(YEAR).parquet(path)


def read_panel(spark: SparkSession, path: str, *, on: str = "date", date: Date | None = None, date_from: Date | None = None,
               date_to: Date | None = None, members: tuple[str, Sequence | DataFrame] | None = None, **equals) -> DataFrame:
    """Rows of a stored panel; date bounds also prune its years, ``members`` is (column, list or table of values)."""
    df = spark.read.parquet(path)
    low, high = date or date_from, date or date_to
    if low is not None:
        df = df.where(F.col(YEAR) >= low.year)
    if high is not None:
        df = df.where(F.col(YEAR) <= high.year)
    df = read_where(df, date=date, date_from=date_from, date_to=date_to, on=on, **equals)
    if members is not None:
        df = in_list(df, *members)
    return df.drop(YEAR)


def merge_into(path: str, updates: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], key: str = "company_id",
               on: str = "date") -> list[int]:
    """Merge a batch into a stored panel by ``merge(base, updates)``; returns the years that were rewritten.

    The batch is computed once and stored; only the years it touches are read and written. The new years are complete
    in the shared folder before the first old one is replaced.
    """
    spark = updates.sparkSession
    batch = reliable_checkpoint(updates, "batch")
    years = sorted(r[0] for r in batch.select(F.year(on)).distinct().collect())  # one value a directory
    stored = spark.read.parquet(path)
    base = stored.where(F.col(YEAR).isin(years)).drop(YEAR)
    merged = reliable_checkpoint(merge(base, batch.select(*base.columns)), "merged")
    overwrite_partitions(_laid_out(merged, key, on), path, [YEAR])
    return years
