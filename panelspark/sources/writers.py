"""Writers: appends, table versions and CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_version(df: DataFrame, path: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Write a merged table as a new version next to the one it was made from."""
    target = f"{path}/version={version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    return target


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions present in the frame and keep the others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Text with a header; quotes inside a field are doubled, so that line ends and commas survive."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
