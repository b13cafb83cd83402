"""Session helpers: where shared files go, and how narrow scans are spread."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Rows of a panel in one window task, about.
TASK_ROWS = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    The setting is read from the session. It is filled in only for a local
    master that has none (tests); a cluster without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="panelspark-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing the frame to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of few partitions over the cores before heavy per-row work.

    A scan of at least as many partitions as cores is returned as it is, so large inputs are not shuffled, and no row
    changes. Only the number of partitions is asked for, nothing runs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: Bytes of a method that HotSpot still compiles; longer ones are interpreted.
COMPILED_BYTES = 8000


def split_wide_code(spark: SparkSession) -> None:
    """Let projections too wide for one compiled method run as split ones; a limit the caller chose is kept.

    Whole-stage code of a wide projection is one long method, which HotSpot never compiles; that takes twice the time.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) == 65535:  # Spark's own default
        spark.conf.set(limit, COMPILED_BYTES)


def parts_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions that keep a task of so many rows small; None where one task could hold them all.

    The number is named even if the session's is larger: adaptive execution joins small partitions until there are about
    as many as cores, so that a task grows with the table, but leaves a named number as it is.
    """
    parts = -(-rows // TASK_ROWS)
    if parts <= 1:
        return None
    cores = spark.sparkContext.defaultParallelism
    return max(parts, min(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def by_key(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows of a key together in the given number of partitions, which windows over the key then keep; None: no change."""
    return df if parts is None else df.repartition(parts, *keys)
