"""Tables of versions: a manifest per version names the live parts, and a reader sees one version only.

A version adds a part with the newest rows of some keys. After a number of parts they are compacted: one row per key,
cut into ranges of the keys, so that what a reader scans is bounded by the live rows and a few parts. Parts and manifests
are named by their version; a version that is written again after a failure replaces itself, and readers of earlier
versions are never disturbed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import one_per_key

#: Parts that may pile up before they are compacted.
COMPACT_EVERY = 4

MANIFEST = "part string, nth int, rows long"


def manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    """part, nth (a larger one is newer), rows of the parts live in a version."""
    return spark.read.schema(MANIFEST).json(f"{path}/manifest/version={version}")


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version."""
    return spark.read.schema(MANIFEST + ", version int").json(f"{path}/manifest").agg(F.max("version").alias("v")).first()["v"]


def read_version(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """Current rows of a version, the newest one by default: the newest part wins per key."""
    at = latest_version(spark, path) if version is None else version
    return _live(spark, path, keys, [(r["part"], r["nth"]) for r in manifest(spark, path, at).collect()])


def _live(spark: SparkSession, path: str, keys: Sequence[str], parts: Sequence[tuple[str, int]]) -> DataFrame:
    rows = None
    for part, nth in parts:  # COMPACT_EVERY parts at most
        one = spark.read.parquet(f"{path}/{part}").withColumn("_nth", F.lit(nth))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    if len(parts) == 1:
        return rows.drop("_nth")
    return one_per_key(rows, keys, ["_nth"]).drop("_nth")


def upsert(df: DataFrame, path: str, keys: Sequence[str], version: int, compact_every: int = COMPACT_EVERY) -> None:
    """Write version ``version`` (from 0): the rows of ``df`` replace those with their keys in the version before."""
    spark = df.sparkSession
    live = [] if version == 0 else [(r["part"], r["nth"], r["rows"]) for r in manifest(spark, path, version - 1).collect()]
    part = f"part-{version}"
    one_per_key(df, keys, []).write.mode("overwrite").parquet(f"{path}/{part}")
    live.append((part, version, spark.read.parquet(f"{path}/{part}").count()))
    if len(live) > compact_every:
        whole = f"compact-{version}"
        merged = _live(spark, path, keys, [(p, n) for p, n, _ in live])
        merged.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/{whole}")
        live = [(whole, version, spark.read.parquet(f"{path}/{whole}").count())]
    spark.createDataFrame(live, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/manifest/version={version}")


def stale_parts(spark: SparkSession, path: str, keep_from: int) -> list[str]:
    """Parts that no version from ``keep_from`` on needs: what a retention job may delete."""
    all_ = spark.read.schema(MANIFEST + ", version int").json(f"{path}/manifest")
    old, new = all_.where(F.col("version") < keep_from), all_.where(F.col("version") >= keep_from)
    return sorted(r["part"] for r in old.select("part").distinct().join(new.select("part"), "part", "left_anti").collect())
