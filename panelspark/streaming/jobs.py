"""Incremental jobs on Structured Streaming.

Every job takes a streaming frame, a table path and a checkpoint path in the
shared folder, runs with the ``availableNow`` trigger and returns the query.
Batch writes are keyed by batch id and overwrite their own partition, so a
batch that is run again after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import one_per_key
from ..operators.news import lexicon_sentiment
from ..operators.recurrence import Ewm, ewm, indexed
from ..session import reliable_checkpoint
from ..sources import versioned

BATCH = "batch_id"


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _batch_writer(path: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch: int) -> None:
        out = shape(df) if shape else df
        (out.withColumn(BATCH, F.lit(batch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))
    return write


def upsert_stream(stream: DataFrame, path: str, checkpoint: str,
                  shape: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append") -> StreamingQuery:
    """Write each batch of (shaped) rows as the newest versions of their keys."""
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(_batch_writer(path, shape)).trigger(availableNow=True).start())


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of an upserted table: the newest batch wins per key."""
    return one_per_key(spark.read.parquet(path), keys, [BATCH]).drop(BATCH)


def versioned_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str],
                     shape: Callable[[DataFrame], DataFrame] | None = None,
                     compact_every: int = versioned.COMPACT_EVERY) -> StreamingQuery:
    """Each batch becomes a version of a table whose parts are compacted; readers are pinned to a version."""
    def write(df: DataFrame, batch: int) -> None:
        versioned.upsert(shape(df) if shape else df, path, keys, batch, compact_every)
    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(availableNow=True).start())


def dedup_stream(stream: DataFrame, keys: Sequence[str], on: str, delay: str, path: str,
                 checkpoint: str) -> StreamingQuery:
    """Drop re-delivered rows whose keys were seen within the watermark delay."""
    unique = stream.withWatermark(on, delay).dropDuplicatesWithinWatermark(list(keys))
    return upsert_stream(unique, path, checkpoint)


def split_late(df: DataFrame, marks: DataFrame, key: str, on: str) -> DataFrame:
    """Mark rows at or before the stored mark of their key as late."""
    m = marks.groupBy(key).agg(F.max(on).alias("_hw"))
    return df.join(m, key, "left").withColumn(
        "is_late", F.coalesce(F.col(on) <= F.col("_hw"), F.lit(False))).drop("_hw")


def late_stream(stream: DataFrame, stored: DataFrame | None, key: str, on: str, path: str,
                checkpoint: str) -> StreamingQuery:
    """Rows after the stored mark of their key go on to ``path/main``; late rows go to ``path/late``.

    A mark is the newest date of the key, read anew for each batch from ``stored`` and from what earlier batches wrote
    to the main table. Each batch leaves one row in ``path/counts``: its rows and its late rows, observed while it ran.
    """
    schema = stream.schema

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        marks = None if stored is None else stored.select(key, on)
        if batch:
            main = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(f"{path}/main")
            before = main.where(F.col(BATCH) < batch).select(key, on)
            marks = before if marks is None else marks.unionByName(before)
        marked = df.withColumn("is_late", F.lit(False)) if marks is None else split_late(df, marks, key, on)
        seen = Observation()
        marked = reliable_checkpoint(marked.observe(
            seen, F.count(F.lit(1)).alias("n_rows"), F.count_if("is_late").alias("n_late")), "late")
        for late, name in ((False, "main"), (True, "late")):
            _batch_writer(f"{path}/{name}")(marked.where(F.col("is_late") == F.lit(late)).drop("is_late"), batch)
        counts = spark.createDataFrame([(seen.get["n_rows"], seen.get["n_late"])], "n_rows long, n_late long")
        _batch_writer(f"{path}/counts")(counts, batch)
    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(availableNow=True).start())


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the main and the late output of :func:`late_stream`, with ``is_late`` and the batch."""
    kinds = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])

    def part(name: str, late: bool) -> DataFrame:
        return spark.read.schema(kinds).parquet(f"{path}/{name}").withColumn("is_late", F.lit(late))
    return part("main", False).unionByName(part("late", True))


def daily_bars(ticks: DataFrame, key: str = "company_id", ts: str = "ts", price: str = "price",
               qty: str = "qty", seq: str = "event_id") -> DataFrame:
    """Bars of one day per key from ticks; equal times are ordered by the sequence column."""
    order = F.struct(ts, seq)
    return (ticks.groupBy(key, F.window(ts, "1 day").alias("_w")).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, order).alias("close"), F.sum(qty).cast("long").alias("volume"))
        .select(key, F.col("_w.start").cast("date").alias("date"), "open", "high", "low", "close", "volume"))


def ohlcv_stream(ticks: DataFrame, path: str, checkpoint: str, delay: str = "2 days",
                 ts: str = "ts") -> StreamingQuery:
    """Daily bars from a tick stream; a bar that grows is written again and the newest wins."""
    return upsert_stream(daily_bars(ticks.withWatermark(ts, delay)), path, checkpoint, mode="update")


def sentiment_windows(news: DataFrame, ts: str = "ts", length: str = "7 days", slide: str = "1 day") -> DataFrame:
    """News count and mean signed sentiment in sliding windows per source."""
    label, score = lexicon_sentiment("text")
    signed = F.when(label == "positive", score).when(label == "negative", -score).otherwise(0.0)
    return (news.select(ts, "source", signed.alias("_s")).groupBy("source", F.window(ts, length, slide).alias("_w"))
            .agg(F.count(F.lit(1)).alias("news_count"), F.avg("_s").alias("sentiment_avg"))
            .select("source", F.col("_w.start").cast("date").alias("window_start"),
                    F.col("_w.end").cast("date").alias("window_end"), "news_count", "sentiment_avg"))


def sentiment_stream(news: DataFrame, path: str, checkpoint: str, delay: str = "7 days",
                     ts: str = "ts") -> StreamingQuery:
    return upsert_stream(sentiment_windows(news.withWatermark(ts, delay), ts), path, checkpoint, mode="update")


EMA_STATE = "company_id int, n long, ema double, last date, batch long"


def ema_stream(bars: DataFrame, path: str, checkpoint: str, alpha: float) -> StreamingQuery:
    """Running EMA per company over batches of bars; the state is one row (count, average, last date) per company.

    The stored average stands as the first value before the batch's bars, and the recurrence runs over both with window
    sums. A bar at or before the last date of its company, or a second one of a day, does not change the average and is
    marked late. The state lies in two slots by turns, each with its batch number: a batch that runs again finds the slot
    it started from as it was.
    """
    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        state = spark.createDataFrame([], EMA_STATE) if batch == 0 else spark.read.schema(EMA_STATE).parquet(
            f"{path}/state/slot={(batch - 1) % 2}")
        state = state.select("*", F.when(F.col("batch") != batch - 1, F.raise_error(F.lit("state of another batch"))).alias("_ok"))
        old = state.where(F.col("_ok").isNull()).select("company_id", F.col("n").alias("_n0"), F.col("ema").alias("_e0"), "last")
        day = Window.partitionBy("company_id", "date").orderBy("close")
        new = df.select("company_id", "date", "close").withColumn("_r", F.row_number().over(day)).join(old, "company_id", "left")
        late = F.coalesce(F.col("date") <= F.col("last"), F.lit(False)) | (F.col("_r") > 1)
        new = new.select("company_id", "date", "close", "_r", F.coalesce("_n0", F.lit(0)).alias("_n0"), late.alias("is_late"),
                         F.when(~late, F.col("close")).alias("_x"), F.lit(1).alias("_o"))
        start = old.select("company_id", F.col("last").alias("date"), F.lit(None).cast("double").alias("close"),
                           F.lit(0).alias("_r"), "_n0", F.lit(False).alias("is_late"), F.col("_e0").alias("_x"), F.lit(0).alias("_o"))
        order = ["_o", "date", "_r"]
        both = ewm(indexed(new.unionByName(start), order=order), {"ema": Ewm("_x", alpha)}, order=order)
        upto = Window.partitionBy("company_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        n = F.col("_n0") + F.count(F.when(F.col("_o") == 1, F.col("_x"))).over(upto)
        done = reliable_checkpoint(both.withColumn("n", n), "ema")
        _batch_writer(f"{path}/bars")(done.where("_o = 1").select("company_id", "date", "close", "n", "ema", "is_late"), batch)
        after = done.groupBy("company_id").agg(
            F.max("n").alias("n"), F.max_by("ema", "_i").alias("ema"), F.max("date").alias("last"))
        after.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{path}/state/slot={batch % 2}")
    return (bars.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(availableNow=True).start())


def read_ema(spark: SparkSession, path: str) -> DataFrame:
    """Bars written by :func:`ema_stream`, with the running average after each."""
    return spark.read.parquet(f"{path}/bars").drop(BATCH)
