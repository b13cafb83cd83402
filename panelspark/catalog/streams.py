"""Streaming forms (Z1-Z6), run to completion with the availableNow trigger.

The supplied files are the stream; results and checkpoints go to the shared
folder, and each query returns the table that the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.recurrence import span
from ..session import scratch_path
from ..sources import versioned
from ..streaming import jobs
from .registry import query, rnd, rounded
from .tables import Tables, with_tables
from .windows import recurrence_sql


def _stream(t: Tables, name: str) -> DataFrame:
    """A supplied table, one file or a folder of files, as a file stream; a stream takes a lone file only as a pattern."""
    return jobs.file_stream(t.spark, f"{t.folder}/{{{name}}}.parquet", t.raw(name).schema)


def _paths(t: Tables, name: str) -> tuple[str, str]:
    base = scratch_path(t.spark, name)
    return f"{base}/table", f"{base}/checkpoint"


def _done(query_) -> None:
    query_.awaitTermination()


INCREMENTS = """inc AS (SELECT *, 0 AS batch FROM lineitem WHERE l_shipdate < DATE '1995-01-01'
  UNION ALL SELECT *, 1 FROM lineitem WHERE l_shipdate BETWEEN DATE '1994-07-01' AND DATE '1996-12-31' AND l_linenumber <= 2
  UNION ALL SELECT *, 2 FROM lineitem WHERE l_shipdate >= DATE '1996-07-01' AND l_linenumber <> 1),
px AS (SELECT CAST(l_suppkey AS INT) AS company_id, CAST(l_shipdate AS DATE) AS date, batch, l_extendedprice / l_quantity AS px, l_quantity AS q,
  (l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS k FROM inc)"""


@query("stream_upsert", f"""WITH {INCREMENTS} SELECT company_id, date, arg_min(px, k) AS open, max(px) AS high, min(px) AS low,
    arg_max(px, k) AS close, CAST(sum(q) AS BIGINT) AS volume FROM px GROUP BY company_id, date, batch
    QUALIFY row_number() OVER (PARTITION BY company_id, date ORDER BY batch DESC) = 1""")
def stream_upsert(t: Tables) -> DataFrame:
    """Bars of three overlapping deliveries of lines; a later bar of a key replaces the earlier one."""
    path, ckpt = _paths(t, "upsert")
    landed = scratch_path(t.spark, "lines")

    def bars(batch: DataFrame) -> DataFrame:
        part = Tables(batch.sparkSession, t.folder)
        part.raw = lambda name: batch
        return part.market_data
    lines, day = t.raw("lineitem"), F.col("l_shipdate").cast("date")
    for part in (lines.where(day < F.lit("1995-01-01")),
                 lines.where(day.between("1994-07-01", "1996-12-31") & (F.col("l_linenumber") <= 2)),
                 lines.where((day >= F.lit("1996-07-01")) & (F.col("l_linenumber") != 1))):
        part.write.mode("append").parquet(landed)
        _done(jobs.versioned_stream(jobs.file_stream(t.spark, landed, lines.schema), path, ckpt, ["company_id", "date"],
                                    bars, compact_every=2))
    return versioned.read_version(t.spark, path, ["company_id", "date"])


@query("stream_dedup", "SELECT event_id, ts, CAST(user_id AS INT) AS user_id FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """Every event is delivered twice and kept once."""
    path, ckpt = _paths(t, "dedup")
    events = _stream(t, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("int").alias("user_id"))
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    _done(jobs.dedup_stream(twice, ["event_id"], "ts", "2 days", path, ckpt))
    return t.spark.read.parquet(path).drop(jobs.BATCH)


def _late_events(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.col("user_id").cast("int").alias("user_id"), F.col("ts").cast("date").alias("date"))


@query("stream_late", """SELECT event_id, CAST(user_id AS INT) AS user_id, CAST(ts AS DATE) AS date, CAST(ts AS DATE) <= DATE '2024-01-15' AS is_late FROM events""")
def stream_late(t: Tables) -> DataFrame:
    """Events up to the stored mark of their user are kept apart."""
    path, ckpt = _paths(t, "late")
    marks = t.raw("events").select(F.col("user_id").cast("int").alias("user_id"), F.lit("2024-01-15").cast("date").alias("date")).distinct()
    events = _late_events(_stream(t, "events"))
    _done(jobs.late_stream(events, marks, "user_id", "date", path, ckpt))
    return jobs.read_late(t.spark, path, events.schema).drop(jobs.BATCH)


LATE = """ev AS (SELECT event_id, CAST(user_id AS INT) AS user_id, CAST(ts AS DATE) AS date, event_id % 3 AS batch_id FROM events),
mk AS (SELECT user_id, batch_id, max(date) AS d FROM ev GROUP BY ALL),
lt AS (SELECT ev.*, coalesce(ev.date <= (SELECT max(d) FROM mk WHERE mk.user_id = ev.user_id AND mk.batch_id < ev.batch_id), false) AS is_late FROM ev)"""


def _late_batches(t: Tables) -> tuple[str, DataFrame]:
    """Three deliveries of events, each run to its end before the next lands."""
    path, ckpt = _paths(t, "late")
    landed = scratch_path(t.spark, "events")
    events = t.raw("events")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.mode("append").parquet(landed)
        stream = _late_events(jobs.file_stream(t.spark, landed, events.schema))
        _done(jobs.late_stream(stream, None, "user_id", "date", path, ckpt))
    return path, _late_events(events)


@query("stream_late_batches", f"WITH {LATE} SELECT event_id, user_id, date, batch_id, is_late FROM lt")
def stream_late_batches(t: Tables) -> DataFrame:
    """Marks follow what earlier batches stored."""
    path, like = _late_batches(t)
    return jobs.read_late(t.spark, path, like.schema)


@query("stream_late_counts", f"WITH {LATE} SELECT batch_id, count(*) AS n_rows, count(*) FILTER (is_late) AS n_late FROM lt GROUP BY batch_id")
def stream_late_counts(t: Tables) -> DataFrame:
    path, _ = _late_batches(t)
    return t.spark.read.parquet(f"{path}/counts").select(F.col("batch_id").cast("long"), "n_rows", "n_late")


@query("stream_ohlcv", """SELECT CAST(user_id AS INT) AS company_id, CAST(ts AS DATE) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
    min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2""")
def stream_ohlcv(t: Tables) -> DataFrame:
    path, ckpt = _paths(t, "ohlcv")
    ticks = _stream(t, "events").select(
        F.col("user_id").cast("int").alias("company_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"), F.lit(1).alias("qty"), "event_id")
    _done(jobs.ohlcv_stream(ticks, path, ckpt))
    return jobs.read_upserted(t.spark, path, ["company_id", "date"])


WINDOWS = """SELECT source, w AS window_start, w + 7 AS window_end, count(*) AS news_count, {avg} AS sentiment_avg FROM (
    SELECT source, CASE WHEN s.sentiment_label = 'positive' THEN s.sentiment_score WHEN s.sentiment_label = 'negative' THEN -s.sentiment_score ELSE 0 END AS x,
     n.date - CAST(unnest(range(0, 7)) AS INT) AS w FROM news_articles n JOIN mood s ON s.news_article_id = n.id) GROUP BY source, w"""


def _mood() -> str:
    from .news import MOOD
    return "txt AS (SELECT id, lower(content) AS text FROM news_articles),\n" + MOOD


@query("stream_news_window", with_tables(WINDOWS.format(avg=rnd("avg(x)")), "news_articles", extra=_mood()))
def stream_news_window(t: Tables) -> DataFrame:
    path, ckpt = _paths(t, "news")
    news = _stream(t, "documents").select(
        "source", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("timestamp").alias("ts"), "text")
    _done(jobs.sentiment_stream(news, path, ckpt, delay="400 days"))
    return rounded(jobs.read_upserted(t.spark, path, ["source", "window_start"]))


@query("stream_ema", with_tables(f"""SELECT company_id, date, close, e.n, {rnd('e.y', 4)} AS ema, false AS is_late FROM e
    JOIN market_data USING (company_id, date)
    UNION ALL SELECT m.company_id, m.date, m.close, z.n, {rnd('z.y', 4)}, true FROM market_data m JOIN (
     SELECT company_id, max(n) AS n, arg_max(y, n) AS y FROM e WHERE date <= DATE '1996-06-30' GROUP BY 1) z USING (company_id)
    WHERE m.date BETWEEN DATE '1996-06-01' AND DATE '1996-06-30'""", "market_data",
                                 extra=recurrence_sql("e", "market_data", "close", "2.0::DOUBLE / 15")))
def stream_ema(t: Tables) -> DataFrame:
    """Bars land in four deliveries, the third with some again; the stream keeps one small state per company."""
    path, ckpt = _paths(t, "ema")
    landed = scratch_path(t.spark, "bars")
    day, bars = F.col("date"), t.market_data
    ends = [F.lit(d).cast("date") for d in ("1900-01-01", "1994-12-31", "1996-06-30", "1997-06-30", "2999-12-31")]
    for k in range(4):
        part = (day > ends[k]) & (day <= ends[k + 1])
        if k == 2:
            part |= day.between("1996-06-01", "1996-06-30")
        bars.where(part).write.mode("append").parquet(landed)
        _done(jobs.ema_stream(jobs.file_stream(t.spark, landed, bars.schema), path, ckpt, span(14)))
    return rounded(jobs.read_ema(t.spark, path), {"ema": 4}, skip=("close",))
