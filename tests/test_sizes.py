"""Work that follows the rows, not the session's number of partitions."""

import __spark_entry__ as entry
import pyarrow as pa
from pyspark.sql import functions as F

from panelspark import session
from panelspark.catalog import registry
from panelspark.catalog.tables import Tables
from panelspark.operators import forests


def _lines(spark, path):
    spark.range(4000).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 40).alias("l_suppkey"), F.lit(1).alias("l_partkey"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") / 40).cast("int")).alias("l_shipdate"),
        (F.col("id") % 97 + 50.0).alias("l_extendedprice"), F.lit(1.0).alias("l_quantity")).write.parquet(f"{path}/lineitem.parquet")


def test_window_partitions_follow_the_lines(spark, tmp_path, monkeypatch):
    _lines(spark, tmp_path)
    plain = {tuple(r) for r in entry.queries()["ema_spans"](spark, str(tmp_path)).collect()}
    assert Tables(spark, str(tmp_path)).parts is None
    monkeypatch.setattr(session, "TASK_ROWS", 200)
    t = Tables(spark, str(tmp_path))
    assert t.parts == 20 and t.bars.rdd.getNumPartitions() == 20
    out = entry.queries()["ema_spans"](spark, str(tmp_path))
    assert out.rdd.getNumPartitions() == 20
    assert {tuple(r) for r in out.collect()} == plain


def test_rounding_is_half_away_from_zero(spark):
    values = [0.125, -0.125, 2.5, -0.001, None, 1e17 + 0.0, 0.285, 1234567.891, float("nan"), float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.y for r in df.select("i", registry.round_half_up(F.col("x"), 2).alias("y")).orderBy("i").collect()]
    assert got[:4] == [0.13, -0.13, 2.5, 0.0] and str(got[3]) == "0.0" and got[4] is None and got[5] == 1e17
    assert got[7] == 1234567.89 and got[8] != got[8] and got[9] == float("inf")


def test_a_task_hands_its_sums_on_once(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("rid"), (F.col("id") % 2).alias("grp"), (F.col("id") % 7).cast("double").alias("y"),
        F.array((F.col("id") % 7).cast("int"), (F.col("id") % 3).cast("int")).alias("b")).coalesce(1)
    dense = forests.splits(rows, [0, 1], 2, 2, 2, 42)
    old, forests.DENSE_CELLS = forests.DENSE_CELLS, 0
    try:
        sparse = forests.splits(rows, [0, 1], 2, 2, 2, 42)
    finally:
        forests.DENSE_CELLS = old
    assert sorted(dense) == sorted(sparse) and dense
    parts = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["rid"]) for n in (5, 0, 7)]
    assert [[b.num_rows for b in x] for x in forests._buffers(iter(parts))] == [[5, 7]]


def test_partitions_are_named_though_the_session_has_as_many(spark, tmp_path, monkeypatch):
    _lines(spark, tmp_path)
    plain = {tuple(r) for r in entry.queries()["macd_plain"](spark, str(tmp_path)).collect()}
    monkeypatch.setattr(session, "TASK_ROWS", 1000)
    assert session.parts_for(spark, 1000) is None and session.parts_for(spark, 1001) == 8
    t = Tables(spark, str(tmp_path))
    assert t.parts == 8 and t.bars.rdd.getNumPartitions() == 8  # not joined to fewer, larger ones
    assert {tuple(r) for r in entry.queries()["macd_plain"](spark, str(tmp_path)).collect()} == plain


def test_bars_sort_their_lines_once_in_bounded_tasks(spark, tmp_path, monkeypatch):
    _lines(spark, tmp_path)
    plain = {tuple(r) for r in Tables(spark, str(tmp_path)).market_data.collect()}
    monkeypatch.setattr(session, "TASK_ROWS", 200)
    bars = Tables(spark, str(tmp_path)).market_data
    assert bars.rdd.getNumPartitions() == 20  # of 200 lines each, and no second shuffle that joins them again
    assert {tuple(r) for r in bars.collect()} == plain and len(plain) == 4000
