"""Streams over supplied tables."""

import __spark_entry__ as entry
from pyspark.sql import functions as F


def test_streams_read_a_table_of_several_files(spark, tmp_path):
    days = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit("good growth and a loss").alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("src"), (F.col("id") % 2).cast("string")).alias("source"), F.lit(22).alias("n_chars"))
    days.repartition(4).write.parquet(f"{tmp_path}/many/documents.parquet")
    one = f"{tmp_path}/single"
    days.toPandas().to_parquet((tmp_path / "single").mkdir() or f"{one}/documents.parquet")
    found = [sorted(entry.queries()["stream_news_window"](spark, d).collect()) for d in (f"{tmp_path}/many", one)]
    assert sum(r.news_count for r in found[0]) == 40 * 7
    assert found[0] == found[1]
