"""Versioned tables and streams over several batches: compaction, pinned readers, repeated batches, late rows."""

import datetime as dt

import pytest

from panelspark.session import scratch_path
from panelspark.sources import versioned as vs
from panelspark.streaming import jobs

D = dt.date


def test_versions_compact_and_stay_readable(spark):
    path, want, pinned = scratch_path(spark, "v"), {}, None
    for v in range(7):
        rows = [(k, v * 100 + k) for k in range(v, v + 4)]
        df = spark.createDataFrame(rows, "k int, x int")
        vs.upsert(df, path, ["k"], v, compact_every=3)
        if v == 5:
            vs.upsert(df, path, ["k"], v, compact_every=3)  # the batch runs again after a failure
        want |= dict(rows)
        assert {tuple(r) for r in vs.read_version(spark, path, ["k"]).collect()} == set(want.items())
        assert vs.manifest(spark, path, v).count() <= 3
        if v == 2:
            pinned = set(want.items())
    assert {tuple(r) for r in vs.read_version(spark, path, ["k"], 2).collect()} == pinned
    assert vs.latest_version(spark, path) == 6
    stale = vs.stale_parts(spark, path, 6)
    live = {r.part for r in vs.manifest(spark, path, 6).collect()}
    assert stale and not live & set(stale)


def test_a_batch_of_bars_may_run_again(spark):
    base = scratch_path(spark, "again")
    schema = "company_id int, date date, close double"
    parts = [[(1, D(2024, 1, 1), 1.0), (2, D(2024, 1, 1), 5.0)], [(1, D(2024, 1, 2), 2.0), (1, D(2024, 1, 2), 9.0)],
             [(1, D(2024, 1, 1), 7.0), (1, D(2024, 1, 3), 4.0)], [(3, D(2024, 1, 3), 8.0)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        jobs.ema_stream(jobs.file_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema), f"{base}/out",
                        f"{base}/ckpt", 0.5).awaitTermination()
    got = sorted((r.company_id, r.date, r.close, r.n, r.ema, r.is_late) for r in jobs.read_ema(spark, f"{base}/out").collect())
    assert got == [(1, D(2024, 1, 1), 1.0, 1, 1.0, False), (1, D(2024, 1, 1), 7.0, 2, 1.5, True),
                   (1, D(2024, 1, 2), 2.0, 2, 1.5, False), (1, D(2024, 1, 2), 9.0, 2, 1.5, True),
                   (1, D(2024, 1, 3), 4.0, 3, 2.75, False), (2, D(2024, 1, 1), 5.0, 1, 5.0, False),
                   (3, D(2024, 1, 3), 8.0, 1, 8.0, False)]
    state = spark.read.parquet(f"{base}/out/state/slot=1").collect()
    assert {(r.company_id, r.n, r.ema, r.batch) for r in state} == {(1, 3, 2.75, 3), (2, 1, 5.0, 3), (3, 1, 8.0, 3)}


@pytest.mark.parametrize("with_marks", [True, False])
def test_late_rows_are_counted_and_kept_out(spark, with_marks):
    base = scratch_path(spark, "late")
    schema = "key int, date date"
    marks = spark.createDataFrame([(1, D(2024, 1, 5)), (1, D(2024, 1, 3))], schema) if with_marks else None
    for part in ([(1, D(2024, 1, 5)), (2, D(2024, 1, 1))], [(2, D(2024, 1, 1)), (2, D(2024, 1, 2)), (1, D(2024, 1, 9))]):
        df = spark.createDataFrame(part, schema)
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        jobs.late_stream(jobs.file_stream(spark, f"{base}/in", df.schema), marks, "key", "date", f"{base}/out",
                         f"{base}/ckpt").awaitTermination()
    late = sorted((r.key, r.date.day, r.batch_id) for r in spark.read.parquet(f"{base}/out/late").collect())
    main = sorted((r.key, r.date.day, r.batch_id) for r in spark.read.parquet(f"{base}/out/main").collect())
    counts = sorted((r.batch_id, r.n_rows, r.n_late) for r in spark.read.parquet(f"{base}/out/counts").collect())
    assert late == ([(1, 5, 0), (2, 1, 1)] if with_marks else [(2, 1, 1)])
    assert main == ([] if with_marks else [(1, 5, 0)]) + [(1, 9, 1), (2, 1, 0), (2, 2, 1)]
    assert counts == [(0, 2, int(with_marks)), (1, 3, 1)]
