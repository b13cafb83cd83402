"""Positions, running totals and quantiles by ranges: outliers, text keys, ties and empty tables."""

import numpy as np
from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import ordering as od


def test_quantiles_with_an_outlier(spark):
    x = np.r_[np.random.default_rng(1).normal(size=5000).round(2), 1e300, -1e300, [0.0] * 2500]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(7)
    got = {r.prob: r.value for r in ag.exact_quantiles(df, "x", [0.0, 0.1, 0.37, 0.5, 0.999]).collect()}
    for p, v in got.items():
        assert np.isclose(v, np.quantile(x, p), rtol=1e-12)
    assert ag.exact_quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_positions_of_text_keys(spark):
    names = [f"n{i % 400:03d}" for i in range(3000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)] + [(None, -1)], "company_id string, date int").repartition(9)
    for place, order in ((od.stacked_position, lambda r: (r.company_id is not None, r.company_id or "", r.date)),
                         (od.date_position, lambda r: (r.date, r.company_id or ""))):
        rows = place(df).collect()
        assert [r.position for r in sorted(rows, key=order)] == list(range(3001)) and {r.n_rows for r in rows} == {3001}
        assert place(df.limit(0)).count() == 0


def test_running_totals(spark):
    df = spark.createDataFrame([(f"k{i:04d}", i, 1.5 * i) for i in range(1000)], "k string, a long, b double").repartition(5)
    rows = sorted(od.running_totals(df, "k", ["a", "b"]).collect())
    a = b = 0
    for r in rows:
        assert (r.a_before, r.b_before) == (a, b)
        a, b = a + r.a, b + r.b


def test_metrics_read_scores_once(spark):
    rng = np.random.default_rng(4)
    s, y = rng.random(800).round(2), rng.integers(0, 2, 800)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    r = ag.classification_metrics(df, "y", "s").first()
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    p = np.clip(s, np.finfo(float).eps, 1 - np.finfo(float).eps)
    assert abs(r.auc - np.mean(pairs)) < 1e-12 and abs(r.accuracy - np.mean((s >= 0.5) == y)) < 1e-12
    assert abs(r.logloss + np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))) < 1e-9


def test_ranges_hold_a_fair_share(spark):
    df = spark.range(20_000).select((F.when(F.col("id") < 5, F.pow(F.lit(10.0), F.col("id") * 60)).otherwise(F.col("id"))).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be joined again
    try:
        sizes = [r["count"] for r in od.in_ranges(df, ["x"]).groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 6000
