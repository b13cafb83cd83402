"""Cross-checks with pandas on random panels, edge rows, and invariance to partitioning."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import calendar as cl
from panelspark.operators import joins as jn
from panelspark.operators import windows as tw
from panelspark.operators.dedup import one_per_key
from panelspark.operators.recurrence import BLOCK, Ewm, ewm, indexed, span
from panelspark.plans import frames, indicators
from panelspark.plans.panels import transforms_v3


def panel(sizes, seed=7):
    rng = np.random.default_rng(seed)
    parts = []
    for c, n in enumerate(sizes):
        close = 50 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        parts.append(pd.DataFrame({
            "company_id": c, "date": pd.date_range("2000-01-03", periods=n, freq="D").date,
            "open": close * 1.01, "high": close * (1 + rng.random(n) * 0.02), "low": close * (1 - rng.random(n) * 0.02),
            "close": close, "volume": rng.integers(0, 1000, n)}))
    return pd.concat(parts, ignore_index=True)


def frame(spark, pdf):
    return spark.createDataFrame(pdf.sample(frac=1.0, random_state=1))


def ordered(df, keys=("company_id", "date")):
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)


def seeded(x, n):
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        out[n - 1] = x[:n].mean()
        for i in range(n, len(x)):
            out[i] = out[i - 1] + 2 / (n + 1) * (x[i] - out[i - 1])
    return pd.Series(out)


def test_recurrence_across_blocks(spark):
    pdf = panel([2 * BLOCK + 300, BLOCK, 1, 40])
    df = ewm(indexed(frame(spark, pdf)), {"plain": Ewm("close", span(26)), "seeded": Ewm("close", span(14), 14)})
    got = ordered(df)
    for _, g in got.groupby("company_id"):
        want = g["close"].ewm(span=26, adjust=False).mean()
        assert np.allclose(g["plain"], want, rtol=1e-12, atol=0)
        assert np.allclose(g["seeded"], seeded(g["close"].to_numpy(), 14), rtol=1e-12, atol=0, equal_nan=True)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 26, 50, 200, 5000])
def test_recurrence_of_any_span_skips_gaps(spark, n):
    pdf = panel([2500, 700, 3])
    hole = (pd.to_datetime(pdf["date"]).dt.day % 3 == 0) | (pdf.index < 2)
    pdf["close"] = pdf["close"].mask(hole)
    df = spark.createDataFrame(pdf).withColumn("close", F.nanvl("close", F.lit(None).cast("double")))
    got = ordered(ewm(indexed(df), {"plain": Ewm("close", span(n)), "late": Ewm("close", span(n), 4)}))
    for _, g in got.groupby("company_id"):
        for name, seed in (("plain", 1), ("late", 4)):
            y, seen, want = None, [], []
            for x in g["close"]:
                if not np.isnan(x):
                    seen.append(x)
                    if len(seen) == seed:
                        y = float(np.mean(seen))
                    elif y is not None:
                        y += span(n) * (x - y)
                want.append(np.nan if y is None else y)
            assert np.allclose(g[name].astype(float), want, rtol=1e-11, atol=0, equal_nan=True)


def test_recurrence_rejects_impossible_rates():
    with pytest.raises(ValueError, match="must lie in"):
        Ewm("close", 0.0)


def test_indicators_match_pandas(spark):
    pdf = panel([300, 60])
    got = ordered(indicators.with_averages(frame(spark, pdf)))
    for _, g in got.groupby("company_id"):
        c = g["close"].reset_index(drop=True)
        fast, slow = seeded(c.to_numpy(), 12), seeded(c.to_numpy(), 26)
        macd = fast - slow
        signal = seeded(macd.dropna().to_numpy(), 9)
        d = c.diff()
        up = d.clip(lower=0)[1:].ewm(alpha=1 / 14, adjust=False).mean()
        down = (-d.clip(upper=0))[1:].ewm(alpha=1 / 14, adjust=False).mean()
        rsi = (100 * up / (up + down)).reindex(range(len(c)))
        rsi[:14] = np.nan
        assert np.allclose(g["macd"], macd, atol=1e-9, equal_nan=True)
        assert np.allclose(g["macd_signal"].dropna(), signal.dropna(), atol=1e-9)
        assert np.allclose(g["rsi_14"], rsi, atol=1e-9, equal_nan=True)
        assert np.allclose(g["sma_14"], c.rolling(14).mean(), atol=1e-9, equal_nan=True)


def test_rolling_needs_non_null_values(spark):
    rows = [(1, dt.date(2020, 1, i), None if i == 3 else float(i)) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "company_id int, date date, x double")
    w = tw.series()
    got = ordered(df.select("*", tw.rolling(F.avg, "x", 3, w).alias("m"), tw.pct_change("x", 2, w).alias("p")))
    x = got["x"].astype(float)
    assert np.allclose(got["m"].astype(float), x.rolling(3).mean(), equal_nan=True)
    assert np.allclose(got["p"].astype(float), x.ffill().pct_change(2, fill_method=None), equal_nan=True)


def test_division_by_zero_gives_null(spark):
    rows = [(1, dt.date(2020, 1, i), x) for i, x in enumerate((0.0, 0.0, 5.0, 0.0), 1)]
    df = spark.createDataFrame(rows, "company_id int, date date, x double")
    got = ordered(df.select("*", tw.pct_change("x", 1, tw.series()).alias("p")))["p"].tolist()
    assert pd.isna(got[0]) and pd.isna(got[1]) and pd.isna(got[2]) and got[3] == -1.0


def test_asof_keeps_nulls_of_the_matched_row(spark):
    d = lambda i: dt.date(2020, 1, i)
    left = spark.createDataFrame([(1, d(1)), (1, d(5)), (1, d(10)), (2, d(5))], "company_id int, date date")
    right = spark.createDataFrame([(1, d(2), 1.0, "a"), (1, d(5), None, "b"), (1, d(7), 3.0, "c"), (1, d(9), 4.0, None)],
                                  "company_id int, date date, x double, y string")
    want = {(1, d(1)): (None, None), (1, d(5)): (None, "b"), (1, d(10)): (4.0, None), (2, d(5)): (None, None)}
    got = {(r.company_id, r.date): (r.x, r.y) for r in jn.asof_by_key(left, right).collect()}
    assert got == want
    series = right.where("company_id = 1").drop("company_id")
    got = {(r.company_id, r.date): (r.x, r.y) for r in jn.asof_series(left, series).collect()}
    assert got == {**want, (2, d(5)): (None, "b")}


def test_asof_matches_pandas(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2020-01-01", periods=120)
    left = pd.DataFrame({"company_id": rng.integers(0, 4, 200), "date": rng.choice(days, 200)}).drop_duplicates()
    right = pd.DataFrame({"company_id": rng.integers(0, 4, 60), "date": rng.choice(days, 60)}).drop_duplicates()
    right["v"] = rng.random(len(right))
    want = pd.merge_asof(left.sort_values("date"), right.sort_values("date"), on="date", by="company_id")
    for f in (left, right):
        f["date"] = f["date"].dt.date
    got = ordered(jn.asof_by_key(spark.createDataFrame(left), spark.createDataFrame(right)))
    want = want.sort_values(["company_id", "date"]).reset_index(drop=True)
    assert np.allclose(got["v"].astype(float), want["v"], equal_nan=True)


def test_one_per_key_is_stable_under_partitioning(spark):
    rows = [(1, "a", 5, x) for x in (3.0, 9.0, 1.0)] + [(1, "b", 2, 2.0), (2, "a", 1, 7.0)]
    for n in (1, 4, 200):
        df = spark.createDataFrame(rows, "company_id int, k string, o int, v double").repartition(n)
        got = {(r.company_id, r.k): r.v for r in one_per_key(df, ["company_id", "k"], ["o"]).collect()}
        assert got == {(1, "a"): 9.0, (1, "b"): 2.0, (2, "a"): 7.0}


def test_features_do_not_depend_on_partitioning(spark):
    pdf = panel([80, 50, 30])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in ("1", "4", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = transforms_v3(indicators.market_indicators(frame(spark, pdf).repartition(int(n))))
            seen.append(ordered(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    pd.testing.assert_frame_equal(seen[0], seen[1], check_exact=True)
    pd.testing.assert_frame_equal(seen[0], seen[2], check_exact=True)


def test_quantiles_and_positions_with_a_hot_key(spark):
    """A third of the rows share one company and one value."""
    rng = np.random.default_rng(5)
    x = np.concatenate([np.zeros(1000), rng.normal(0, 1, 1990), [1e12, -1e12]])
    ids = np.concatenate([np.full(1000, 3), rng.integers(0, 50, 1992)])
    pdf = pd.DataFrame({"company_id": ids, "date": pd.to_datetime("2000-01-01") + pd.to_timedelta(
        pd.Series(ids).groupby(ids).cumcount(), unit="D"), "x": x})
    pdf["date"] = pdf["date"].dt.date
    df = spark.createDataFrame(pdf)
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r.prob: r.value for r in ag.exact_quantiles(df, "x", ps).collect()}
    assert np.allclose([got[p] for p in ps], np.quantile(x, ps))
    pos = ordered(ag.time_split(df, 0.2, 10, 5))
    assert pos["position"].tolist() == list(range(len(x)))
    assert (pos["part"] == "valid").sum() == len(x) - int(len(x) * 0.8)
    pos = ordered(ag.time_split(df, 0.2, 10, 5, by="date"), ("date", "company_id"))
    assert pos["position"].tolist() == list(range(len(x)))


def test_auc_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.4), (0, 0.1), (1, 0.7)]
    m = ag.classification_metrics(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert m.auc == pytest.approx(want)


def test_decay_weights_have_mean_one(spark):
    df = spark.createDataFrame(panel([400, 300]))
    w = ordered(ag.decay_weights(df, 90))["weight"]
    t = np.exp(np.log(2) / 90 * np.arange(700))
    assert np.allclose(w, t / t.mean())


def test_sessions(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]
    cal = spark.createDataFrame([(d, d.weekday() < 5 and d.day != 1) for d in days], "trade_date date, is_trading_day boolean")
    last = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2023, 12, 1))], "company_id int, last_date date")
    got = [r.date for r in cl.next_sessions(last, 3, cal).where("company_id = 1").orderBy("step").collect()]
    assert got == [dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 10)]
    got = [r.date for r in cl.next_sessions(last, 2, cal).where("company_id = 2").orderBy("step").collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    with pytest.raises(Exception, match="too few future sessions"):
        cl.next_sessions(last, 60, cal).collect()
    got = [r.date for r in cl.next_sessions(last, 2).where("company_id = 1").orderBy("step").collect()]
    assert got == [dt.date(2024, 1, 8), dt.date(2024, 1, 9)]


def test_model_frame_short_matches_pandas(spark):
    pdf = panel([120])
    got, features = frames.model_frame_short(frame(spark, pdf.assign(revenue=pdf["open"])), n_lags=3)
    got = ordered(got)
    p = pdf.copy()
    p["r"] = np.log(p["close"]).diff()
    s = p["open"]
    want = pd.DataFrame({"r": p["r"], "r_lag_2": p["r"].shift(2), "r_std_10": p["r"].rolling(10).std(),
                         "revenue_lag1": s.shift(1), "revenue_chg_63d": s.shift(1).pct_change(63)}).dropna()
    assert len(got) == len(want)
    for c in want:
        assert np.allclose(got[c], want[c]), c
    assert "revenue_chg_21d" in features
