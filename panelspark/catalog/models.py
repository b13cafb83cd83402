"""Models and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import forests as fs
from ..operators import models as md
from ..operators import selections as sl
from ..operators import windows as tw
from ..operators.aggregates import classification_metrics, regression_metrics, split_by_share
from ..operators.calendar import session_phase
from ..plans import frames
from ..session import by_key, reliable_checkpoint, scratch_path
from .calendars import SESSION_PHASE
from .composites import joined_panel
from .registry import query, rnd, rounded
from .tables import Tables, with_tables
from .windows import RET


def _ret(t: Tables) -> DataFrame:
    return t.bars.select("company_id", "date", "close", tw.log_return("close", 1, tw.series()).alias("r"))


FIT = RET + """,
fit AS (SELECT company_id, regr_slope(r, x) AS phi, regr_intercept(r, x) AS intercept, count(*) AS n,
  sqrt((regr_syy(r, x) - regr_slope(r, x) * regr_sxy(r, x)) / (count(*) - 2)) AS sigma FROM (
  SELECT company_id, r, lag(r) OVER (PARTITION BY company_id ORDER BY date) AS x FROM ret) WHERE r IS NOT NULL AND x IS NOT NULL GROUP BY company_id),
lst AS (SELECT company_id, date AS last_date, close, r FROM ret QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) = 1),
roll AS (SELECT company_id, CAST(0 AS INT) AS step, r AS r_pred, 0.0::DOUBLE AS v FROM lst
 UNION ALL SELECT f.company_id, p.step + 1, f.intercept + f.phi * p.r_pred, 1 + f.phi * f.phi * p.v FROM roll p JOIN fit f
  ON f.company_id = p.company_id WHERE p.step < 30)"""


@query("ar1_fit", with_tables(f"""SELECT company_id, {rnd('phi', 7)} AS phi, {rnd('intercept', 7)} AS intercept, n, {rnd('sigma', 7)} AS sigma
    FROM fit""", "market_data", extra=FIT))
def ar1_fit(t: Tables) -> DataFrame:
    return rounded(md.ar1_fit(_ret(t)), 7)


@query("ar1_forecast", with_tables(f"""SELECT p.company_id, p.step, s.date, {rnd('0.6 * p.r_pred', 7)} AS r_pred,
    {rnd('l.close * exp(0.6 * sum(p.r_pred) OVER (PARTITION BY p.company_id ORDER BY p.step))', 3)} AS forecast
    FROM roll p JOIN lst l ON l.company_id = p.company_id JOIN (SELECT x.company_id, t.trade_date AS date,
      row_number() OVER (PARTITION BY x.company_id ORDER BY t.trade_date) AS step FROM lst x JOIN trading_sessions t
      ON t.is_trading_day AND t.trade_date > x.last_date) s ON s.company_id = p.company_id AND s.step = p.step WHERE p.step > 0""",
                                   "market_data", "trading_sessions", extra=FIT))
def ar1_forecast(t: Tables) -> DataFrame:
    return rounded(md.ar1_forecast(_ret(t), 30, t.trading_sessions, shrink=0.6), {"r_pred": 7, "forecast": 3})


@query("ar1_interval", with_tables(f"""SELECT c.ticker AS company_ticker, l.last_date + 1 AS forecast_start_date, p.step AS forecast_step,
    {rnd('p.r_pred', 7)} AS predicted, {rnd('p.r_pred - 1.96 * f.sigma * sqrt(p.v)', 7)} AS lower, {rnd('p.r_pred + 1.96 * f.sigma * sqrt(p.v)', 7)} AS upper
    FROM roll p JOIN fit f ON f.company_id = p.company_id JOIN lst l ON l.company_id = p.company_id JOIN companies c ON c.id = p.company_id
    WHERE p.step BETWEEN 1 AND 14""", "market_data", "companies", extra=FIT))
def ar1_interval(t: Tables) -> DataFrame:
    return rounded(md.ar1_interval(_ret(t), t.companies, 14), 7)


@query("exog_future", with_tables(f"""SELECT l.company_id, CAST(s.step AS INT) AS step, s.date, l.ebitda_lag1, l.revenue_lag1,
    {rnd('sin(2 * pi() * (isodow(s.date) - 1) / 5)')} AS sin_dow, {rnd('cos(2 * pi() * (isodow(s.date) - 1) / 5)')} AS cos_dow,
    {rnd('sin(2 * pi() * p.phase)')} AS sin_mp, {rnd('cos(2 * pi() * p.phase)')} AS cos_mp FROM (
     SELECT company_id, max(date) AS last_date, arg_max(revenue_lag1, date) AS revenue_lag1, arg_max(ebitda_lag1, date) AS ebitda_lag1 FROM (
      SELECT company_id, date, lag(revenue) OVER w AS revenue_lag1, lag(ebitda) OVER w AS ebitda_lag1 FROM fundamentals
      WINDOW w AS (PARTITION BY company_id ORDER BY date)) GROUP BY company_id) l
    JOIN LATERAL (SELECT trade_date AS date, row_number() OVER (ORDER BY trade_date) AS step FROM trading_sessions
     WHERE is_trading_day AND trade_date > l.last_date QUALIFY step <= 14) s ON true
    LEFT JOIN ({SESSION_PHASE}) p ON p.date = s.date""", "fundamentals", "trading_sessions"))
def exog_future(t: Tables) -> DataFrame:
    w = tw.series()
    f = t.fundamentals.select("company_id", "date", *[F.lag(c).over(w).alias(f"{c}_lag1") for c in ("revenue", "ebitda")])
    out = md.exog_future(f, 14, t.trading_sessions, phase=session_phase(t.trading_sessions))
    return rounded(out, {c: 8 for c in out.columns})


def _frame(t: Tables, parts: bool = False, weights: bool = False) -> tuple[DataFrame, list[str]]:
    """Short model frame with the exogenous changes left out, to keep every company; with the split by share if asked for.

    It is stored once: fitting and what follows read it several times. Rows that follow a window of the same companies are
    split, and weighted so that companies count alike, without another shuffle; those of no company have no weight.
    """
    frame, features = frames.model_frame_short(t.bars, n_lags=10)
    if parts:
        frame = split_by_share(frame)
    if weights:
        own = 1.0 / F.count(F.lit(1)).over(Window.partitionBy("company_id"))
        frame = frame.withColumn("weight", F.when(F.col("company_id").isNotNull(), own))
    names = ["company_id", "date", "close", "r", *features, *(["part"] if parts else []), *(["weight"] if weights else [])]
    return reliable_checkpoint(frame.select(*names), "frame"), features


@query("gbt_panel")
def gbt_panel(t: Tables) -> DataFrame:
    """Weighted boosted trees with early stopping on the newest rows; metrics of the test part."""
    frame, features = _frame(t, parts=True, weights=True)
    mean = frame.agg(F.avg("weight").alias("m")).select("m").scalar()
    data = frame.where("weight IS NOT NULL").withColumns({"weight": F.col("weight") / mean, "is_valid": F.col("part") == "test"})
    model = md.fit_gbt(data, features, "r", weight="weight", valid="is_valid")
    return regression_metrics(md.predict(model, data.where("is_valid"), features), "r", "pred")


@query("topn_features")
def topn_features(t: Tables) -> DataFrame:
    frame, features = _frame(t)
    return md.gain_ranking(frame, md.fit_gbt(frame, features, "r", max_iter=5, depth=4), features, 10)


@query("gain_order", with_tables("""SELECT CAST(i AS BIGINT) AS place, ['twin', 'half'][i] AS feature, i = 1 AS most FROM
    (SELECT unnest([1, 2]) AS i) WHERE EXISTS (SELECT 1 FROM market_data)""", "market_data"))
def gain_order(t: Tables) -> DataFrame:
    """The two best features of a target that is made of one feature and, less, of another."""
    h = F.xxhash64("company_id", "date", F.lit(1)) % 1000
    df = t.bars.select("company_id", "date", "close", F.log("close").alias("twin"), (h / 1000.0).alias("half"),
                              (F.xxhash64("company_id", "date", F.lit(2)) % 1000).cast("double").alias("noise"))
    df = reliable_checkpoint(df.withColumn("y", 4 * F.col("twin") + F.col("half")), "gains")
    df = by_key(df, t.parts, "company_id", "date")  # a scan of narrow files has few tasks, which the trees keep in memory
    ranked = md.gain_ranking(df, md.fit_gbt(df, ["noise", "half", "twin"], "y", max_iter=8, depth=4, step=0.5), ["noise", "half", "twin"], 2)
    place = F.row_number().over(Window.orderBy(F.col("gain").desc(), "feature"))  # two rows
    return ranked.select(place.cast("long").alias("place"), "feature", (F.col("gain") > 0.5).alias("most"))


@query("gbt_forecast_days", with_tables("""SELECT company_id, CAST(step AS INT) AS step, date FROM (SELECT x.company_id, t.trade_date AS date,
      row_number() OVER (PARTITION BY x.company_id ORDER BY t.trade_date) AS step FROM (SELECT company_id, max(date) AS d FROM (
       SELECT company_id, date, count(*) OVER (PARTITION BY company_id) AS n FROM ret WHERE r IS NOT NULL) WHERE n >= 30 GROUP BY company_id) x
      JOIN trading_sessions t ON t.is_trading_day AND t.trade_date > x.d) WHERE step <= 3""", "market_data", "trading_sessions", extra=RET))
def gbt_forecast_days(t: Tables) -> DataFrame:
    """Companies, steps and sessions of a roll-forward; every forecast is a positive price."""
    frame, features = _frame(t)
    model = md.fit_gbt(frame, features, "r", max_iter=2, depth=2)
    out = md.gbt_forecast(model, frame, features, 3, t.trading_sessions, session_phase(t.trading_sessions))
    return out.where("forecast > 0").select("company_id", F.col("step").cast("int").alias("step"), "date")


@query("ridge_panel")
def ridge_panel(t: Tables) -> DataFrame:
    data, features = _frame(t, parts=True)
    model = md.fit_ridge(data.where("part = 'train'"), features, "r")
    return regression_metrics(md.predict(model, data.where("part = 'test'"), features), "r", "pred")


CLASSES = """fr AS (SELECT company_id, date, r, row_number() OVER (ORDER BY date, company_id) - 1 AS p, count(*) OVER () AS n FROM (
  SELECT *, lag(r, 2) OVER (PARTITION BY company_id ORDER BY date) AS l2 FROM ret) WHERE r IS NOT NULL AND l2 IS NOT NULL),
pt AS (SELECT *, CASE WHEN p < cut - 42 THEN CASE WHEN p >= floor((cut - 42) * 0.9) THEN 'stop' ELSE 'train' END WHEN p < cut THEN 'gap' ELSE 'valid' END AS part
  FROM (SELECT *, greatest(floor(n * 0.8), 200) AS cut FROM fr))"""


def _classes(t: Tables) -> DataFrame:
    """Next direction from the last returns, with parts and weights of the training rows."""
    w = tw.series()
    df = _ret(t).withColumns({"l1": F.lag("r", 1).over(w), "l2": F.lag("r", 2).over(w), "m": F.log("close")})
    df = df.where(F.col("r").isNotNull() & F.col("l2").isNotNull()).withColumn("y", (F.col("r") > 0).cast("double"))
    return md.class_weights(md.purged_parts(df), "y")


@query("class_parts", with_tables(f"""SELECT part, count(*) AS n, min(date) AS first, max(date) AS last, sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) AS ups,
    {rnd('sum(w)', 6)} AS weight FROM (SELECT *, CASE WHEN part = 'train' THEN CASE WHEN r > 0 THEN (SELECT greatest(1,
     sum(CASE WHEN r > 0 THEN 0 ELSE 1 END) / greatest(1, sum(CASE WHEN r > 0 THEN 1 ELSE 0 END))) FROM pt WHERE part = 'train') ELSE 1 END
     / count(*) FILTER (part = 'train') OVER (PARTITION BY company_id) ELSE 1 END AS w FROM pt) GROUP BY part""",
                                  "market_data", extra=RET + ",\n" + CLASSES))
def class_parts(t: Tables) -> DataFrame:
    """Rows, dates, positives and weights of each part of the purged split."""
    out = _classes(t).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"),
                                          F.sum("y").cast("long").alias("ups"), F.sum("weight").alias("weight"))
    return rounded(out, 6)


@query("gbt_classifier", with_tables("""SELECT unnest(['rows', 'probabilities', 'better than the base rate', 'auc above a half', 'stopped early or at the end']) AS "check", true AS holds
    FROM (SELECT count(*) AS n FROM market_data) WHERE n > 0""", "market_data"))
def gbt_classifier(t: Tables) -> DataFrame:
    """What must hold for a classifier whose label follows from its features but for noise, on rows it never saw."""
    df = _classes(t).withColumn("l0", F.col("r") + F.col("l1") / 2).select("l0", "l1", "l2", "m", "y", "part", "weight")
    df = reliable_checkpoint(df, "classes")  # the trees, the scores and the counts read it nine times
    model = md.fit_gbt_classifier(df, ["l0", "l1", "l2", "m"], "y", max_iter=12, depth=3, step=0.3)
    valid = reliable_checkpoint(md.predict_class(model, df.where("part = 'valid'")), "scored")
    rate = df.where("part = 'train'").agg(F.avg("y").alias("p")).select("p").scalar()
    p = F.least(F.greatest(rate, F.lit(1e-9)), F.lit(1 - 1e-9))
    plain = valid.agg((-F.avg(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))).alias("b"), F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("score").between(0, 1)).alias("ok"))
    every = df.agg(F.count_if(F.col("part") == "valid").alias("all"))
    m = classification_metrics(valid, "y", "score").select(
        "auc", "logloss", *[plain.select(c).scalar().alias(c) for c in ("b", "n", "ok")], every.select("all").scalar().alias("all"))
    checks = m.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check"), c.alias("holds")) for name, c in (
        ("rows", F.col("n") == F.col("all")), ("probabilities", F.col("ok") == F.col("n")),
        ("better than the base rate", F.col("logloss") < F.col("b")), ("auc above a half", F.col("auc") > 0.5),
        ("stopped early or at the end", F.lit(1 <= len(model.stages[-1].trees) <= 12)))])).alias("x"))
    return checks.select("x.*")


@query("ridge_normal_equations", with_tables("""SELECT unnest(['l1', 'l2', 'm']) AS feature, true AS holds""", "market_data"))
def ridge_normal_equations(t: Tables) -> DataFrame:
    """The gradient of the penalised squared error vanishes at the fitted coefficients, feature by feature."""
    w, names, penalty = tw.series(), ["l1", "l2", "m"], 0.1
    df = _ret(t).withColumns({"l1": F.lag("r", 1).over(w), "l2": F.lag("r", 2).over(w), "m": F.log("close")})
    df = reliable_checkpoint(df.na.drop(subset=["r", *names]).select("company_id", "date", "r", *names), "ridge")
    model = md.fit_ridge(df, names, "r", penalty)
    coef = model.coefficients
    out = md.predict(model, df, names)
    stats = {f: (F.avg(f), F.stddev_samp(f)) for f in names}
    one = df.agg(F.struct(*[F.struct(a.alias("mu"), s.alias("sd")).alias(f) for f, (a, s) in stats.items()],
                          F.stddev_pop("r").alias("sy")).alias("s")).select("s").scalar()
    out = out.withColumn("_s", one)
    # the solver scales the target by its deviation, and the penalty with it
    grad = [F.avg((F.col(f) - F.col(f"_s.{f}.mu")) / F.col(f"_s.{f}.sd") * (F.col("r") - F.col("pred")))
            - F.lit(penalty * float(b)) / F.max("_s.sy") for f, b in zip(names, coef)]
    row = out.agg(*[g.alias(f) for f, g in zip(names, grad)], F.max("_s.sy").alias("sy"))
    return row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), (F.abs(F.col(f)) < 1e-6 * F.col("sy")).alias("holds"))
                                          for f in names])).alias("x")).select("x.*")


SECTOR_FEATURES = ["twin", "open", "volume", "noise"]


@query("sector_selection", with_tables("""SELECT DISTINCT CAST(c.sector_id AS BIGINT) AS sector_id, unnest(['twin', 'noise']) AS feature,
    unnest([true, false]) AS selected FROM market_data m JOIN companies c ON c.id = m.company_id""", "market_data", "companies"))
def sector_selection(t: Tables) -> DataFrame:
    """Selections of all sectors in one run, stored and read back: a copy of the target is found everywhere, noise nowhere."""
    sector = t.companies.select(F.col("id").alias("company_id"), "sector_id")
    noise = F.xxhash64("company_id", "date", F.lit(5)) % 1000
    panel = t.market_data.join(sector, "company_id").withColumns({"twin": F.col("close") * 2 + 1, "noise": noise})
    found = fs.keyed_selection(panel, "sector_id", SECTOR_FEATURES, "close", ["company_id", "date"], rounds=8, trees=3, depth=3)
    path = scratch_path(t.spark, "sector-selection")
    sl.store_selection(fs.selection_records(found, "sector_id"), path)
    stored = sl.ranks(sl.latest_selections(sl.stored_selections(t.spark, path), "shadow"))
    return (stored.where(F.col("feature").isin("twin", "noise"))
            .select(F.col("sector_id").cast("long").alias("sector_id"), "feature", "selected"))


@query("gbt_forecast")
def gbt_forecast(t: Tables) -> DataFrame:
    frame, features = _frame(t)
    model = md.fit_gbt(frame, features, "r", max_iter=5, depth=4)
    return md.gbt_forecast(model, frame, features, 5, t.trading_sessions, session_phase(t.trading_sessions))


@query("shadow_selection")
def shadow_selection(t: Tables) -> DataFrame:
    panel = joined_panel(t)
    features = ["open", "high", "low", "volume", "revenue", "gross_profit", "gdp", "cpi", "exchange_rate_eur"]
    return md.shadow_selection(panel, features, "close", ["company_id", "date"])
