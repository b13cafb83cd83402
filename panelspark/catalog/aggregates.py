"""Aggregates, metrics, weights and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..operators import reads as rd
from ..operators import windows as tw
from .registry import query, rnd, rounded
from .tables import Tables, with_tables
from .windows import RET

END = "1998-12-31"


def _ret(t: Tables) -> DataFrame:
    return t.market_data.select("company_id", "date", "close", tw.log_return("close", 1, tw.series()).alias("r"))


PER = """per AS (SELECT c.sector_id, min(m.d) AS m, min(f.d) AS f FROM companies c
  LEFT JOIN (SELECT company_id, min(date) AS d FROM market_data WHERE date <= DATE '1998-12-31' GROUP BY 1) m ON m.company_id = c.id
  LEFT JOIN (SELECT company_id, min(date) AS d FROM fundamentals WHERE date <= DATE '1998-12-31' GROUP BY 1) f ON f.company_id = c.id
  WHERE c.is_active GROUP BY c.sector_id),
mac AS (SELECT min(date) AS d FROM macro_data WHERE date <= DATE '1998-12-31')"""


@query("start_date_rule", with_tables("""SELECT sector_id, greatest(m, f, d) AS start_min, coalesce(m + 1, greatest(m, f, d)) AS start_auto
    FROM per, mac WHERE greatest(m, f, d) <= DATE '1998-12-31'""", "companies", "market_data", "fundamentals", "macro_data", extra=PER))
def start_date_rule(t: Tables) -> DataFrame:
    end = F.lit(END).cast("date")
    args = (t.companies, t.market_data, t.fundamentals, t.macro_data, end)
    low = ag.start_dates(*args, mode="min").withColumnRenamed("start_date", "start_min")
    auto = ag.start_dates(*args, mode="auto").withColumnRenamed("start_date", "start_auto")
    return low.join(auto, "sector_id", "left")


@query("news_daily", with_tables(f"""SELECT l.company_id, a.date, {rnd('avg(confidence_score)')} AS confidence_score_avg,
    {rnd('sum(confidence_score)')} AS confidence_score_sum, count(*) AS news_count FROM news_links l
    JOIN news_articles a ON a.id = l.news_article_id WHERE confidence_score >= 0.7 GROUP BY l.company_id, a.date""",
                                 "news_links", "news_articles"))
def news_daily(t: Tables) -> DataFrame:
    return rounded(ag.news_daily(t.news_links, t.news_articles))


@query("zscore", with_tables(f"""SELECT company_id, date, {rnd('(revenue - avg(revenue) OVER ()) / coalesce(nullif(stddev_samp(revenue) OVER (), 0), 1)', 6)} AS revenue,
    {rnd('(ebitda - avg(ebitda) OVER ()) / coalesce(nullif(stddev_samp(ebitda) OVER (), 0), 1)', 6)} AS ebitda FROM fundamentals""", "fundamentals"))
def zscore(t: Tables) -> DataFrame:
    df = t.fundamentals.select("company_id", "date", "revenue", "ebitda")
    return rounded(ag.zscore(df, ["revenue", "ebitda"]), 6)


@query("impute_mean", with_tables(f"""SELECT company_id, date, {rnd('coalesce(ebitda, avg(ebitda) OVER ())', 4)} AS ebitda FROM fundamentals""", "fundamentals"))
def impute_mean(t: Tables) -> DataFrame:
    return rounded(ag.impute_mean(t.fundamentals.select("company_id", "date", "ebitda"), ["ebitda"]), 4)


@query("quantile", with_tables(f"""SELECT CAST(p AS DOUBLE) AS prob, {rnd('v')} AS value FROM (SELECT unnest([0.005, 0.01, 0.5, 0.99, 0.995]) AS p,
    unnest(quantile_cont(r, [0.005, 0.01, 0.5, 0.99, 0.995])) AS v FROM ret)""", "market_data", extra=RET))
def quantile(t: Tables) -> DataFrame:
    return rounded(ag.exact_quantiles(_ret(t), "r", [0.005, 0.01, 0.5, 0.99, 0.995]), {"value": 8})


@query("drop_constant_cols", with_tables("SELECT company_id, date, revenue, ebitda FROM fundamentals", "fundamentals"))
def drop_constant_cols(t: Tables) -> DataFrame:
    wide = t.fundamentals.select("company_id", "date", "revenue", "ebitda", F.lit(1.0).alias("one"),
                                 F.lit(None).cast("double").alias("nothing"))
    return rd.drop_constant_columns(wide, exclude=["company_id", "date"])


@query("balance_weights", with_tables(f"SELECT company_id, date, {rnd('1.0::DOUBLE / count(*) OVER (PARTITION BY company_id)', 12)} AS weight FROM market_data", "market_data"))
def balance_weights(t: Tables) -> DataFrame:
    return rounded(ag.company_weights(t.market_data.select("company_id", "date")), 12)


@query("class_balance", with_tables(f"""SELECT pos, n - pos AS neg, {rnd('greatest(1, (n - pos) / greatest(1, pos))')} AS scale_pos_weight
    FROM (SELECT CAST(sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS pos, count(*) AS n FROM ret WHERE r IS NOT NULL)""", "market_data", extra=RET))
def class_balance(t: Tables) -> DataFrame:
    y = tw.direction(F.col("r")).alias("y")
    return rounded(ag.class_balance(_ret(t).select(y), "y"))


@query("reg_metrics", with_tables(f"""SELECT {rnd('avg(abs(p - r))')} AS mae, {rnd('sqrt(avg((p - r) * (p - r)))')} AS rmse,
    {rnd('avg(CASE WHEN sign(p) = sign(r) THEN 1.0::DOUBLE ELSE 0 END)')} AS hit_rate, {rnd('avg(p - r)')} AS bias FROM (
    SELECT r, lag(r) OVER (PARTITION BY company_id ORDER BY date) AS p FROM ret) WHERE r IS NOT NULL AND p IS NOT NULL""", "market_data", extra=RET))
def reg_metrics(t: Tables) -> DataFrame:
    df = _ret(t).withColumn("p", F.lag("r").over(tw.series())).na.drop(subset=["r", "p"])
    return rounded(ag.regression_metrics(df, "r", "p"))


SCORED = f"""sc AS (SELECT CASE WHEN r > 0 THEN 1 ELSE 0 END AS y, round(0.5 + 0.4 * tanh(p), 3) AS s FROM (
 SELECT r, lag(r) OVER (PARTITION BY company_id ORDER BY date) AS p FROM ret) WHERE r IS NOT NULL AND p IS NOT NULL),
cm AS (SELECT sum(CASE WHEN y = 1 AND s >= 0.5 THEN 1 ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN y = 0 AND s >= 0.5 THEN 1 ELSE 0 END)::DOUBLE AS fp,
 sum(CASE WHEN y = 1 AND s < 0.5 THEN 1 ELSE 0 END)::DOUBLE AS fn, sum(CASE WHEN y = 0 AND s < 0.5 THEN 1 ELSE 0 END)::DOUBLE AS tn,
 avg(-(y * ln(s) + (1 - y) * ln(1 - s))) AS ll FROM sc),
rk AS (SELECT y, (rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE) AS k FROM sc),
au AS (SELECT (sum(CASE WHEN y = 1 THEN k END) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y) * sum(1 - y)) AS auc FROM rk)"""


@query("clf_metrics", with_tables(f"""SELECT {rnd('auc')} AS auc, {rnd('ll')} AS logloss, {rnd('(tp + tn) / (tp + tn + fp + fn)')} AS accuracy,
    {rnd('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision, {rnd('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall,
    {rnd('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM cm, au""", "market_data", extra=RET + ",\n" + SCORED))
def clf_metrics(t: Tables) -> DataFrame:
    df = _ret(t).withColumn("p", F.lag("r").over(tw.series())).na.drop(subset=["r", "p"])
    df = df.select(tw.direction(F.col("r")).alias("y"), F.round(0.5 + 0.4 * F.tanh("p"), 3).alias("s"))
    return rounded(ag.classification_metrics(df, "y", "s"))


@query("decay_weights", with_tables(f"""SELECT company_id, date, {rnd('w / avg(w) OVER ()')} AS weight FROM (
    SELECT company_id, date, exp(ln(2) / 90 * (p - max(p) OVER ())) AS w FROM (
    SELECT company_id, date, row_number() OVER (ORDER BY company_id, date) - 1 AS p FROM market_data))""", "market_data"))
def decay_weights(t: Tables) -> DataFrame:
    return rounded(ag.decay_weights(t.market_data.select("company_id", "date"), 90).drop("position"))


@query("sample_weights", with_tables(f"""SELECT company_id, date, {rnd('w / avg(w) OVER ()')} AS weight FROM (
    SELECT company_id, date, exp(ln(2) / 90 * (p - max(p) OVER ())) / count(*) OVER (PARTITION BY company_id) AS w FROM (
    SELECT company_id, date, row_number() OVER (ORDER BY date, company_id) - 1 AS p FROM market_data))""", "market_data"))
def sample_weights(t: Tables) -> DataFrame:
    return rounded(ag.sample_weights(t.market_data.select("company_id", "date"), 90, by="date").drop("position"))


SPLIT = "CASE WHEN {0} < cut - 42 THEN 'train' WHEN {0} < cut THEN 'gap' ELSE 'valid' END"


@query("time_split", with_tables(f"""SELECT company_id, date, {SPLIT.format('a')} AS part_position, {SPLIT.format('b')} AS part_date FROM (
    SELECT company_id, date, row_number() OVER (ORDER BY company_id, date) - 1 AS a, row_number() OVER (ORDER BY date, company_id) - 1 AS b,
     greatest(floor(count(*) OVER () * 0.8), 200) AS cut FROM market_data)""", "market_data"))
def time_split(t: Tables) -> DataFrame:
    df = t.market_data.select("company_id", "date")
    out = ag.time_split(df).withColumnRenamed("part", "part_position").drop("position")
    return ag.time_split(out, by="date").withColumnRenamed("part", "part_date").drop("position")


@query("split_80_20", with_tables("""SELECT company_id, date, CASE WHEN row_number() OVER (PARTITION BY company_id ORDER BY date)
    <= floor(count(*) OVER (PARTITION BY company_id) * 0.8) THEN 'train' ELSE 'test' END AS part FROM market_data""", "market_data"))
def split_80_20(t: Tables) -> DataFrame:
    return ag.split_by_share(t.market_data.select("company_id", "date"))


@query("holdout_tail", with_tables("""SELECT company_id, date, CASE WHEN row_number() OVER (PARTITION BY company_id ORDER BY date DESC) <= 14
    THEN 'test' ELSE 'train' END AS part FROM market_data""", "market_data"))
def holdout_tail(t: Tables) -> DataFrame:
    return ag.holdout_tail(t.market_data.select("company_id", "date"), 14)


@query("price_path", with_tables(f"""SELECT company_id, date, {rnd('first_value(close) OVER w * exp(sum(0.5 * r) OVER w)', 3)} AS path FROM ret
    WINDOW w AS (PARTITION BY company_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "market_data", extra=RET))
def price_path(t: Tables) -> DataFrame:
    w = tw.series()
    df = _ret(t).withColumn("p0", F.first("close").over(w))
    return rounded(df.select("company_id", "date", tw.price_path(F.col("p0"), F.col("r") * 0.5, w).alias("path")), 3)


@query("shrink_clip", with_tables(f"""SELECT company_id, date, CASE WHEN r IS NOT NULL THEN {rnd('least(greatest((r - 0.001) * 0.6, -0.5), 0.5)')} END AS r
    FROM ret""", "market_data", extra=RET))
def shrink_clip(t: Tables) -> DataFrame:
    return rounded(_ret(t).select("company_id", "date", tw.shrink_clip(F.col("r"), 0.001, 0.6, (-0.5, 0.5)).alias("r")))
