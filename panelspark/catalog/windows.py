"""Window and time-series operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.config import check_keys, without_comments
from ..operators import windows as tw
from ..operators.aggregates import winsorize_by_key
from ..operators.joins import asof_by_key
from ..operators.recurrence import Ewm, ewm, indexed, rsi_from, rsi_inputs, span
from ..plans.frames import exog_lags as exog_lag_columns
from ..plans.indicators import with_averages
from .registry import query, rnd, rounded
from .tables import Tables, with_tables

WIN = "WINDOW w AS (PARTITION BY company_id ORDER BY date)"
LR = "ln(close) - ln(lag(close) OVER (PARTITION BY company_id ORDER BY date))"
RET = f"ret AS (SELECT company_id, date, close, volume, {LR} AS r FROM market_data)"


def _close(t: Tables) -> DataFrame:
    return t.bars.select("company_id", "date", "close")


def _ret(t: Tables) -> DataFrame:
    return _close(t).select("company_id", "date", "close", tw.log_return("close", 1, tw.series()).alias("r"))


def roll(agg: str, x: str, n: int, part: str = "company_id") -> str:
    """SQL of a rolling aggregate that needs n values."""
    f = f"OVER (PARTITION BY {part} ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {f} = {n} THEN {agg}({x}) {f} END"


@query("log_returns", with_tables(f"""SELECT company_id, date, {rnd('ln(close) - ln(lag(close, 1) OVER w)')} AS ret_1d,
    {rnd('ln(close) - ln(lag(close, 5) OVER w)')} AS ret_5d, {rnd('ln(close) - ln(lag(close, 20) OVER w)')} AS ret_20d
    FROM market_data {WIN}""", "market_data"))
def log_returns(t: Tables) -> DataFrame:
    return rounded(_close(t).select("company_id", "date", *[
        tw.log_return("close", k, tw.series()).alias(f"ret_{k}d") for k in (1, 5, 20)]))


@query("lags", with_tables("SELECT company_id, date, " + ", ".join(
    f"{rnd(f'lag(r, {i}) OVER w')} AS r_lag_{i}" for i in range(1, 11)) + f" FROM ret {WIN}", "market_data", extra=RET))
def lags(t: Tables) -> DataFrame:
    return rounded(tw.add_lags(_ret(t), "r", 10, tw.series()).drop("close", "r"))


@query("roll_mean", with_tables("SELECT company_id, date, " + ", ".join(
    f"{rnd(roll('avg', 'r', n))} AS r_ma_{n}" for n in (5, 10, 21)) + " FROM ret", "market_data", extra=RET))
def roll_mean(t: Tables) -> DataFrame:
    return rounded(_ret(t).select("company_id", "date", *[
        tw.rolling(F.avg, "r", n, tw.series()).alias(f"r_ma_{n}") for n in (5, 10, 21)]))


@query("roll_std", with_tables("SELECT company_id, date, " + ", ".join(
    f"{rnd(roll('stddev_samp', 'r', n))} AS r_std_{n}" for n in (5, 10, 20, 21)) + " FROM ret", "market_data", extra=RET))
def roll_std(t: Tables) -> DataFrame:
    return rounded(_ret(t).select("company_id", "date", *[
        tw.rolling(F.stddev_samp, "r", n, tw.series()).alias(f"r_std_{n}") for n in (5, 10, 20, 21)]))


@query("price_range", with_tables("SELECT company_id, date, " + ", ".join(
    f"{rnd('ln((' + roll('max', 'close', n) + ') / (' + roll('min', 'close', n) + '))')} AS price_range_{n}"
    for n in (10, 21)) + " FROM market_data", "market_data"))
def price_range(t: Tables) -> DataFrame:
    return rounded(_close(t).select("company_id", "date", *[
        tw.log_range("close", n, tw.series()).alias(f"price_range_{n}") for n in (10, 21)]))


@query("sma", with_tables(f"SELECT company_id, date, {rnd(roll('avg', 'close', 14), 4)} AS sma_14 FROM market_data", "market_data"))
def sma(t: Tables) -> DataFrame:
    return rounded(_close(t).select("company_id", "date", tw.rolling(F.avg, "close", 14, tw.series()).alias("sma_14")), 4)


def recurrence_sql(name: str, source: str, x: str, alpha: str, seed: int = 1, order: str = "date") -> str:
    """Recursive CTE of y = y + alpha * (x - y), started by the mean of the first ``seed`` values."""
    f = f"OVER (PARTITION BY company_id ORDER BY {order} ROWS BETWEEN {seed - 1} PRECEDING AND CURRENT ROW)"
    return f"""{name}_in AS MATERIALIZED (SELECT company_id, date, {x} AS x, avg({x}) {f} AS s,
  row_number() OVER (PARTITION BY company_id ORDER BY {order}) AS n FROM {source} WHERE {x} IS NOT NULL),
{name} AS (SELECT company_id, date, n, s AS y FROM {name}_in WHERE n = {seed}
  UNION ALL SELECT i.company_id, i.date, i.n, p.y + {alpha} * (i.x - p.y) FROM {name} p JOIN {name}_in i
  ON i.company_id = p.company_id AND i.n = p.n + 1)"""


@query("ema_seeded", with_tables(f"""SELECT m.company_id, m.date, {rnd('e.y', 4)} AS ema_14 FROM market_data m
    LEFT JOIN e USING (company_id, date)""", "market_data", extra=recurrence_sql("e", "market_data", "close", "2.0::DOUBLE / 15", 14)))
def ema_seeded(t: Tables) -> DataFrame:
    out = ewm(indexed(_close(t)), {"ema_14": Ewm("close", span(14), 14)})
    return rounded(out.select("company_id", "date", "ema_14"), 4)


@query("ema_plain", with_tables(f"""SELECT company_id, date, {rnd('a.y', 4)} AS ema_12, {rnd('b.y', 4)} AS ema_26
    FROM a JOIN b USING (company_id, date)""", "market_data", extra=recurrence_sql(
        "a", "market_data", "close", "2.0::DOUBLE / 13") + ",\n" + recurrence_sql("b", "market_data", "close", "2.0::DOUBLE / 27")))
def ema_plain(t: Tables) -> DataFrame:
    out = ewm(indexed(_close(t)), {f"ema_{n}": Ewm("close", span(n)) for n in (12, 26)})
    return rounded(out.select("company_id", "date", "ema_12", "ema_26"), 4)


SPANS = (2, 3, 5, 26, 50, 200)


@query("ema_spans", with_tables("SELECT company_id, date, " + ", ".join(f"{rnd(f's{n}.y', 4)} AS ema_{n}" for n in SPANS) + " FROM s2"
                                + "".join(f" JOIN s{n} USING (company_id, date)" for n in SPANS[1:]), "market_data",
                                extra=",\n".join(recurrence_sql(f"s{n}", "market_data", "close", f"2.0::DOUBLE / {n + 1}") for n in SPANS)))
def ema_spans(t: Tables) -> DataFrame:
    """Averages from the fastest to the slowest span in use."""
    out = ewm(indexed(_close(t)), {f"ema_{n}": Ewm("close", span(n)) for n in SPANS})
    return rounded(out.select("company_id", "date", *[f"ema_{n}" for n in SPANS]), 4)


CONFIG = {"data_comment": "not read", "data": {"span": 5, "span_comment": "sessions", "lags": [1, 3], "company": {"from": 2, "from_comment": 0}},
          "model": {"trees": 10}}


@query("configured_frame", with_tables(f"""SELECT company_id, date, {rnd('ln(close) - ln(lag(close) OVER w)', 6)} AS r_lag_0, lag(close, 1) OVER w AS close_lag_1,
    lag(close, 3) OVER w AS close_lag_3, {rnd(roll('avg', 'close', 5), 6)} AS mean_5 FROM market_data WHERE company_id >= 2 {WIN}""", "market_data"))
def configured_frame(t: Tables) -> DataFrame:
    """Columns of a frame as the sections of a job configuration name them; comment keys count for nothing."""
    conf = without_comments(CONFIG)
    check_keys(conf, ["data", "model"], "job")
    data = conf["data"]
    check_keys(data, ["span", "lags", "company"], "data")
    w = tw.series()
    cols = {"r_lag_0": tw.log_return("close", 1, w)} | {f"close_lag_{i}": F.lag("close", i).over(w) for i in data["lags"]}
    cols[f"mean_{data['span']}"] = tw.rolling(F.avg, "close", data["span"], w)
    df = _close(t).where(F.col("company_id") >= data["company"]["from"])
    out = df.select("company_id", "date", *[c.alias(n) for n, c in cols.items()])
    return rounded(out, 6, skip=tuple(c for c in out.columns if c.startswith("close_lag")))


GAPS = "CASE WHEN day(date) % 3 = 0 OR (month(date) = 5 AND company_id % 2 = 0) THEN NULL ELSE close END"


@query("ema_gaps", with_tables(f"""SELECT m.company_id, m.date, {rnd('last_value(a.y IGNORE NULLS) OVER w', 4)} AS ema_5,
    {rnd('last_value(b.y IGNORE NULLS) OVER w', 4)} AS ema_14 FROM market_data m LEFT JOIN a USING (company_id, date)
    LEFT JOIN b USING (company_id, date) WINDOW w AS (PARTITION BY m.company_id ORDER BY m.date ROWS UNBOUNDED PRECEDING)""",
                               "market_data", extra=f"gaps AS (SELECT company_id, date, {GAPS} AS x FROM market_data),\n" + recurrence_sql(
                                   "a", "gaps", "x", "2.0::DOUBLE / 6") + ",\n" + recurrence_sql("b", "gaps", "x", "2.0::DOUBLE / 15", 14)))
def ema_gaps(t: Tables) -> DataFrame:
    """Averages of a series with missing days and months: a gap keeps the average."""
    df = _close(t).withColumn("close", F.expr(GAPS))
    out = ewm(indexed(df), {"ema_5": Ewm("close", span(5)), "ema_14": Ewm("close", span(14), 14)})
    return rounded(out.select("company_id", "date", "ema_5", "ema_14"), 4)


DIFFS = """diffs AS (SELECT company_id, date, greatest(d, 0) AS up, greatest(-d, 0) AS down FROM (
  SELECT company_id, date, close - lag(close) OVER (PARTITION BY company_id ORDER BY date) AS d FROM market_data) WHERE d IS NOT NULL)"""
RSI_CTE = DIFFS + ",\n" + recurrence_sql("u", "diffs", "up", "1.0::DOUBLE / 14") + ",\n" + recurrence_sql(
    "dn", "diffs", "down", "1.0::DOUBLE / 14")


@query("rsi_wilder", with_tables(f"""SELECT m.company_id, m.date, CASE WHEN u.n >= 14 THEN
    {rnd('100 * u.y / nullif(u.y + dn.y, 0)', 6)} END AS rsi_14 FROM market_data m LEFT JOIN u USING (company_id, date)
    LEFT JOIN dn USING (company_id, date)""", "market_data", extra=RSI_CTE))
def rsi_wilder(t: Tables) -> DataFrame:
    df = ewm(rsi_inputs(indexed(_close(t))), {"u": Ewm("_up", 1 / 14), "d": Ewm("_down", 1 / 14, like="_up")})
    rsi = F.when(F.col("_i") >= 14, rsi_from("u", "d"))
    return rounded(df.select("company_id", "date", rsi.alias("rsi_14")), 6)


@query("rsi_sma", with_tables(f"""SELECT company_id, date, {rnd('100 - 100 / (1 + up / nullif(down, 0))', 6)} AS rsi_14 FROM (
    SELECT company_id, date, {roll('avg', 'greatest(d, 0)', 14)} AS up, {roll('avg', 'greatest(-d, 0)', 14)} AS down FROM (
    SELECT company_id, date, CASE WHEN rn > 1 THEN close - l END AS d FROM (SELECT company_id, date, close,
     lag(close) OVER w AS l, row_number() OVER w AS rn FROM market_data {WIN})))""".replace(
    "greatest(d, 0)", "CASE WHEN d IS NOT NULL THEN greatest(d, 0) END").replace(
    "greatest(-d, 0)", "CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END"), "market_data"))
def rsi_sma(t: Tables) -> DataFrame:
    df = rsi_inputs(indexed(_close(t)))
    up, down = tw.rolling(F.avg, "_up", 14, tw.series()), tw.rolling(F.avg, "_down", 14, tw.series())
    return rounded(df.select("company_id", "date", (100.0 - 100.0 / (1.0 + tw.ratio(up, down))).alias("rsi_14")), 6)


def macd_cte(seeded: bool, source: str = "market_data") -> str:
    k = (12, 26, 9) if seeded else (1, 1, 1)
    return (recurrence_sql("fa", source, "close", "2.0::DOUBLE / 13", k[0]) + ",\n"
            + recurrence_sql("sl", source, "close", "2.0::DOUBLE / 27", k[1])
            + ",\nmc AS (SELECT company_id, date, fa.y - sl.y AS macd FROM fa JOIN sl USING (company_id, date)),\n"
            + recurrence_sql("sg", "mc", "macd", "0.2::DOUBLE", k[2]))


MACD_OUT = f"""SELECT m.company_id, m.date, {rnd('mc.macd', 4)} AS macd, {rnd('sg.y', 4)} AS macd_signal,
    {rnd('mc.macd - sg.y', 4)} AS macd_hist FROM market_data m LEFT JOIN mc USING (company_id, date)
    LEFT JOIN sg USING (company_id, date)"""


@query("macd_seeded", with_tables(MACD_OUT, "market_data", extra=macd_cte(True)))
def macd_seeded(t: Tables) -> DataFrame:
    return rounded(with_averages(_close(t)).select("company_id", "date", "macd", "macd_signal", "macd_hist"), 4)


@query("macd_plain", with_tables(MACD_OUT, "market_data", extra=macd_cte(False)))
def macd_plain(t: Tables) -> DataFrame:
    return rounded(with_averages(_close(t), seeded=False).select("company_id", "date", "macd", "macd_signal", "macd_hist"), 4)


@query("bollinger", with_tables(f"""SELECT company_id, date, {rnd('m + 2 * s', 4)} AS bollinger_upper, {rnd('m - 2 * s', 4)} AS bollinger_lower
    FROM (SELECT company_id, date, {roll('avg', 'close', 14)} AS m, {roll('stddev_pop', 'close', 14)} AS s FROM market_data)""", "market_data"))
def bollinger(t: Tables) -> DataFrame:
    upper, lower = tw.bollinger("close", 14, 2.0, tw.series())
    return rounded(_close(t).select("company_id", "date", upper.alias("bollinger_upper"), lower.alias("bollinger_lower")), 4)


@query("momentum", with_tables(f"SELECT company_id, date, close - lag(close, 10) OVER w AS momentum FROM market_data {WIN}", "market_data"))
def momentum(t: Tables) -> DataFrame:
    return _close(t).select("company_id", "date", tw.difference("close", 10, tw.series()).alias("momentum"))


@query("stochastic", with_tables(f"""SELECT company_id, date, {rnd(roll('avg', 'k', 3), 6)} AS stochastic FROM (
    SELECT company_id, date, 100 * (close - ll) / nullif(hh - ll, 0) AS k FROM (
    SELECT company_id, date, close, {roll('min', 'low', 14)} AS ll, {roll('max', 'high', 14)} AS hh FROM market_data))""", "market_data"))
def stochastic(t: Tables) -> DataFrame:
    df = t.bars.withColumn("k", tw.stochastic_raw("high", "low", "close", 14, tw.series()))
    return rounded(df.select("company_id", "date", tw.rolling(F.avg, "k", 3, tw.series()).alias("stochastic")), 6)


@query("volume_pressure", with_tables(f"""SELECT company_id, date, {rnd('volume / nullif(' + roll('avg', 'volume', 20) + ', 0) - 1')} AS vol_pressure_20d
    FROM market_data""", "market_data"))
def volume_pressure(t: Tables) -> DataFrame:
    return rounded(t.bars.select("company_id", "date", tw.volume_pressure("volume", 20, tw.series()).alias("vol_pressure_20d")))


FILLED = "last_value({0} IGNORE NULLS) OVER (PARTITION BY company_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("pct_change", with_tables(f"""SELECT company_id, date, {rnd('rv / nullif(lag(rv, 4) OVER w, 0) - 1')} AS revenue_yoy,
    {rnd('eb / nullif(lag(eb, 4) OVER w, 0) - 1')} AS ebitda_yoy, {rnd('np / nullif(lag(np, 4) OVER w, 0) - 1')} AS net_profit_yoy
    FROM (SELECT company_id, date, {FILLED.format('revenue')} AS rv, {FILLED.format('ebitda')} AS eb,
     {FILLED.format('net_profit')} AS np FROM fundamentals) {WIN}""", "fundamentals"))
def pct_change(t: Tables) -> DataFrame:
    return rounded(t.fundamentals.select("company_id", "date", *[
        tw.pct_change(c, 4, tw.series()).alias(f"{c}_yoy") for c in ("revenue", "ebitda", "net_profit")]))


@query("ffill", with_tables(f"SELECT company_id, date, {FILLED.format('ebitda')} AS ebitda FROM fundamentals", "fundamentals"))
def ffill(t: Tables) -> DataFrame:
    return t.fundamentals.select("company_id", "date", tw.ffill("ebitda", tw.series()).alias("ebitda"))


@query("bfill", with_tables(f"""SELECT company_id, date, coalesce({FILLED.format('ebitda')}, first_value(ebitda IGNORE NULLS) OVER (
    PARTITION BY company_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS ebitda FROM fundamentals""", "fundamentals"))
def bfill(t: Tables) -> DataFrame:
    return t.fundamentals.select("company_id", "date", F.coalesce(tw.ffill("ebitda", tw.series()), tw.bfill("ebitda", tw.series())).alias("ebitda"))


TARGET = "ln(lead(close, 5) OVER (PARTITION BY company_id ORDER BY date)) - ln(close)"


@query("target_log", with_tables(f"SELECT company_id, date, {rnd(TARGET)} AS y FROM market_data", "market_data"))
def target_log(t: Tables) -> DataFrame:
    return rounded(_close(t).select("company_id", "date", tw.forward_log_return("close", 5, tw.series()).alias("y")))


@query("target_direction", with_tables(f"""SELECT company_id, date, CASE WHEN y > 0 THEN 1 WHEN y IS NOT NULL THEN 0 END AS y,
    CASE WHEN y > 0 THEN 1 ELSE 0 END AS y_tail_zero FROM (SELECT company_id, date, {TARGET} AS y FROM market_data)""", "market_data"))
def target_direction(t: Tables) -> DataFrame:
    y = tw.forward_log_return("close", 5, tw.series())
    return _close(t).select("company_id", "date", tw.direction(y).alias("y"), tw.direction(y, tail_zero=True).alias("y_tail_zero"))


@query("winsorize", with_tables(f"""SELECT company_id, date, CASE WHEN y IS NOT NULL THEN {rnd('least(greatest(y, lo), hi)')} END AS y FROM (
    SELECT company_id, date, y, quantile_cont(y, 0.005) OVER (PARTITION BY company_id) AS lo,
     quantile_cont(y, 0.995) OVER (PARTITION BY company_id) AS hi FROM (SELECT company_id, date, {TARGET} AS y FROM market_data))""", "market_data"))
def winsorize(t: Tables) -> DataFrame:
    df = _close(t).select("company_id", "date", tw.forward_log_return("close", 5, tw.series()).alias("y"))
    return rounded(winsorize_by_key(df, "y", 0.005))


def exog_sql(cols: tuple[str, ...], fill: bool) -> str:
    f = "last_value({0} IGNORE NULLS) OVER (PARTITION BY company_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND {1} PRECEDING)"
    out = []
    for c in cols:
        lag1 = f.format(c, 1) if fill else f"lag({c}) OVER (PARTITION BY company_id ORDER BY date)"
        out.append(f"{rnd(lag1, 4)} AS {c}_lag1")
        out += [f"{rnd(f'{f.format(c, 1)} / nullif({f.format(c, n + 1)}, 0) - 1')} AS {c}_chg_{n}d" for n in (21, 63)]
    return ", ".join(out)


@query("exog_lags", with_tables(f"""SELECT company_id, date, {exog_sql(('ebitda', 'revenue'), True)} FROM (
    SELECT m.company_id, m.date, f.revenue, f.ebitda FROM market_data m ASOF LEFT JOIN fundamentals f
    ON m.company_id = f.company_id AND m.date >= f.date)""", "market_data", "fundamentals"))
def exog_lags(t: Tables) -> DataFrame:
    df = asof_by_key(t.market_data.select("company_id", "date", "close"),
                     t.fundamentals.select("company_id", "date", "revenue", "ebitda"), parts=t.parts)
    cols = exog_lag_columns(["ebitda", "revenue"], tw.series(), fill=True)
    out = df.select("company_id", "date", *[c.alias(n) for n, c in cols.items()])
    return rounded(out, {n: 4 for n in out.columns if n.endswith("lag1")})


@query("math_fns", f"""SELECT l_orderkey, l_linenumber, {rnd('ln(l_extendedprice)')} AS ln_price, {rnd('exp(-l_tax)')} AS decay,
    {rnd('sin(l_quantity)')} AS s, {rnd('cos(l_quantity)')} AS c, sign(l_discount - 0.05) AS sg, {rnd('abs(l_discount - 0.05)')} AS a,
    {rnd('sqrt(l_quantity)')} AS rt, least(greatest(l_quantity, 5), 45) AS clipped FROM lineitem""")
def math_fns(t: Tables) -> DataFrame:
    d, q = F.col("l_discount") - 0.05, F.col("l_quantity")
    return rounded(t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.log("l_extendedprice").alias("ln_price"), F.exp(-F.col("l_tax")).alias("decay"),
        F.sin(q).alias("s"), F.cos(q).alias("c"), F.signum(d).cast("int").alias("sg"), F.abs(d).alias("a"),
        F.sqrt(q).alias("rt"), F.least(F.greatest(q, F.lit(5.0)), F.lit(45.0)).alias("clipped")))
