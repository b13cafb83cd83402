"""Company-by-date feature tables."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import windows as tw
from ..operators.aggregates import start_dates
from ..operators.joins import asof_by_key, asof_series, is_business_day
from ..operators.merge import keep_columns
from ..operators.reads import in_group

# Output columns of the bank table and of the transformed table.
BANK_COLUMNS = [
    "company_id", "date", "close",
    "interest_income", "fee_income", "banking_result", "gross_profit", "net_profit",
    "amortization", "assets", "equity", "shares_thousands", "bvps", "eps",
    "gdp", "cpi", "unemployment_rate", "interest_rate", "exchange_rate_eur", "exchange_rate_usd",
]
V3_COLUMNS = [
    "company_id", "date", "close", "volume",
    "ret_1d", "ret_5d", "ret_20d", "vol_10d", "vol_20d",
    "px_sma14_dist", "px_ema14_dist", "rsi_c", "macd_hist_norm", "macd_minus_signal",
    "vol_pressure_20d",
    "revenue_yoy", "ebitda_yoy", "net_profit_yoy", "gross_profit_yoy",
    "gdp_yoy", "cpi_yoy", "rate_change", "fx_eur_20d", "fx_usd_20d",
]
YOY_ROWS = {"revenue": 4, "ebitda": 4, "net_profit": 4, "gross_profit": 4, "gdp": 4, "cpi": 12}


def features_bank(companies: DataFrame, market: DataFrame, fundamentals: DataFrame | None,
                  macro: DataFrame | None, group: str) -> DataFrame:
    """Bars of a company group with the statements and macro values known on the day.

    Bars, statements and macro hold one row per key. The values are filled
    forward along the bars after the as-of joins; a missing side gives NULLs.
    """
    members = in_group(companies, group).select(F.col("id").alias("company_id"))
    out = market.join(members, "company_id", "left_semi").select("company_id", "date", "close")
    if fundamentals is not None:
        out = asof_by_key(out, fundamentals)
    if macro is not None:
        out = asof_series(out, macro)
    w = tw.series()
    known = [c for c in out.columns if c not in ("company_id", "date", "close")]
    out = out.select("company_id", "date", "close", *[tw.ffill(c, w).alias(c) for c in known])
    out = out.where(F.col("close").isNotNull())
    missing = [c for c in BANK_COLUMNS if c not in out.columns]
    out = out.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else out
    return keep_columns(out, BANK_COLUMNS)


def _base(companies: DataFrame, market: DataFrame, fundamentals: DataFrame, macro: DataFrame,
          end: Date | Column, mode: str, need: str, parts: int | None = None) -> DataFrame:
    """Bars on the business days of each sector's range, with as-of values.

    A left join of the business-day grid with the bars, followed by dropping the
    days without a bar, keeps exactly the bars on business days in the range;
    the grid itself is therefore not generated.
    """
    end = F.lit(end).cast("date") if not isinstance(end, Column) else end
    starts = start_dates(companies, market, fundamentals, macro, end, mode)
    active = (companies.where("is_active").select(F.col("id").alias("company_id"), "sector_id")
              .join(starts, "sector_id").drop("sector_id"))
    bars = (market.where(is_business_day("date") & (F.col("date") <= end) & F.col(need).isNotNull())
            .join(active, "company_id").where(F.col("date") >= F.col("start_date")).drop("start_date"))
    return asof_series(asof_by_key(bars, fundamentals, parts=parts), macro)


def features_v1(companies: DataFrame, indicators: DataFrame, fundamentals: DataFrame, macro: DataFrame,
                end: Date | Column, mode: str = "min", parts: int | None = None) -> DataFrame:
    """Indicator bars with as-of statements and macro values."""
    return _base(companies, indicators, fundamentals, macro, end, mode, "open", parts)


def features_v2(companies: DataFrame, market: DataFrame, fundamentals: DataFrame, macro: DataFrame,
                end: Date | Column, mode: str = "min", parts: int | None = None) -> DataFrame:
    """Raw bars with as-of statements and macro values."""
    return _base(companies, market, fundamentals, macro, end, mode, "open", parts)


def transforms_v3(df: DataFrame) -> DataFrame:
    """Scale-free features of a joined panel, in two window stages over one partitioning."""
    w = tw.series()
    changes = {f"{c}_yoy": tw.pct_change(c, k, w) for c, k in YOY_ROWS.items() if c in df.columns}
    fx = {f"fx_{c}_20d": tw.log_return(f"exchange_rate_{c}", 20, w) for c in ("eur", "usd")
          if f"exchange_rate_{c}" in df.columns}
    cols = {
        **{f"ret_{k}d": tw.log_return("close", k, w) for k in (1, 5, 20)},
        "vol_pressure_20d": tw.volume_pressure("volume", 20, w), **changes, **fx}
    if "interest_rate" in df.columns:
        cols["rate_change"] = tw.difference("interest_rate", 1, w)
    if "sma_14" in df.columns:
        ema = F.col("ema_14")
        cols |= {"px_sma14_dist": tw.ratio(F.col("close"), F.col("sma_14")) - 1.0,
                 "px_ema14_dist": tw.ratio(F.col("close"), ema) - 1.0,
                 "rsi_c": (F.col("rsi_14") - 50.0) / 50.0,
                 "macd_hist_norm": tw.ratio(F.col("macd_hist"), ema),
                 "macd_minus_signal": F.col("macd") - F.col("macd_signal")}
    df = df.select("*", *[c.alias(n) for n, c in cols.items()])
    return df.select("*", *[tw.rolling(F.stddev_samp, "ret_1d", n, w).alias(f"vol_{n}d") for n in (10, 20)])


def features_v3(companies: DataFrame, indicators: DataFrame, fundamentals: DataFrame, macro: DataFrame,
                end: Date | Column, mode: str = "min", parts: int | None = None) -> DataFrame:
    """Transformed features of the indicator bars."""
    out = transforms_v3(_base(companies, indicators, fundamentals, macro, end, mode, "close", parts))
    return keep_columns(out, V3_COLUMNS)

