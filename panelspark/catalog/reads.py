"""Scans and read predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..operators import reads as rd
from ..operators import windows as tw
from ..operators.merge import sanitize
from ..sources.panel_store import read_panel
from .registry import query
from .tables import Tables, with_tables

BAR = "company_id, date, open, high, low, close, volume"
DAY, FROM, TO = date(1997, 3, 3), date(1998, 1, 1), date(1996, 6, 30)


def _bars(t: Tables, **predicates) -> DataFrame:
    """Rows of the stored bars."""
    return read_panel(t.spark, t.stored("market_data"), **predicates)


@query("scan_market", with_tables("SELECT date, close FROM market_data WHERE company_id = 7", "market_data"))
def scan_market(t: Tables) -> DataFrame:
    return _bars(t, company_id=7).select("date", "close").orderBy("date")


@query("scan_macro", with_tables("SELECT * FROM macro_data", "macro_data"))
def scan_macro(t: Tables) -> DataFrame:
    return t.macro_data.orderBy("date")


@query("scan_fundamentals", with_tables(
    "SELECT date, revenue, operating_profit, gross_profit, net_profit, ebitda FROM fundamentals WHERE company_id = 7",
    "fundamentals"))
def scan_fundamentals(t: Tables) -> DataFrame:
    return read_panel(t.spark, t.stored("fundamentals"), company_id=7).drop("company_id").orderBy("date")


@query("dim_companies", with_tables("SELECT id, ticker FROM companies", "companies"))
def dim_companies(t: Tables) -> DataFrame:
    return t.companies.select("id", "ticker")


@query("read_all", with_tables(f"SELECT {BAR} FROM market_data", "market_data"))
def read_all(t: Tables) -> DataFrame:
    return t.market_data


@query("read_by_key", with_tables(
    "SELECT id, ticker, name, sector_id, is_active FROM companies WHERE ticker = 'Supplier#000000003'", "companies"))
def read_by_key(t: Tables) -> DataFrame:
    return rd.first_where(t.companies, ticker="Supplier#000000003").drop("groups")


@query("read_by_company", with_tables(f"SELECT {BAR} FROM market_data WHERE company_id = 3", "market_data"))
def read_by_company(t: Tables) -> DataFrame:
    return _bars(t, company_id=3)


@query("read_by_date", with_tables(f"SELECT {BAR} FROM market_data WHERE date = DATE '1997-03-03'", "market_data"))
def read_by_date(t: Tables) -> DataFrame:
    return _bars(t, date=DAY)


@query("read_from_date", with_tables(f"SELECT {BAR} FROM market_data WHERE date >= DATE '1998-01-01'", "market_data"))
def read_from_date(t: Tables) -> DataFrame:
    return _bars(t, date_from=FROM)


@query("read_to_date", with_tables(f"SELECT {BAR} FROM market_data WHERE date <= DATE '1996-06-30'", "market_data"))
def read_to_date(t: Tables) -> DataFrame:
    return _bars(t, date_to=TO)


@query("read_range", with_tables(
    "SELECT trade_date, is_trading_day FROM trading_sessions WHERE trade_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
    "trading_sessions"))
def read_range(t: Tables) -> DataFrame:
    return rd.read_where(t.trading_sessions, date_from=date(1996, 1, 1), date_to=date(1996, 12, 31), on="trade_date")


@query("read_company_date", with_tables(
    f"SELECT {BAR} FROM market_data WHERE company_id = 5 AND date >= DATE '1998-01-01'", "market_data"))
def read_company_date(t: Tables) -> DataFrame:
    return _bars(t, company_id=5, date_from=FROM)


@query("read_source", with_tables("SELECT id, date, url, source FROM news_articles WHERE source = 'src3'", "news_articles"))
def read_source(t: Tables) -> DataFrame:
    return rd.read_where(t.news_articles, source="src3").select("id", "date", "url", "source")


@query("read_group", with_tables(
    "SELECT id, ticker, sector_id FROM companies WHERE list_contains(groups, 'a1') AND is_active", "companies"))
def read_group(t: Tables) -> DataFrame:
    return rd.in_group(t.companies, "a1").select("id", "ticker", "sector_id")


@query("read_in", with_tables(f"""SELECT {BAR} FROM market_data WHERE company_id IN (2, 4, 6)
    UNION ALL SELECT {BAR} FROM market_data WHERE company_id IN (SELECT id FROM companies WHERE sector_id = 12)""",
                              "market_data", "companies"))
def read_in(t: Tables) -> DataFrame:
    members = rd.read_where(t.companies, sector_id=12).select("id")
    return _bars(t, members=("company_id", [2, 4, 6])).unionByName(_bars(t, members=("company_id", members)))


@query("read_verified", with_tables(
    "SELECT news_article_id, company_id, confidence_score FROM news_links WHERE confidence_score >= 0.7", "news_links"))
def read_verified(t: Tables) -> DataFrame:
    return rd.at_least(t.news_links, "confidence_score", 0.7).select("news_article_id", "company_id", "confidence_score")


@query("dropna", with_tables("""SELECT company_id, date, revenue, ebitda FROM fundamentals
    WHERE ebitda IS NOT NULL AND revenue IS NOT NULL""", "fundamentals"))
def dropna(t: Tables) -> DataFrame:
    return sanitize(t.fundamentals).na.drop(subset=["revenue", "ebitda"]).select("company_id", "date", "revenue", "ebitda")


@query("min_history", with_tables(
    "SELECT company_id, date, close FROM market_data QUALIFY count(*) OVER (PARTITION BY company_id) >= 530", "market_data"))
def min_history(t: Tables) -> DataFrame:
    return tw.min_history(t.market_data.select("company_id", "date", "close"), 530)


@query("drop_all_null_cols", with_tables("""SELECT company_id, date, revenue, operating_profit, gross_profit, net_profit, ebitda
    FROM fundamentals WHERE company_id = 4""", "fundamentals"))
def drop_all_null_cols(t: Tables) -> DataFrame:
    """The bank measures of this company hold no value, so their columns go."""
    wide = rd.read_where(t.fundamentals, company_id=4).withColumns(
        {c: F.lit(None).cast("double") for c in ("interest_income", "fee_income", "eps")})
    return rd.drop_all_null_columns(wide)


@query("sorted_panel", with_tables("SELECT company_id, date, close FROM market_data", "market_data"))
def sorted_panel(t: Tables) -> DataFrame:
    return t.market_data.select("company_id", "date", "close").orderBy("company_id", "date")


@query("first_desc", with_tables("SELECT id, date FROM news_articles ORDER BY date DESC, id DESC LIMIT 1", "news_articles"))
def first_desc(t: Tables) -> DataFrame:
    return t.news_articles.select("id", "date").orderBy(F.col("date").desc(), F.col("id").desc()).limit(1)


@query("last_n", with_tables("""SELECT company_id, date, close FROM market_data
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) <= 220""", "market_data"))
def last_n(t: Tables) -> DataFrame:
    return tw.last_n(t.market_data.select("company_id", "date", "close"), 220)


@query("last_row", with_tables(f"""SELECT {BAR} FROM market_data
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) = 1""", "market_data"))
def last_row(t: Tables) -> DataFrame:
    return ag.last_row(t.market_data)


@query("distinct_sector", with_tables("SELECT DISTINCT sector_id FROM companies", "companies"))
def distinct_sector(t: Tables) -> DataFrame:
    return t.companies.select("sector_id").distinct()
