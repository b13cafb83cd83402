"""Joins and calendar grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as jn
from ..operators import reads as rd
from .registry import query
from .tables import Tables, with_tables


@query("asof_fundamentals", with_tables("""SELECT m.company_id, m.date, m.close, f.revenue, f.operating_profit, f.net_profit, f.ebitda
    FROM market_data m ASOF LEFT JOIN fundamentals f ON m.company_id = f.company_id AND m.date >= f.date""",
                                        "market_data", "fundamentals"))
def asof_fundamentals(t: Tables) -> DataFrame:
    return jn.asof_by_key(t.market_data.select("company_id", "date", "close"),
                          t.fundamentals.select("company_id", "date", "revenue", "operating_profit", "net_profit", "ebitda"), parts=t.parts)


@query("asof_macro", with_tables("""SELECT m.company_id, m.date, m.close, f.gdp, f.cpi, f.unemployment_rate, f.interest_rate,
    f.exchange_rate_eur, f.exchange_rate_usd FROM market_data m ASOF LEFT JOIN macro_data f ON m.date >= f.date""",
                                 "market_data", "macro_data"))
def asof_macro(t: Tables) -> DataFrame:
    return jn.asof_series(t.market_data.select("company_id", "date", "close"), t.macro_data)


GRID = """SELECT id AS company_id, CAST(d AS DATE) AS date FROM (SELECT id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d
    FROM companies, (SELECT CAST(min(date) AS TIMESTAMP) AS a, CAST(max(date) AS TIMESTAMP) AS b FROM market_data) WHERE is_active)
    WHERE isodow(d) <= 5"""


def _grid(t: Tables) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    ends = t.raw("lineitem").agg(F.struct(F.min(day).alias("a"), F.max(day).alias("b")).alias("v"))
    keys = t.companies.where("is_active").select(F.col("id").alias("company_id"),
                                                 ends.select("v").scalar().alias("e"))
    return jn.business_day_grid(keys, "e.a", "e.b").select("company_id", "date")


@query("bday_grid", with_tables(GRID, "companies", "market_data"))
def bday_grid(t: Tables) -> DataFrame:
    return _grid(t)


@query("skeleton_join", with_tables(f"""SELECT g.company_id, g.date, m.open, m.close, m.volume FROM ({GRID}) g
    LEFT JOIN market_data m ON m.company_id = g.company_id AND m.date = g.date""", "companies", "market_data"))
def skeleton_join(t: Tables) -> DataFrame:
    bars = t.market_data.select("company_id", "date", "open", "close", "volume")
    return _grid(t).join(bars, ["company_id", "date"], "left")


@query("daily_densify", with_tables("""SELECT s.company_id, s.date, f.revenue, f.ebitda FROM (
    SELECT company_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT company_id, min(date) AS a, max(date) AS b FROM fundamentals GROUP BY company_id)) s
    LEFT JOIN fundamentals f ON f.company_id = s.company_id AND f.date = s.date""", "fundamentals"))
def daily_densify(t: Tables) -> DataFrame:
    return jn.daily_densify(t.fundamentals.select("company_id", "date", "revenue", "ebitda"), "company_id")


@query("anti_existing", with_tables("""SELECT company_id, date, close FROM market_data m WHERE NOT EXISTS (
    SELECT 1 FROM fundamentals f WHERE f.company_id = m.company_id AND f.date = m.date)""", "market_data", "fundamentals"))
def anti_existing(t: Tables) -> DataFrame:
    return jn.anti_existing(t.market_data.select("company_id", "date", "close"), t.fundamentals, ["company_id", "date"])


@query("news_unlabelled", with_tables("""SELECT id, date, source FROM news_articles
    WHERE id NOT IN (SELECT news_article_id FROM news_links)""", "news_articles", "news_links"))
def news_unlabelled(t: Tables) -> DataFrame:
    return rd.unlabelled(t.news_articles, t.news_links).select("id", "date", "source")


def _news(name: str, column: str, value: int) -> None:
    body = "SELECT id, date, url, source FROM news_articles WHERE id IN (SELECT news_article_id FROM news_links WHERE "

    @query(f"news_by_{name}", with_tables(f"{body}{column} = {value})", "news_articles", "news_links"))
    def plain(t: Tables) -> DataFrame:
        return rd.news_of(t.news_articles, t.news_links, **{column: value}).select("id", "date", "url", "source")

    @query(f"news_verified_by_{name}", with_tables(
        f"{body}{column} = {value} AND confidence_score >= 0.7)", "news_articles", "news_links"))
    def verified(t: Tables) -> DataFrame:
        return rd.news_of(t.news_articles, t.news_links, min_confidence=0.7, **{column: value}).select(
            "id", "date", "url", "source")


_news("company", "company_id", 7)
_news("tag", "context_tag_id", 3)
_news("sector", "sector_id", 12)
