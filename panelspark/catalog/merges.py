"""Key merges and table maintenance (K1-K11, U-1, W25-W27).

Base tables are the older part of a derived table and updates overlap it, so
each merge meets stored, new and changed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge as mg
from ..operators.dedup import latest_per_key, one_per_key
from ..operators.joins import anti_existing
from ..operators.news import link_rows
from ..session import scratch_path
from ..sources.panel_store import merge_into, read_panel, write_panel
from ..sources.readers import read_csv, read_table
from ..sources.writers import append, write_csv
from .registry import query
from .tables import Tables, with_tables

KEYS = ["company_id", "date"]
BASE_SQL = """base AS (SELECT company_id, date, close, volume FROM market_data WHERE date < DATE '1997-01-01'),
upd AS (SELECT company_id, date, close * 2 AS close, volume + 1 AS volume FROM market_data WHERE date >= DATE '1996-06-01')"""


def _base_and_updates(t: Tables) -> tuple[DataFrame, DataFrame]:
    bars = t.market_data.select("company_id", "date", "close", "volume")
    base = bars.where(F.col("date") < F.lit("1997-01-01").cast("date"))
    upd = bars.where(F.col("date") >= F.lit("1996-06-01").cast("date")).select(
        "company_id", "date", (F.col("close") * 2).alias("close"), (F.col("volume") + 1).alias("volume"))
    return base, upd


@query("merge_ignore", with_tables("""SELECT * FROM base UNION ALL SELECT * FROM upd u WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.company_id = u.company_id AND b.date = u.date)""", "market_data", extra=BASE_SQL))
def merge_ignore(t: Tables) -> DataFrame:
    return mg.insert_ignore(*_base_and_updates(t), KEYS)


@query("merge_replace", with_tables("""SELECT * FROM upd UNION ALL SELECT * FROM base b WHERE NOT EXISTS (
    SELECT 1 FROM upd u WHERE b.company_id = u.company_id AND b.date = u.date)""", "market_data", extra=BASE_SQL))
def merge_replace(t: Tables) -> DataFrame:
    return mg.upsert_replace(*_base_and_updates(t), KEYS)


MACRO_NEW = "date, gdp * 2 AS gdp, cpi + 1 AS cpi, unemployment_rate + 1 AS unemployment_rate, interest_rate, exchange_rate_eur, exchange_rate_usd"


@query("merge_columns", with_tables("""SELECT coalesce(b.date, n.date) AS date, coalesce(n.gdp, b.gdp) AS gdp,
    coalesce(n.cpi, b.cpi) AS cpi, coalesce(n.unemployment_rate, b.unemployment_rate) AS unemployment_rate,
    coalesce(n.interest_rate, b.interest_rate) AS interest_rate,
    coalesce(n.exchange_rate_eur, b.exchange_rate_eur) AS exchange_rate_eur,
    coalesce(n.exchange_rate_usd, b.exchange_rate_usd) AS exchange_rate_usd
    FROM base b FULL JOIN news n ON b.date = n.date""", "macro_data", extra=f"""
base AS (SELECT * FROM macro_data WHERE date < DATE '1997-01-01'),
news AS (SELECT {MACRO_NEW} FROM macro_data WHERE date >= DATE '1995-01-01' AND
  (gdp IS NOT NULL OR cpi IS NOT NULL OR unemployment_rate IS NOT NULL OR interest_rate IS NOT NULL
   OR exchange_rate_eur IS NOT NULL OR exchange_rate_usd IS NOT NULL))"""))
def merge_columns(t: Tables) -> DataFrame:
    base = t.macro_data.where(F.col("date") < F.lit("1997-01-01").cast("date"))
    change = {"gdp": lambda v: v * 2, "cpi": lambda v: v + 1, "unemployment_rate": lambda v: v + 1}
    sources = {c: s.where(F.col("date") >= F.lit("1995-01-01").cast("date")).withColumn(
        "value", change.get(c, lambda v: v)(F.col("value"))) for c, s in t.macro_series.items()}
    return mg.merge_columns(base, sources)


@query("merge_fill_empty", with_tables("""SELECT coalesce(b.url, n.url) AS url, coalesce(b.id, n.id) AS id,
    CASE WHEN b.url IS NULL THEN n.date WHEN coalesce(b.content, '') = '' AND n.url IS NOT NULL THEN coalesce(n.date, b.date) ELSE b.date END AS date,
    CASE WHEN b.url IS NULL THEN n.headline WHEN coalesce(b.content, '') = '' AND n.url IS NOT NULL
     THEN CASE WHEN coalesce(n.headline, '') = '' THEN b.headline ELSE n.headline END ELSE b.headline END AS headline,
    CASE WHEN b.url IS NULL OR (coalesce(b.content, '') = '' AND n.url IS NOT NULL) THEN n.content ELSE b.content END AS content,
    coalesce(b.source, n.source) AS source FROM base b FULL JOIN news n ON b.url = n.url""", "news_articles", extra="""
base AS (SELECT id, date, headline, CASE WHEN id % 4 = 0 THEN '' WHEN id % 4 = 1 THEN NULL ELSE content END AS content, url, source
  FROM news_articles WHERE source <> 'src3'),
news AS (SELECT id, date + 1 AS date, CASE WHEN id % 8 = 0 THEN '' ELSE concat('new ', headline) END AS headline, content, url, source
  FROM news_articles WHERE source <> 'src5')"""))
def merge_fill_empty(t: Tables) -> DataFrame:
    n, i = t.news_articles, F.col("id")
    base = n.where(F.col("source") != "src3").withColumn("content", F.when(i % 4 == 0, "").when(i % 4 != 1, F.col("content")))
    upd = n.where(F.col("source") != "src5").withColumns({
        "date": F.date_add("date", 1), "headline": F.when(i % 8 == 0, "").otherwise(F.concat(F.lit("new "), "headline"))})
    return mg.fill_if_empty(base, upd)


@query("high_water", with_tables("""SELECT m.company_id, m.date, m.close FROM market_data m
    LEFT JOIN (SELECT company_id, max(date) AS hw FROM fundamentals WHERE revenue < 900000 AND date < DATE '1998-06-30' GROUP BY company_id) f
    ON f.company_id = m.company_id WHERE hw IS NULL OR m.date > hw""", "market_data", "fundamentals"))
def high_water(t: Tables) -> DataFrame:
    stored = t.fundamentals.where((F.col("revenue") < 900000) & (F.col("date") < F.lit("1998-06-30").cast("date")))
    return mg.after_high_water(t.market_data.select("company_id", "date", "close"), stored)


@query("news_high_water", with_tables("SELECT max(date) AS mark FROM news_articles", "news_articles"))
def news_high_water(t: Tables) -> DataFrame:
    return mg.latest_mark(t.news_articles, default=F.current_date())


@query("sanitize", """SELECT CAST(l_suppkey AS INT) AS company_id, CAST(l_shipdate AS DATE) AS date, l_linenumber,
    CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS x FROM lineitem""")
def sanitize(t: Tables) -> DataFrame:
    raw = t.raw("lineitem").select(
        F.col("l_suppkey").cast("int").alias("company_id"), F.col("l_shipdate").alias("date"), "l_linenumber",
        F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), float("nan"))
        .when(F.col("l_discount") == 0, float("inf")).otherwise(F.try_divide("l_tax", "l_discount")).alias("x"))
    return mg.sanitize(raw, dates=["date"])


@query("news_links", with_tables("""SELECT DISTINCT n.news_article_id, n.company_id, c.sector_id, n.context_tag_id, n.confidence_score
    FROM fresh n LEFT JOIN companies c ON c.id = n.company_id WHERE NOT EXISTS (SELECT 1 FROM news_links s
    WHERE s.news_article_id = n.news_article_id AND s.company_id = n.company_id)""", "news_links", "companies", extra="""
fresh AS (SELECT CAST(doc_id AS INT) AS news_article_id, CAST(unnest([doc_id * 7 % 97, doc_id * 3 % 41, doc_id * 3 % 41]) AS INT) AS company_id,
  CAST(doc_id % 10 AS INT) AS context_tag_id, (doc_id % 100) / 100.0::DOUBLE AS confidence_score FROM documents)"""))
def news_links(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    found = t.raw("documents").select(d.cast("int").alias("news_article_id"), F.explode(
        F.array(d * 7 % 97, d * 3 % 41, d * 3 % 41).cast("array<int>")).alias("company_id"))
    labels = t.raw("documents").select(d.cast("int").alias("news_article_id"), (d % 10).cast("int").alias("context_tag_id"),
                                       (d % 100 / 100.0).alias("confidence_score"))
    return link_rows(found, labels, t.companies, t.news_links)


@query("union_batches", with_tables("""SELECT company_id, date, close, volume, NULL::DOUBLE AS open FROM base
    UNION ALL SELECT company_id, date, close, NULL, open FROM market_data WHERE date >= DATE '1997-01-01'""",
                                    "market_data", extra=BASE_SQL))
def union_batches(t: Tables) -> DataFrame:
    base, _ = _base_and_updates(t)
    later = t.market_data.where(F.col("date") >= F.lit("1997-01-01").cast("date")).select("company_id", "date", "close", "open")
    return base.unionByName(later, allowMissingColumns=True)


LINES = """lines AS (SELECT CAST(l_suppkey AS INT) AS company_id, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber,
  l_partkey, l_quantity, l_extendedprice FROM lineitem)"""
LINE_ORDER = "l_orderkey {0}, l_linenumber {0}, l_partkey {0}, l_quantity {0}, l_extendedprice {0}"


def _lines(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(
        F.col("l_suppkey").cast("int").alias("company_id"), F.col("l_shipdate").cast("date").alias("date"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


@query("dedup_last", with_tables(f"""SELECT * FROM lines QUALIFY row_number() OVER (
    PARTITION BY company_id, date ORDER BY {LINE_ORDER.format('DESC')}) = 1""", extra=LINES))
def dedup_last(t: Tables) -> DataFrame:
    return one_per_key(_lines(t), KEYS, ORDER)


@query("dedup_first", with_tables(f"""SELECT * FROM lines QUALIFY row_number() OVER (
    PARTITION BY company_id, date ORDER BY {LINE_ORDER.format('ASC')}) = 1""", extra=LINES))
def dedup_first(t: Tables) -> DataFrame:
    return one_per_key(_lines(t), KEYS, ORDER, keep="first")


@query("latest_selection", with_tables("""SELECT sector_id, run_date, model_type, selected_features, total_features,
    list_transform(list_sort(list_transform(range(1, 5), lambda i: ['revenue', 'operating_profit', 'gross_profit', 'net_profit'][i] || '='
     || (1 + len(list_filter(measures, lambda m: m > measures[i]))))), lambda s: s) AS ranks FROM selected_features
    QUALIFY row_number() OVER (PARTITION BY sector_id ORDER BY run_date DESC) = 1""", "selected_features"))
def latest_selection(t: Tables) -> DataFrame:
    """Whole records, their map of ranks included."""
    newest = latest_per_key(t.selected_features.drop("company_id"), ["sector_id"], "run_date")
    text = F.transform(F.map_entries("feature_importances"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return newest.withColumn("ranks", F.array_sort(text)).drop("feature_importances")


@query("append_rows", with_tables("""SELECT company_id, date, close, volume FROM base UNION ALL SELECT company_id, date, close, volume FROM upd
    UNION ALL SELECT company_id, date, close, volume FROM upd WHERE company_id % 2 = 0""", "market_data", extra=BASE_SQL))
def append_rows(t: Tables) -> DataFrame:
    """A table and two batches added to it, the second of which repeats rows of the first."""
    path = scratch_path(t.spark, "appended")
    base, upd = _base_and_updates(t)
    for part in (base, upd, upd.where(F.col("company_id") % 2 == 0)):
        append(part.withColumn("month", F.date_format("date", "yyyy-MM")), path, ["month"])
    return read_table(t.spark, path).drop("month")


CSV = "company_id int, date date, close double, note string, day timestamp"


@query("csv_sink", with_tables("""SELECT company_id, date, close, CASE company_id % 4 WHEN 0 THEN 'a, "quoted" text' WHEN 1 THEN 'two' || chr(10) || 'lines'
    WHEN 2 THEN NULL ELSE 'ż;' END AS note, CAST(date AS TIMESTAMP) AS day FROM market_data""", "market_data"))
def csv_sink(t: Tables) -> DataFrame:
    """Rows written with a header and read back under a declared schema, with quotes, line ends and NULLs."""
    path = scratch_path(t.spark, "csv")
    k = F.col("company_id") % 4
    note = F.when(k == 0, 'a, "quoted" text').when(k == 1, "two\nlines").when(k == 3, "ż;")
    write_csv(t.market_data.select("company_id", "date", "close", note.alias("note"), F.col("date").cast("timestamp").alias("day")), path)
    return read_csv(t.spark, path, CSV)


@query("merge_stored", with_tables("""SELECT * FROM upd UNION ALL SELECT * FROM base b WHERE NOT EXISTS (
    SELECT 1 FROM upd u WHERE b.company_id = u.company_id AND b.date = u.date)""", "market_data", extra=BASE_SQL))
def merge_stored(t: Tables) -> DataFrame:
    """A batch merged into a stored panel: the years that it does not touch stay as they are."""
    path = scratch_path(t.spark, "merged")
    base, upd = _base_and_updates(t)
    write_panel(base, path)
    merge_into(path, upd, lambda old, new: mg.upsert_replace(old, new, KEYS))
    return read_panel(t.spark, path)


@query("existing_keys", with_tables("""SELECT company_id, date FROM upd u WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.company_id = u.company_id AND b.date = u.date)""", "market_data", extra=BASE_SQL))
def existing_keys(t: Tables) -> DataFrame:
    base, upd = _base_and_updates(t)
    return anti_existing(upd.select(*KEYS), base.select(*KEYS), KEYS)
