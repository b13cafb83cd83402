"""The panel data model derived from the supplied tables, on Spark and in SQL.

Every method is a lazy DataFrame; nothing is cached or collected. ``CTE`` holds
the same derivations as DuckDB text for the twins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import by_key, parts_for, scratch_path, split_wide_code, spread
from ..sources.panel_store import write_panel


#: Tables that grow with the data; a single-file copy is spread over the cores.
LARGE = ("lineitem", "orders", "documents", "events")


#: Panels stored so far: (application, folder, name) to path.
_STORED: dict[tuple[str, str, str], str] = {}


class Tables:
    """Source tables of one folder and the panel tables made of them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        split_wide_code(spark)

    def raw(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(df) if name in LARGE else df

    def stored(self, name: str, build: Callable[[], DataFrame] | None = None) -> str:
        """Path of a derived panel in the shared folder, written the first time it is asked for in this application."""
        place = (self.spark.sparkContext.applicationId, self.folder, name)
        if place not in _STORED:
            path = scratch_path(self.spark, f"panel-{name}")
            write_panel(build() if build else getattr(self, name), path, parts=self.parts)
            _STORED[place] = path
        return _STORED[place]

    @cached_property
    def market_data(self) -> DataFrame:
        key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
        px = F.col("l_extendedprice") / F.col("l_quantity")
        lines = self.raw("lineitem").select(
            F.col("l_suppkey").cast("int").alias("company_id"), F.col("l_shipdate").cast("date").alias("date"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
        # the aggregate sorts its rows; lines dealt by its keys are sorted once, in tasks that do not grow with the table
        return (by_key(lines, self.parts, "company_id", "date").groupBy("company_id", "date")
                .agg(F.min_by(px, key).alias("open"), F.max(px).alias("high"),
                     F.min(px).alias("low"), F.max_by(px, key).alias("close"),
                     F.sum("l_quantity").cast("long").alias("volume")))

    @cached_property
    def parts(self) -> int | None:
        """Partitions of the window stages over bars, from the number of lines, which is read from the files' footers."""
        return parts_for(self.spark, self.spark.read.parquet(f"{self.folder}/lineitem.parquet").count())

    @cached_property
    def bars(self) -> DataFrame:
        """``market_data`` with each company in one partition, for windows; their number follows the data."""
        return by_key(self.market_data, self.parts, "company_id")

    @cached_property
    def fundamentals(self) -> DataFrame:
        zero = F.lit(0).cast("decimal(18,2)")
        ext, disc = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)")
        rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
        quarter_end = F.last_day(F.add_months(F.trunc(F.col("l_shipdate").cast("date"), "quarter"), 2))

        def total(c):
            return F.sum(c).cast("double")
        return (self.raw("lineitem")
                .groupBy(F.col("l_suppkey").cast("int").alias("company_id"), quarter_end.alias("date"))
                .agg(total(ext * (1 - disc)).alias("revenue"), total(ext * disc).alias("operating_profit"),
                     total(F.when(rf == "R", zero).otherwise(ext)).alias("gross_profit"),
                     total(F.when((ls == "F") & (rf == "N"), ext).otherwise(zero)).alias("net_profit"),
                     F.when(F.count(F.lit(1)) % 7 != 0, total(ext)).alias("ebitda")))

    @cached_property
    def macro_data(self) -> DataFrame:
        px, pr = F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderpriority")
        eur, usd = pr.isin("1-URGENT", "3-MEDIUM"), pr.isin("2-HIGH", "5-LOW")
        g = (self.raw("orders").groupBy(F.col("o_orderdate").cast("date").alias("date"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(px).cast("double").alias("s"),
                  F.max(px).cast("double").alias("mx"),
                  F.sum(F.when(eur, px)).cast("double").alias("se"), F.count(F.when(eur, 1)).alias("ne"),
                  F.sum(F.when(usd, px)).cast("double").alias("su"), F.count(F.when(usd, 1)).alias("nu")))
        day, month = F.dayofmonth("date"), F.month("date")
        return g.select(
            "date", F.when((day == 1) & (month % 3 == 0), F.col("s")).alias("gdp"),
            F.when((day == 1) & (month == 5), F.lit(0.0)).when(day == 1, F.col("s") / F.col("n")).alias("cpi"),
            F.when(day == 1, F.col("n").cast("double")).alias("unemployment_rate"),
            F.when((day == 1) & month.isin(1, 7), F.col("mx")).alias("interest_rate"),
            (F.col("se") / F.nullif("ne", F.lit(0))).alias("exchange_rate_eur"),
            (F.col("su") / F.nullif("nu", F.lit(0))).alias("exchange_rate_usd"))

    @cached_property
    def news_articles(self) -> DataFrame:
        return self.raw("documents").select(
            F.col("doc_id").cast("int").alias("id"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("date"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("headline"), F.col("text").alias("content"),
            F.concat(F.lit("https://example.org/"), "source", F.lit("/"), "doc_id").alias("url"), "source")

    @cached_property
    def companies(self) -> DataFrame:
        i = F.col("s_suppkey")
        return self.raw("supplier").select(
            i.cast("int").alias("id"), F.col("s_name").alias("ticker"), F.col("s_name").alias("name"),
            F.col("s_nationkey").alias("sector_id"), (F.col("s_acctbal") > 0).alias("is_active"),
            F.array(F.concat(F.lit("a"), i % 3), F.concat(F.lit("b"), i % 5)).alias("groups"))

    @cached_property
    def sectors(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("category"))

    @cached_property
    def trading_sessions(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        days = self.raw("orders").agg(F.min(day).alias("a"), F.max(day).alias("b")).select(
            F.explode(F.sequence("a", F.date_add("b", 400))).alias("trade_date"))
        return days.select("trade_date", ((F.weekday("trade_date") < 5)
                                          & (F.dayofmonth("trade_date") != 1)).alias("is_trading_day"))

    @cached_property
    def company_aliases(self) -> DataFrame:
        """Two aliases per company, taken from the words of the benchmark texts."""
        words = self.raw("benchmark").select(
            F.col("item_id").cast("int").alias("company_id"), tokens(F.lower("text")).alias("w"))
        known = self.companies.select(F.col("id").alias("company_id"))
        both = words.select("company_id", F.explode(F.array(
            F.struct(F.concat_ws(" ", F.get("w", F.lit(1)), F.get("w", F.lit(2))).alias("alias"),
                     F.lit(True).alias("is_primary")),
            F.struct(F.get("w", F.lit(4)).alias("alias"), F.lit(False).alias("is_primary")))).alias("a"))
        return both.join(known, "company_id", "left_semi").select(
            "company_id", "a.alias", "a.is_primary", F.lit("benchmark").alias("source"))

    @cached_property
    def context_tags(self) -> DataFrame:
        mean = (self.raw("embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
                .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
                .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("v")))
        return mean.select(F.col("label").alias("id"), F.concat(F.lit("tag"), "label").alias("name"),
                           F.col("v.m").alias("vector"))

    @cached_property
    def article_vectors(self) -> DataFrame:
        docs = self.raw("documents").select(F.col("doc_id").alias("vec_id"))
        return (self.raw("embeddings").join(docs, "vec_id", "left_semi")
                .select(F.col("vec_id").cast("int").alias("id"),
                        F.col("embedding").cast("array<double>").alias("vector")))

    @cached_property
    def news_links(self) -> DataFrame:
        """Stored links: one or two companies for most articles."""
        d = F.col("doc_id")
        base = self.raw("documents").where(F.col("source") != "src4").select(F.explode(F.when(
            F.col("lang") == "en", F.array(d * 7 % 97, d * 11 % 89)).otherwise(F.array(d * 7 % 97))).alias("c"), "doc_id")
        links = base.select(d.cast("int").alias("news_article_id"), F.col("c").cast("int").alias("company_id"),
                            (d % 10).cast("int").alias("context_tag_id"),
                            ((d * 37 + F.col("c")) % 100 / 100.0).alias("confidence_score"),
                            (d * 13 % 100 / 100.0).alias("sentiment_score"),
                            F.element_at(F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative")),
                                         (d % 3 + 1).cast("int")).alias("sentiment_label")).distinct()
        sector = self.companies.select(F.col("id").alias("company_id"), "sector_id")
        return links.join(sector, "company_id").select(
            "news_article_id", "company_id", "sector_id", "context_tag_id", "confidence_score",
            "sentiment_score", "sentiment_label")

    @cached_property
    def selected_features(self) -> DataFrame:
        """One selection result per sector and quarter; ranks follow the size of the measure."""
        names = ["revenue", "operating_profit", "gross_profit", "net_profit"]
        sector = self.companies.select(F.col("id").alias("company_id"), "sector_id")
        t = (self.fundamentals.join(sector, "company_id").groupBy("sector_id", F.col("date").alias("run_date"))
             .agg(*[F.sum(F.col(n).cast("decimal(18,2)")).alias(n) for n in names]))
        picked = [F.when(F.col(n) > 0, F.lit(n)) for n in names]
        rank = [sum(((F.col(m) > F.col(n)).cast("int") for m in names), F.lit(1)) for n in names]
        return t.select(
            F.lit(None).cast("int").alias("company_id"), "sector_id", "run_date",
            F.lit("shadow").alias("model_type"), F.array_compact(F.array(*picked)).alias("selected_features"),
            F.lit(len(names)).alias("total_features"),
            F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*rank)).alias("feature_importances"))

    @cached_property
    def ticks(self) -> DataFrame:
        return self.raw("events").select(F.col("user_id").cast("int").alias("company_id"), "ts",
                                         F.col("value").alias("price"), F.lit(1).alias("qty"), "event_id")

    @cached_property
    def macro_series(self) -> dict[str, DataFrame]:
        """Raw macro series as (date, value, seq), one per measure."""
        return {c: self.macro_data.where(F.col(c).isNotNull()).select("date", F.col(c).alias("value"),
                                                                     F.lit(1).alias("seq"))
                for c in self.macro_data.columns if c != "date"}

    @cached_property
    def unemployment_wide(self) -> DataFrame:
        """Year rows with twelve text cells, as the landed table has them."""
        day = F.col("o_orderdate").cast("date")
        n = self.raw("orders").groupBy(F.year(day).alias("year")).agg(*[
            F.count(F.when(F.month(day) == m, 1)).alias(f"n{m}") for m in range(1, 13)])
        cells = [F.when(F.col(f"n{m}") == 0, "x").otherwise(F.concat(
            F.floor(F.col(f"n{m}") / 10).cast("string"), F.lit(","), (F.col(f"n{m}") % 10).cast("string"))).alias(f"m{m}")
            for m in range(1, 13)]
        return n.select(F.col("year").cast("string").alias("year"), *cells)

    @cached_property
    def fx_documents(self) -> DataFrame:
        """One JSON rate document per month and currency."""
        row = F.concat(F.lit('{"no":"1","effectiveDate":"'), F.col("date").cast("string"), F.lit('","mid":'),
                       F.floor("v").cast("string"), F.lit(".25}"))
        both = self.macro_data.select("date", F.explode(F.array(
            F.struct(F.lit("eur").alias("code"), F.col("exchange_rate_eur").alias("v")),
            F.struct(F.lit("usd").alias("code"), F.col("exchange_rate_usd").alias("v")))).alias("c"))
        both = both.select("date", "c.code", "c.v").where(F.col("v").isNotNull())
        docs = both.groupBy("code", F.trunc("date", "month").alias("m")).agg(
            F.array_join(F.array_sort(F.collect_list(row)), ",").alias("rates"))
        return docs.select(F.concat(F.lit('{"table":"A","code":"'), "code", F.lit('","rates":['), "rates",
                                    F.lit("]}")).alias("payload"))

    @cached_property
    def rates_documents(self) -> DataFrame:
        """One XML document per year with dated groups of rate positions."""
        m = self.macro_data.where(F.col("interest_rate").isNotNull())
        group = F.concat(
            F.lit('<pozycje obowiazuje_od="'), F.when(F.month("date") == 7, "brak").otherwise(F.col("date").cast("string")),
            F.lit('"><pozycja id="ref" oprocentowanie="'), F.floor(F.col("interest_rate") / 1000).cast("string"),
            F.lit(',5"/><pozycja id="lom" oprocentowanie="'), F.when(F.year("date") % 2 == 0, "n/a").otherwise("9,25"),
            F.lit('"/></pozycje>'))
        docs = m.groupBy(F.year("date").alias("y")).agg(F.array_join(F.array_sort(F.collect_list(group)), "").alias("g"))
        return docs.select(F.concat(F.lit("<stopy>"), "g", F.lit("</stopy>")).alias("payload"))

    @cached_property
    def json_stat_documents(self) -> DataFrame:
        """One JSON-stat document per company: quarter index map and value map."""
        label = F.concat(F.year("date").cast("string"), F.lit("-Q"), F.quarter("date").cast("string"))
        pos = ((F.year("date") - 1990) * 4 + F.quarter("date")).cast("string")
        f = self.fundamentals.select(
            "company_id", F.concat(F.lit('"'), label, F.lit('":'), pos).alias("ix"),
            F.concat(F.lit('"'), pos, F.lit('":'), F.when(F.col("ebitda").isNull(), '"c"').otherwise(
                F.floor("ebitda").cast("string"))).alias("val"))
        docs = f.groupBy("company_id").agg(F.array_join(F.array_sort(F.collect_list("ix")), ",").alias("ix"),
                                           F.array_join(F.array_sort(F.collect_list("val")), ",").alias("val"))
        return docs.select("company_id", F.concat(
            F.lit('{"dimension":{"time":{"category":{"index":{'), "ix", F.lit('}}}},"value":{'),
            "val", F.lit("}}")).alias("payload"))

    @cached_property
    def article_pages(self) -> DataFrame:
        """Raw pages with a publication date on most of them."""
        meta = F.concat(F.lit('<meta property="article:published_time" content="2024-01-'),
                        F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit('">'))
        return self.raw("pages").select("page_id", "url", F.when(
            F.contains(F.col("url"), F.lit("/fr/")), F.col("html")).otherwise(F.concat(meta, "html")).alias("html"))

    @cached_property
    def statement_cells(self) -> DataFrame:
        """Landed statement table: measure rows by quarter columns, as text cells.

        Quarter labels, Polish number text and free-form headers as a statement
        page carries them; pages overlap by one quarter per company.
        """
        f = self.fundamentals
        q = F.element_at(F.array(*[F.lit(x) for x in ("I", "II", "III", "IV")]), F.quarter("date"))
        label = F.concat_ws(" ", q, F.lit("Q"), F.year("date"))
        page = F.year("date") - 1990
        heads = F.array(*[F.struct(F.lit(h).alias("header"), F.floor(c).alias("v"), F.lit(i).alias("nth"))
                          for i, (h, c) in enumerate(STATEMENT_HEADERS.items())])
        cells = spread(f).select("company_id", page.alias("page"), label.alias("kwartal"), F.explode(heads).alias("h"))
        text = F.concat(F.col("h.v").cast("string"), F.lit(",5\u00a0"))
        return cells.select("company_id", "page", "kwartal", F.col("h.header").alias("header"),
                            text.alias("cell"), F.col("h.nth").alias("nth"))


# Statement headers of the landed fixture and the measure each holds.
STATEMENT_HEADERS = {
    "Przychody netto ze sprzedaży (tys.)*": "revenue",
    "Wynik na działalności bankowej (tys.)": "operating_profit",
    "Zysk (strata) z działal. oper. (tys.)": "operating_profit",
    "Składka na udziale własnym (tys.)": "gross_profit",
    "Zysk (strata) brutto (tys.)": "gross_profit",
    "Zysk (strata) netto (tys.)": "net_profit",
    "Amortyzacja (tys.)": "ebitda",
    "Aktywa (tys.)": "revenue",
    "Kapitał własny (tys.)*": "gross_profit",
    "Zysk na akcję (zł)": "net_profit",
}

CTE: dict[str, str] = {}
CTE["market_data"] = """
 SELECT company_id, date, max(CASE WHEN rn = 1 THEN px END) AS open, max(px) AS high, min(px) AS low,
  max(CASE WHEN rn = n THEN px END) AS close, CAST(sum(q) AS BIGINT) AS volume
 FROM (SELECT CAST(l_suppkey AS INT) AS company_id, CAST(l_shipdate AS DATE) AS date,
   l_extendedprice / l_quantity AS px, l_quantity AS q,
   row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS rn,
   count(*) OVER (PARTITION BY l_suppkey, l_shipdate) AS n FROM lineitem) GROUP BY company_id, date"""
CTE["fundamentals"] = """
 SELECT company_id, date, CAST(sum(ext * (1 - disc)) AS DOUBLE) AS revenue, CAST(sum(ext * disc) AS DOUBLE) AS operating_profit,
  CAST(sum(CASE WHEN rf = 'R' THEN CAST(0 AS DECIMAL(18,2)) ELSE ext END) AS DOUBLE) AS gross_profit,
  CAST(sum(CASE WHEN ls = 'F' AND rf = 'N' THEN ext ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS net_profit,
  CASE WHEN count(*) % 7 = 0 THEN NULL ELSE CAST(sum(ext) AS DOUBLE) END AS ebitda
 FROM (SELECT CAST(l_suppkey AS INT) AS company_id,
   CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) AS date,
   CAST(l_extendedprice AS DECIMAL(18,2)) AS ext, CAST(l_discount AS DECIMAL(4,2)) AS disc,
   l_returnflag AS rf, l_linestatus AS ls FROM lineitem) GROUP BY company_id, date"""
CTE["macro_data"] = """
 SELECT date, CASE WHEN day(date) = 1 AND month(date) % 3 = 0 THEN s END AS gdp,
  CASE WHEN day(date) = 1 AND month(date) = 5 THEN CAST(0 AS DOUBLE) WHEN day(date) = 1 THEN s / n END AS cpi,
  CASE WHEN day(date) = 1 THEN CAST(n AS DOUBLE) END AS unemployment_rate,
  CASE WHEN day(date) = 1 AND month(date) IN (1, 7) THEN mx END AS interest_rate,
  se / nullif(ne, 0) AS exchange_rate_eur, su / nullif(nu, 0) AS exchange_rate_usd
 FROM (SELECT date, count(*) AS n, CAST(sum(px) AS DOUBLE) AS s, CAST(max(px) AS DOUBLE) AS mx,
   CAST(sum(CASE WHEN pr IN ('1-URGENT','3-MEDIUM') THEN px END) AS DOUBLE) AS se,
   count(CASE WHEN pr IN ('1-URGENT','3-MEDIUM') THEN 1 END) AS ne,
   CAST(sum(CASE WHEN pr IN ('2-HIGH','5-LOW') THEN px END) AS DOUBLE) AS su,
   count(CASE WHEN pr IN ('2-HIGH','5-LOW') THEN 1 END) AS nu
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_totalprice AS DECIMAL(18,2)) AS px, o_orderpriority AS pr FROM orders)
  GROUP BY date)"""
CTE["news_articles"] = """
 SELECT CAST(doc_id AS INT) AS id, DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS date,
  split_part(text, chr(10), 1) AS headline, text AS content,
  concat('https://example.org/', source, '/', doc_id) AS url, source FROM documents"""
CTE["companies"] = """
 SELECT CAST(s_suppkey AS INT) AS id, s_name AS ticker, s_name AS name, s_nationkey AS sector_id,
  s_acctbal > 0 AS is_active, [concat('a', s_suppkey % 3), concat('b', s_suppkey % 5)] AS groups FROM supplier"""
CTE["sectors"] = """
 SELECT n_nationkey AS id, n_name AS name, r_name AS category FROM nation JOIN region ON n_regionkey = r_regionkey"""
CTE["trading_sessions"] = """
 SELECT trade_date, isodow(trade_date) <= 5 AND day(trade_date) <> 1 AS is_trading_day
 FROM (SELECT CAST(unnest(generate_series(a, b + INTERVAL 400 DAY, INTERVAL 1 DAY)) AS DATE) AS trade_date
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders))"""
CTE["company_aliases"] = r"""
 SELECT company_id, alias, is_primary, 'benchmark' AS source FROM (
  SELECT CAST(item_id AS INT) AS company_id, w[2] || ' ' || w[3] AS alias, true AS is_primary FROM
   (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark)
  UNION ALL SELECT CAST(item_id AS INT), w[5], false FROM
   (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark))
 WHERE company_id IN (SELECT s_suppkey FROM supplier)"""
CTE["context_tags"] = """
 SELECT label AS id, concat('tag', label) AS name, list(m ORDER BY i) AS vector FROM (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i) GROUP BY label"""
CTE["article_vectors"] = """
 SELECT CAST(vec_id AS INT) AS id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings
 WHERE vec_id IN (SELECT doc_id FROM documents)"""
CTE["news_links"] = """
 SELECT l.news_article_id, l.company_id, s_nationkey AS sector_id, context_tag_id, confidence_score, sentiment_score, sentiment_label FROM (
  SELECT DISTINCT CAST(doc_id AS INT) AS news_article_id, CAST(c AS INT) AS company_id, CAST(doc_id % 10 AS INT) AS context_tag_id,
   ((doc_id * 37 + c) % 100) / 100.0::DOUBLE AS confidence_score, (doc_id * 13 % 100) / 100.0::DOUBLE AS sentiment_score,
   ['positive', 'neutral', 'negative'][doc_id % 3 + 1] AS sentiment_label
  FROM (SELECT doc_id, doc_id * 7 % 97 AS c FROM documents WHERE source <> 'src4'
   UNION ALL SELECT doc_id, doc_id * 11 % 89 FROM documents WHERE source <> 'src4' AND lang = 'en')) l
 JOIN supplier ON s_suppkey = l.company_id"""
CTE["selected_features"] = """
 SELECT sector_id, run_date, 'shadow' AS model_type,
  list_filter([CASE WHEN revenue > 0 THEN 'revenue' END, CASE WHEN operating_profit > 0 THEN 'operating_profit' END,
   CASE WHEN gross_profit > 0 THEN 'gross_profit' END, CASE WHEN net_profit > 0 THEN 'net_profit' END], lambda x: x IS NOT NULL) AS selected_features,
  4 AS total_features, v AS measures FROM (
  SELECT *, [revenue, operating_profit, gross_profit, net_profit] AS v FROM (
   SELECT s_nationkey AS sector_id, date AS run_date, sum(CAST(revenue AS DECIMAL(18,2))) AS revenue,
    sum(CAST(operating_profit AS DECIMAL(18,2))) AS operating_profit, sum(CAST(gross_profit AS DECIMAL(18,2))) AS gross_profit,
    sum(CAST(net_profit AS DECIMAL(18,2))) AS net_profit
   FROM fundamentals JOIN supplier ON s_suppkey = company_id GROUP BY ALL))"""
CTE["ticks"] = """
 SELECT CAST(user_id AS INT) AS company_id, ts, value AS price, 1 AS qty, event_id FROM events"""
CTE["article_pages"] = """
 SELECT page_id, url, CASE WHEN contains(url, '/fr/') THEN html ELSE concat('<meta property="article:published_time" content="2024-01-',
  lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0'), '">', html) END AS html FROM pages"""
CTE["statement_cells"] = """
 SELECT company_id, CAST(year(date) - 1990 AS INT) AS page,
  ['I', 'II', 'III', 'IV'][quarter(date)] || ' Q ' || year(date) AS kwartal, header,
  CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) || ',5' || chr(160) AS cell, nth
 FROM (""" + " UNION ALL ".join(
    f"SELECT company_id, date, '{h}' AS header, {c} AS v, {i} AS nth FROM fundamentals" for i, (h, c) in enumerate(STATEMENT_HEADERS.items())
) + ") WHERE true"

#: Derived tables a derived table reads.
NEEDS = {"selected_features": ["fundamentals"], "statement_cells": ["fundamentals"]}


def with_tables(body: str, *names: str, extra: str = "") -> str:
    """SQL text with the named derived tables (and their inputs) in front.

    ``extra`` holds further ``name AS (...)`` entries; the prefix is recursive
    so they may be.
    """
    order: list[str] = []
    for n in names:
        for need in [*NEEDS.get(n, []), n]:
            if need not in order:
                order.append(need)
    parts = [f"{n} AS ({CTE[n]})" for n in order] + ([extra] if extra else [])
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


__all__ = ["CTE", "STATEMENT_HEADERS", "Tables", "with_tables"]
