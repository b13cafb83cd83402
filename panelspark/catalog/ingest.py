"""Ingest parsing and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import selections as sl
from ..plans import statements as st
from ..session import scratch_path
from ..sources import landed as ld
from .registry import query, rounded
from .tables import STATEMENT_HEADERS, Tables, with_tables


@query("ohlcv_clean", with_tables("""SELECT company_id, date, open, high, low, close,
    CASE WHEN volume % 10 = 0 THEN 0 ELSE volume END AS volume FROM market_data""", "market_data"))
def ohlcv_clean(t: Tables) -> DataFrame:
    """Landed frame with ticker-qualified headers, text dates and empty volumes."""
    landed = t.market_data.select(
        "company_id", F.concat(F.col("date").cast("string"), F.lit(" 00:00:00")).alias("Date"),
        *[F.col(c.lower()).cast("string").alias(f"{c}|XYZ") for c in ("Open", "High", "Low", "Close")],
        F.when(F.col("volume") % 10 != 0, F.concat(F.col("volume").cast("string"), F.lit(".0"))).alias("Volume|XYZ"))
    return ld.ohlcv_rows(landed)


@query("macro_cpi", with_tables("""SELECT date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, cpi FROM macro_data
    WHERE cpi IS NOT NULL""", "macro_data"))
def macro_cpi(t: Tables) -> DataFrame:
    """Sheet rows whose first cell is a date among rows with notes."""
    m = t.macro_data
    cells = m.where(F.col("cpi").isNotNull()).select(F.col("date").cast("string").alias("c0"), F.col("cpi").cast("string").alias("c1"))
    notes = m.where(F.col("cpi").isNull()).select(F.concat(F.lit("nota "), F.col("date").cast("string")).alias("c0"),
                                                  F.lit("n/a").alias("c1"))
    return ld.cpi_rows(cells.unionByName(notes))


@query("macro_rates_xml", with_tables("""SELECT date, type, value FROM (
    SELECT date, 'ref' AS type, floor(interest_rate / 1000) + 0.5::DOUBLE AS value FROM macro_data WHERE interest_rate IS NOT NULL AND month(date) <> 7
    UNION ALL SELECT date, 'lom', 9.25::DOUBLE FROM macro_data WHERE interest_rate IS NOT NULL AND month(date) <> 7 AND year(date) % 2 <> 0)""", "macro_data"))
def macro_rates_xml(t: Tables) -> DataFrame:
    return ld.rates_xml_rows(t.rates_documents)


@query("macro_unpivot", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, count(*) / 10.0::DOUBLE AS value FROM orders GROUP BY 1""")
def macro_unpivot(t: Tables) -> DataFrame:
    return ld.year_by_month_rows(t.unemployment_wide)


@query("macro_fx_json", with_tables("""SELECT 'EUR' AS currency, date, floor(exchange_rate_eur) + 0.25::DOUBLE AS value FROM macro_data WHERE exchange_rate_eur IS NOT NULL
    UNION ALL SELECT 'USD', date, floor(exchange_rate_usd) + 0.25::DOUBLE FROM macro_data WHERE exchange_rate_usd IS NOT NULL""", "macro_data"))
def macro_fx_json(t: Tables) -> DataFrame:
    return ld.fx_json_rows(t.fx_documents).orderBy("currency", "date")


JSTAT = """SELECT CAST(year(date) AS INT) AS year, CAST(quarter(date) AS INT) AS quarter, 'PL' AS country, CAST(floor(ebitda) AS DOUBLE) AS value
    FROM fundamentals WHERE ebitda IS NOT NULL"""


@query("macro_jsonstat", with_tables(JSTAT, "fundamentals"))
def macro_jsonstat(t: Tables) -> DataFrame:
    return ld.json_stat_rows(t.json_stat_documents)


@query("macro_gdp", with_tables(f"SELECT make_date(year, quarter * 3, 1) AS date, value FROM ({JSTAT})", "fundamentals"))
def macro_gdp(t: Tables) -> DataFrame:
    return ld.gdp_rows(ld.json_stat_rows(t.json_stat_documents))


# The statement headers of the fixture after normalisation.
NORMALISED = dict(zip(STATEMENT_HEADERS, (
    "przychodynettozesprzedazytys", "wyniknadziaalnoscibankowejtys", "zyskstratazdziaalopertys",
    "skadkanaudzialewasnymtys", "zyskstratabruttotys", "zyskstratanettotys", "amortyzacjatys", "aktywatys",
    "kapitawasnytys", "zysknaakcjez"), strict=True))


@query("stmt_transpose", with_tables("SELECT company_id, date, " + ", ".join(
    f"(floor({m}) + 0.5::DOUBLE) AS {NORMALISED[h]}" for h, m in STATEMENT_HEADERS.items()) + " FROM fundamentals", "fundamentals"))
def stmt_transpose(t: Tables) -> DataFrame:
    return ld.statement_wide(ld.statement_rows(t.statement_cells), list(NORMALISED.values()))


OVERLAP = """lapped AS (SELECT company_id, page, kwartal, header, cell, nth FROM statement_cells
  WHERE NOT (kwartal LIKE 'IV Q%' AND nth = 7 AND company_id % 5 = 0)
 UNION ALL SELECT company_id, page + 1, kwartal, header, '7,0', nth FROM statement_cells WHERE kwartal LIKE 'IV Q%'
 UNION ALL SELECT company_id, page + 1, kwartal, 'Liczba akcji (tys. szt.)', '9,0', 99 FROM statement_cells WHERE kwartal LIKE 'IV Q%' AND nth = 0)"""


@query("stmt_overlap", with_tables(f"""SELECT company_id, kwartal, header, replace(replace(cell, chr(160), ''), ',', '.')::DOUBLE AS value FROM lapped
    QUALIFY page = min(page) OVER (PARTITION BY company_id, kwartal)""", "statement_cells", extra=OVERLAP))
def stmt_overlap(t: Tables) -> DataFrame:
    """Every fourth quarter shows again on the next page, with other values and headers that its first page lacks."""
    c = t.statement_cells
    last, again = F.col("kwartal").like("IV Q%"), c.withColumn("page", F.col("page") + 1).withColumn("cell", F.lit("7,0"))
    lapped = (c.where(~(last & (F.col("nth") == 7) & (F.col("company_id") % 5 == 0))).unionByName(again.where(last))
              .unionByName(again.where(last & (F.col("nth") == 0)).withColumns(
                  {"header": F.lit("Liczba akcji (tys. szt.)"), "cell": F.lit("9,0"), "nth": F.lit(99)})))
    rows = ld.statement_rows(lapped)
    names = F.create_map(*[F.lit(x) for h, n in NORMALISED.items() for x in (n, h)])
    quarter = F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV"))), F.quarter("date"))
    return rows.select("company_id", F.concat_ws(" ", quarter, F.lit("Q"), F.year("date")).alias("kwartal"),
                       names[F.col("header")].alias("header"), "value")


@query("quarter_label", with_tables("SELECT company_id, date, kwartal FROM (SELECT DISTINCT company_id, kwartal FROM statement_cells) "
                                    "JOIN (SELECT company_id AS c, date FROM fundamentals) f ON c = company_id AND "
                                    "kwartal = ['I', 'II', 'III', 'IV'][quarter(date)] || ' Q ' || year(date)", "statement_cells"))
def quarter_label(t: Tables) -> DataFrame:
    labels = t.statement_cells.select("company_id", "kwartal").distinct()
    bad = t.companies.select(F.col("id").alias("company_id"), F.explode(F.array(
        *[F.lit(x) for x in ("Q 0000", "IV Q", "2020", "")])).alias("kwartal"))
    out = labels.unionByName(bad).withColumn("date", tx.quarter_date("kwartal"))
    return out.where(F.col("date").isNotNull())


@query("header_norm", with_tables("SELECT company_id, header, CASE header " + " ".join(
    f"WHEN '{h}' THEN '{n}'" for h, n in NORMALISED.items()) + " END AS norm FROM statement_cells GROUP BY company_id, header", "statement_cells"))
def header_norm(t: Tables) -> DataFrame:
    return t.statement_cells.select("company_id", "header").distinct().withColumn("norm", tx.normalise_header("header"))


def _rank_sql(cands: list[str], exact: bool = True, prefix: bool = True) -> str:
    tests = [f"WHEN norm = '{c}' THEN {i}" for i, c in enumerate(cands)] if exact else []
    k = len(tests)
    tests += [f"WHEN starts_with(norm, '{c}') THEN {k + i}" for i, c in enumerate(cands)] if prefix else []
    return f"CASE {' '.join(tests)} END"


HEADS = "heads AS (SELECT company_id, header, CASE header " + " ".join(
    f"WHEN '{h}' THEN '{n}'" for h, n in NORMALISED.items()) + " END AS norm, min(nth) AS nth FROM statement_cells GROUP BY company_id, header)"


@query("candidate_pick", with_tables(" UNION ALL ".join(
    f"SELECT company_id, '{m}' AS measure, arg_min(norm, ({_rank_sql(c)}) * 100 + nth) AS header FROM (SELECT * "
    f"FROM heads) WHERE ({_rank_sql(c)}) IS NOT NULL GROUP BY company_id"
    for m, c in st.BANK_CANDIDATES.items()), "statement_cells", extra=HEADS))
def candidate_pick(t: Tables) -> DataFrame:
    heads = (t.statement_cells.groupBy("company_id", "header").agg(F.min("nth").alias("nth"))
             .withColumn("header", tx.normalise_header("header")))
    picked = heads.groupBy("company_id").agg(*[
        st.pick(c, prefix=True, value="header", place="nth").alias(m) for m, c in st.BANK_CANDIDATES.items()])
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}.v").alias("header")) for m in st.BANK_CANDIDATES])
    return (picked.select("company_id", F.explode(pairs).alias("p")).select("company_id", "p.*")
            .where(F.col("header").isNotNull()))


D = "(floor({}) + 0.5::DOUBLE)"


@query("map_bank", with_tables(f"""SELECT company_id, date, NULL::DOUBLE AS interest_income, NULL::DOUBLE AS fee_income,
    {D.format('operating_profit')} AS banking_result, {D.format('gross_profit')} AS gross_profit, {D.format('net_profit')} AS net_profit,
    {D.format('ebitda')} AS amortization, {D.format('revenue')} AS assets, {D.format('gross_profit')} AS equity,
    NULL::DOUBLE AS shares_thousands, NULL::DOUBLE AS bvps, {D.format('net_profit')} AS eps FROM fundamentals""", "fundamentals"))
def map_bank(t: Tables) -> DataFrame:
    return st.map_bank(ld.statement_rows(t.statement_cells))


@query("map_sector", with_tables(f"""SELECT f.company_id, f.date, CASE WHEN c.sector_id = 7 THEN NULL ELSE {D.format('revenue')} END AS revenue,
    CASE WHEN c.sector_id IN (7, 22) THEN NULL ELSE {D.format('operating_profit')} END AS operating_profit,
    {D.format('gross_profit')} AS gross_profit, {D.format('net_profit')} AS net_profit,
    CASE WHEN c.sector_id IN (7, 22) THEN NULL ELSE {D.format('operating_profit')} + {D.format('ebitda')} END AS ebitda,
    {D.format('revenue')} AS assets, NULL::DOUBLE AS equity, NULL::DOUBLE AS shares, {D.format('net_profit')} AS eps, NULL::DOUBLE AS bvps, NULL::VARCHAR AS audited
    FROM fundamentals f LEFT JOIN companies c ON c.id = f.company_id""", "fundamentals", "companies"))
def map_sector(t: Tables) -> DataFrame:
    return st.map_sector(ld.statement_rows(t.statement_cells), t.companies)


BRANCH_ROWS = {  # normalised header: (measure, companies that report it)
    st.REVENUE[0]: ("revenue", "true"), st.INSURANCE_PREMIUM[0]: ("gross_profit", "company_id % 5 IN (0, 1)"),
    st.INSURANCE_INVESTMENT[0]: ("net_profit", "company_id % 5 IN (0, 2)"), st.BANK_RESULT[0]: ("operating_profit", "company_id % 7 = 0"),
    st.BANK_INTEREST[0]: ("gross_profit", "company_id % 7 IN (1, 2, 0)"), st.BANK_FEES[0]: ("net_profit", "company_id % 7 IN (2, 3)"),
    st.OPERATING[0] + "x": ("operating_profit", "true"), st.TECHNICAL[0] + "x": ("net_profit", "true"),
    st.EBITDA[0]: ("ebitda", "company_id % 2 = 0"), st.EBIT[0]: ("operating_profit", "true"), st.AMORTISATION[0]: ("revenue", "true")}
BRANCH_SECTOR = "CASE WHEN company_id % 3 = 0 THEN 7 WHEN company_id % 3 = 1 THEN 22 ELSE 1 END"


@query("sector_branches", with_tables("""SELECT company_id, date, CASE
    WHEN sector = 22 AND company_id % 5 IN (0, 1, 2) THEN CASE WHEN company_id % 5 IN (0, 1) THEN gross_profit ELSE 0 END + CASE WHEN company_id % 5 IN (0, 2) THEN net_profit ELSE 0 END
    WHEN sector = 7 AND company_id % 7 = 0 THEN operating_profit
    WHEN sector = 7 AND company_id % 7 IN (2, 3) THEN CASE WHEN company_id % 7 = 2 THEN gross_profit ELSE 0 END + net_profit
    WHEN sector = 7 THEN CASE WHEN company_id % 7 = 1 THEN gross_profit END ELSE revenue END AS revenue,
    CASE sector WHEN 22 THEN net_profit WHEN 7 THEN NULL ELSE operating_profit END AS operating_profit,
    CASE WHEN sector <> 1 THEN NULL WHEN company_id % 2 = 0 THEN ebitda ELSE operating_profit + revenue END AS ebitda
    FROM (SELECT *, """ + BRANCH_SECTOR + """ AS sector FROM fundamentals)""", "fundamentals"))
def sector_branches(t: Tables) -> DataFrame:
    """Companies dealt to banks, insurers and others, with the headers that lead into every branch of the rules."""
    heads = F.array(*[F.when(F.expr(cond), F.struct(F.lit(h).alias("header"), F.col(m).alias("value")))
                      for h, (m, cond) in BRANCH_ROWS.items()])
    rows = (t.fundamentals.select("company_id", "date", F.explode(F.array_compact(heads)).alias("h"))
            .select("company_id", "date", "h.header", "h.value"))
    dealt = t.companies.withColumn("company_id", F.col("id")).withColumn("sector_id", F.expr(BRANCH_SECTOR))
    out = st.map_sector(rows, dealt.drop("company_id"))
    return out.select("company_id", "date", "revenue", "operating_profit", "ebitda")


PARAS = """list_filter(list_transform(regexp_extract_all(body, '(?s)<p>(.*?)</p>', 1), lambda p: trim(regexp_replace(p, '<[^>]*>', '', 'g'), ' ')), lambda p: p <> '')"""


def _plain(expr: str) -> str:
    """SQL text that replaces the character references of the pages."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        expr = f"replace({expr}, '{name}', '{char}')"
    return expr


CONTENT = f"""CASE WHEN len(regexp_extract_all(body, '(?s)<p>(.*?)</p>', 1)) > 0 THEN array_to_string({PARAS}, chr(10))
     ELSE trim(regexp_replace(body, '<[^>]*>', '', 'g'), ' ') END"""


@query("article_extract", with_tables(f"""SELECT page_id, url, CAST(d AS DATE) AS date, {_plain('headline')} AS headline,
    {_plain(CONTENT)} AS content FROM (SELECT page_id, url,
     regexp_extract(html, '<meta property="article:published_time" content="([^"]*)"', 1) AS d, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS headline,
     regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM article_pages) WHERE d <> '' AND body <> ''""", "article_pages"))
def article_extract(t: Tables) -> DataFrame:
    return ld.article_rows(t.article_pages)


def _escaped(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ("'", "&#x27;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@query("article_attributes", with_tables("""SELECT id AS page_id, url, date, trim(headline, ' ') || ' & <i>' AS headline,
    CASE WHEN trim(headline, ' ') = '' THEN 'Résumé & more' ELSE trim(headline, ' ') || chr(10) || 'Résumé & more' END AS content
    FROM news_articles WHERE id % 7 <> 0""", "news_articles"))
def article_attributes(t: Tables) -> DataFrame:
    """Pages whose tags carry attributes in any order, with entities and an og:title; some have no body."""
    lead = _escaped(F.trim("headline"))
    page = F.concat(
        F.lit("<html><META content='"), F.col("date").cast("string"), F.lit("T10:00:00' property='article:published_time' />"),
        F.lit('<meta name="x" property="og:title" content="'), lead, F.lit(' &amp; &lt;i&gt;"><title lang=en>other</title>'),
        F.when(F.col("id") % 7 == 0, F.lit("<div>")).otherwise(F.lit('<article data-x="a>b" class="c">')),
        F.lit('<p class="lead" >'), lead, F.lit("</p><p></p>\n<P id=2>R&eacute;sum&#233; <b class='q'>&amp;</b> more</P ></article>"))
    return ld.article_rows(t.news_articles.select(F.col("id").alias("page_id"), "url", page.alias("html")))


@query("link_attributes", """SELECT doc_id AS page_id, unnest(['https://example.org/a?x=' || doc_id || '&y=1', 'http://b.example/' || doc_id,
    'https://example.org/c' || doc_id]) AS link FROM documents""")
def link_attributes(t: Tables) -> DataFrame:
    """Anchors with other attributes before the target, single quotes, no quotes, entities, and some without a target."""
    i = F.col("doc_id").cast("string")
    page = F.concat(F.lit('<a class="n" href="/a?x='), i, F.lit('&amp;y=1" id=3>A</a><A HREF = \'http://b.example/'), i,
                    F.lit("'>B</A><a href=/c"), i, F.lit('>C</a><a name="x">D</a><a href="">E</a><area href="/no">'))
    return ld.link_rows(t.raw("documents").select(F.col("doc_id").alias("page_id"), page.alias("html")), "https://example.org")


@query("link_extract", """SELECT page_id, CASE WHEN starts_with(h, 'http') THEN h ELSE 'https://example.org' || h END AS link
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM pages) WHERE h <> ''""")
def link_extract(t: Tables) -> DataFrame:
    return ld.link_rows(t.raw("pages"), "https://example.org")


@query("coerce_numeric", """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS bad FROM events""")
def coerce_numeric(t: Tables) -> DataFrame:
    return t.raw("events").select("event_id", tx.coerce_number(F.get_json_object("props", "$.k")).alias("k"),
                                  tx.coerce_number("event_type").alias("bad"))


@query("number_text", "SELECT l_orderkey, l_linenumber, l_extendedprice AS value FROM lineitem")
def number_text(t: Tables) -> DataFrame:
    """Prices written with a decimal comma and a no-break space in the thousands."""
    p = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    text = F.concat(F.regexp_replace(F.replace(p, F.lit("."), F.lit(",")), r"(\d{3},)", " $1"), F.lit(" "))
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", tx.parse_number(text).alias("value"))


@query("date_norm", """SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(ts AS DATE) END AS parsed FROM events""")
def date_norm(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "view", "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.raw("events").select("event_id", tx.parse_date("ts").alias("day"), tx.parse_date(text).alias("parsed"))


@query("news_text", with_tables("SELECT id, lower(headline || ' ' || content) AS text, lower(headline || ' ' || substring(content, 1, 100)) AS opening FROM news_articles",
                                "news_articles"))
def news_text(t: Tables) -> DataFrame:
    return t.news_articles.select("id", tx.news_text("headline", "content").alias("text"),
                                  tx.news_text("headline", "content", 100).alias("opening"))


@query("feature_names_json", with_tables("""SELECT sector_id, run_date, selected_features AS from_list, selected_features AS from_records,
    list_transform(list_sort(list_zip(list_transform(measures, lambda v: -v), ['revenue', 'operating_profit', 'gross_profit', 'net_profit'])),
     lambda e: e[2]) AS from_map FROM selected_features""", "selected_features"))
def feature_names_json(t: Tables) -> DataFrame:
    s = t.selected_features
    records = F.transform("selected_features", lambda n: F.struct(n.alias("feature")))
    weights = F.map_from_entries(F.transform(F.map_entries("feature_importances"), lambda e: F.struct(e["key"], -e["value"])))
    return s.select("sector_id", "run_date", tx.feature_names(F.to_json("selected_features")).alias("from_list"),
                    tx.feature_names(F.to_json(records)).alias("from_records"), tx.feature_names(F.to_json(weights)).alias("from_map"))


NEWEST = "newest AS (SELECT * FROM selected_features QUALIFY row_number() OVER (PARTITION BY sector_id ORDER BY run_date DESC) = 1)"
MEASURES = ["revenue", "operating_profit", "gross_profit", "net_profit"]


def stored_choices(t: Tables) -> DataFrame:
    """The selections of two runs, stored one after the other and read back."""
    path = scratch_path(t.spark, "selections")
    for part in (F.year("run_date") < 1996, F.year("run_date") >= 1996):
        sl.store_selection(t.selected_features.where(part), path)
    return sl.stored_selections(t.spark, path)


@query("select_features", with_tables("""SELECT f.company_id, f.date, n.sector_id, x.feature, x.value FROM fundamentals f
    JOIN companies c ON c.id = f.company_id JOIN newest n ON n.sector_id = c.sector_id,
    (SELECT unnest(['revenue', 'operating_profit', 'gross_profit', 'net_profit']) AS feature,
      unnest([f.revenue, f.operating_profit, f.gross_profit, f.net_profit]) AS value) x
    WHERE list_contains(n.selected_features, x.feature)""", "fundamentals", "companies", "selected_features", extra=NEWEST))
def select_features(t: Tables) -> DataFrame:
    """Measures that the newest stored selection of the company's sector names."""
    newest = sl.latest_selections(stored_choices(t), "shadow")
    sector = t.companies.select(F.col("id").alias("company_id"), "sector_id")
    return sl.selected_values(t.fundamentals.join(sector, "company_id"), newest, MEASURES)


@query("selection_ranks", with_tables("""SELECT sector_id, run_date, x.feature, CAST(1 + len(list_filter(n.measures, lambda m: m > x.v)) AS INT) AS rank,
    list_contains(selected_features, x.feature) AS selected FROM newest n,
    (SELECT unnest(['revenue', 'operating_profit', 'gross_profit', 'net_profit']) AS feature, unnest(n.measures) AS v) x""",
                                      "selected_features", extra=NEWEST))
def selection_ranks(t: Tables) -> DataFrame:
    """Ranks of the newest stored selection of each sector."""
    return sl.ranks(sl.latest_selections(stored_choices(t), "shadow")).select("sector_id", "run_date", "feature", "rank", "selected")


@query("to_record", with_tables("SELECT id, strftime(date, '%Y-%m-%d') AS date, headline, url, source FROM news_articles", "news_articles"))
def to_record(t: Tables) -> DataFrame:
    return t.news_articles.select("id", F.date_format("date", "yyyy-MM-dd").alias("date"), "headline", "url", "source")


@query("record_json", with_tables("""SELECT id, '{"id":' || id || ',"date":"' || strftime(date, '%Y-%m-%d') || '","source":"' || source || '"}' AS record
    FROM news_articles""", "news_articles"))
def record_json(t: Tables) -> DataFrame:
    return t.news_articles.select("id", F.to_json(F.struct("id", "date", "source")).alias("record"))


@query("revenue_by_quarter", with_tables("SELECT date, sum(floor(revenue) + 0.5::DOUBLE) AS revenue FROM fundamentals GROUP BY date", "fundamentals"))
def revenue_by_quarter(t: Tables) -> DataFrame:
    """Column totals of the statement rows parsed back from text."""
    rows = ld.statement_rows(t.statement_cells).where(F.col("header") == NORMALISED["Przychody netto ze sprzedaży (tys.)*"])
    return rounded(rows.groupBy("date").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("revenue")), 2)
