"""Parsers of landed payloads: text columns in, typed rows out."""

from __future__ import annotations

from collections.abc import Sequence
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (join_paragraphs, normalise_header, parse_date, parse_number,
                              quarter_date, quarter_month, strip_tags)


def ohlcv_rows(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """Lower-case the landed header, keep the six columns, default the volume to 0.

    Header cells may carry the ticker, as in "Close|XYZ"; the part before the
    bar counts.
    """
    names = {c.split("|")[0].strip().lower(): c for c in df.columns}

    def num(n: str) -> Column:
        return F.col(f"`{names[n]}`").try_cast("double")
    extra = [F.col(c) for c in df.columns if c in ("company_id", "ticker")]
    return df.select(*extra, parse_date(F.col(f"`{names['date']}`")).alias("date"),
                     *[num(n).alias(n) for n in ("open", "high", "low", "close")],
                     F.coalesce(num("volume").try_cast("long"), F.lit(0)).alias("volume"))


def cpi_rows(df: DataFrame, date: str = "c0", value: str = "c1") -> DataFrame:
    """Rows whose first cell is a date."""
    d = parse_date(date)
    return df.where(d.isNotNull()).select(
        d.alias("date"), F.year(d).alias("year"), F.month(d).alias("month"),
        F.col(value).try_cast("double").alias("cpi"))


def rates_xml_rows(df: DataFrame, xml: str = "payload") -> DataFrame:
    """Dated groups of rate positions; bad dates and numbers are skipped.

    The payload holds ``pozycje`` elements (attribute obowiazuje_od) with
    ``pozycja`` children (attributes id and oprocentowanie).
    """
    schema = ("pozycje array<struct<_obowiazuje_od:string,"
              "pozycja:array<struct<_id:string,_oprocentowanie:string>>>>")
    rows = (df.select(F.explode(F.from_xml(xml, schema)["pozycje"]).alias("g"))
            .select(F.col("g._obowiazuje_od").alias("d"), F.explode("g.pozycja").alias("p")))
    rows = rows.select(F.when(F.col("d").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("d")).try_cast("date").alias("date"),
                       F.col("p._id").alias("type"),
                       F.replace("p._oprocentowanie", F.lit(","), F.lit(".")).try_cast("double").alias("value"))
    return rows.where(F.col("date").isNotNull() & F.col("value").isNotNull() & (F.col("type") != ""))


def year_by_month_rows(df: DataFrame, year: str = "year",
                       months: Sequence[str] = tuple(f"m{i}" for i in range(1, 13))) -> DataFrame:
    """Wide year rows with twelve text cells to (first of month, value); bad cells are skipped."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("m"), F.col(c).alias("v"))
                      for i, c in enumerate(months)])
    y = F.trim(F.col(year).cast("string")).try_cast("int")
    rows = df.select(y.alias("y"), F.explode(cells).alias("c")).where(F.col("y").isNotNull())
    return rows.select(F.make_date("y", "c.m", F.lit(1)).alias("date"),
                       parse_number(F.trim("c.v")).alias("value")).where(F.col("value").isNotNull())


def fx_json_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rate documents to (currency, date, value)."""
    doc = F.from_json(payload, "code string, rates array<struct<effectiveDate:string,mid:double>>")
    return (df.select(doc.alias("d")).select(F.upper("d.code").alias("currency"), F.explode("d.rates").alias("r"))
            .select("currency", F.to_date("r.effectiveDate").alias("date"), F.col("r.mid").alias("value")))


def json_stat_rows(df: DataFrame, payload: str = "payload", country: str = "PL") -> DataFrame:
    """Quarter values of a JSON-stat document.

    The time index maps a label to a position, the value map a position to a
    number; the join of both happens inside the row, on the map entries.
    """
    doc = F.from_json(payload, "dimension struct<time:struct<category:struct<index:map<string,int>>>>, "
                               "value map<string,string>")
    rows = (df.select(doc.alias("d"))
            .select(F.explode("d.dimension.time.category.index").alias("label", "pos"), F.col("d.value").alias("vals"))
            .select("label", F.try_element_at("vals", F.col("pos").cast("string")).try_cast("double").alias("value")))
    return (rows.select(F.substring("label", 1, 4).try_cast("int").alias("year"),
                        F.substring("label", 7, 9).try_cast("int").alias("quarter"),
                        F.lit(country).alias("country"), "value")
            .where(F.col("year").isNotNull() & F.col("quarter").isNotNull() & F.col("value").isNotNull()))


def gdp_rows(df: DataFrame) -> DataFrame:
    """Quarter values dated on the first day of the quarter's last month."""
    return df.select(quarter_month(F.col("year"), F.col("quarter")).alias("date"), "value")


def statement_rows(cells: DataFrame, keys: Sequence[str] = ("company_id",)) -> DataFrame:
    """Statement cells (page, kwartal, header, cell) to one row per key, quarter and header.

    A quarter seen on several pages is taken whole from the first of them, with the headers of that page alone. Headers
    are normalised; labels that name no quarter are dropped. The cell text is kept beside its number, and ``nth``, the
    place of the header on its page, if the cells have it. A quarter holds the headers of a few pages, so the window is
    small, and grouping by header needs no second shuffle.
    """
    nth = ["nth"] if "nth" in cells.columns else []
    rows = cells.select(*keys, "page", quarter_date("kwartal").alias("date"), "header", "cell", *nth)
    rows = rows.where(F.col("date").isNotNull())
    first = F.min("page").over(Window.partitionBy(*keys, "date"))
    rows = rows.withColumn("_first", first).where(F.col("page") == F.col("_first")).select(
        *keys, "date", normalise_header("header").alias("header"), parse_number("cell").alias("value"),
        F.trim("cell").alias("text"), *nth)
    if not nth:
        return (rows.groupBy(*keys, "date", "header").agg(F.min(F.struct("value", "text")).alias("v"))
                .select(*keys, "date", "header", "v.value", "v.text"))
    # of headers that become equal the last one counts, in the place of the first
    return (rows.groupBy(*keys, "date", "header").agg(F.max(F.struct("nth", "value", "text")).alias("v"), F.min("nth").alias("nth"))
            .select(*keys, "date", "header", "v.value", "v.text", "nth"))


def statement_wide(rows: DataFrame, headers: Sequence[str], keys: Sequence[str] = ("company_id",)) -> DataFrame:
    """Pivot normalised statement rows to one column per header."""
    return rows.groupBy(*keys, "date").pivot("header", list(headers)).agg(F.first("value"))


# Page patterns of the article extraction. Tags may carry attributes, in any order and quoting.
ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
META = rf"(?is)<meta\b{ATTRIBUTES}>"
TITLE = rf"(?is)<title\b{ATTRIBUTES}>(.*?)</title\s*>"
BODY = rf"(?is)<article\b{ATTRIBUTES}>(.*?)</article\s*>"
PARAGRAPH = rf"(?is)<p\b{ATTRIBUTES}>(.*?)</p\s*>"
ANCHOR = rf"(?is)<a\b{ATTRIBUTES}>"


def section_of_class(name: str) -> str:
    """Body pattern of a section with the class ``name`` among its classes."""
    return rf"""(?is)<section\b(?=[^>]*\bclass\s*=\s*["']?[^"'>]*(?<![\w-]){name}(?![\w-])){ATTRIBUTES}>(.*?)</section\s*>"""


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quoted or bare; NULL when the tag does not have it."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    found = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(F.regexp_like(tag, F.lit(pattern)), found)


def meta(html: str, name: str) -> Column:
    """Content of the first meta tag whose property is ``name``; NULL without one."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(META), F.lit(0)), lambda t: attribute(t, "property") == name)
    return attribute(F.get(tags, F.lit(0)), "content")


def _unescaped(text: Column | str) -> Column:
    """Text with its character references replaced."""
    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(unescape, na_action="ignore")
    return decode(text)


def article_rows(pages: DataFrame, html: str = "html", title: str = TITLE, body: str = BODY,
                 paragraph: str = PARAGRAPH) -> DataFrame:
    """Date, title and text of article pages; pages without a date or a body are dropped.

    The title is the page's ``og:title``, else its title element. Entities are decoded after the tags are gone.
    """
    paras = F.transform(F.regexp_extract_all("_body", F.lit(paragraph), F.lit(1)), strip_tags)
    rows = pages.select("page_id", "url", meta(html, "article:published_time").alias("_d"),
                        F.coalesce(meta(html, "og:title"), F.regexp_extract(html, title, 1)).alias("_title"),
                        F.regexp_extract(html, body, 1).alias("_body"))
    rows = rows.where((F.col("_d") != "") & (F.col("_body") != ""))
    rows = rows.select("page_id", "url", F.col("_d").try_cast("timestamp").cast("date").alias("date"), "_title",
                       join_paragraphs(paras, strip_tags(F.col("_body"))).alias("_text"))
    return rows.where(F.col("date").isNotNull()).select(
        "page_id", "url", "date", _unescaped("_title").alias("headline"), _unescaped("_text").alias("content"))


def link_rows(pages: DataFrame, base_url: str, html: str = "html", anchor: str = ANCHOR) -> DataFrame:
    """Absolute links of a listing page; anchors without a target are skipped."""
    tags = pages.select("page_id", F.explode(F.regexp_extract_all(html, F.lit(anchor), F.lit(0))).alias("t"))
    links = tags.select("page_id", attribute(F.col("t"), "href").alias("h")).where(F.col("h") != "")
    links = links.select("page_id", _unescaped("h").alias("h"))
    return links.select("page_id", F.when(
        F.col("h").startswith("http"), F.col("h")).otherwise(F.concat(F.lit(base_url), "h")).alias("link"))
