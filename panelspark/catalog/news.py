"""News labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import news_text as assemble
from ..operators import news as nw
from ..plans import labelling
from .registry import query, rnd, rounded
from .tables import Tables, with_tables

TEXTS = "txt AS (SELECT id, lower(headline || ' ' || content) AS text FROM news_articles)"
SUBSTRING = """sub AS (SELECT DISTINCT t.id AS news_article_id, a.company_id FROM txt t JOIN company_aliases a ON contains(t.text, lower(a.alias)))"""
PHRASE = r"""phr AS (SELECT DISTINCT t.id AS news_article_id, a.company_id FROM (
  SELECT id, ' ' || array_to_string(regexp_extract_all(text, '[\p{L}\p{N}]+'), ' ') || ' ' AS s FROM txt) t
  JOIN (SELECT company_id, ' ' || array_to_string(regexp_extract_all(lower(alias), '[\p{L}\p{N}]+'), ' ') || ' ' AS p FROM company_aliases) a
  ON contains(t.s, a.p))"""
TOPIC = """top AS (SELECT id AS news_article_id, tag AS context_tag_id, s AS confidence_score FROM (
  SELECT v.id, g.id AS tag, list_dot_product(v.vector, g.vector) / (sqrt(list_dot_product(v.vector, v.vector)) * sqrt(list_dot_product(g.vector, g.vector))) AS s
  FROM article_vectors v, context_tags g) QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, tag) = 1)"""


def _count(words: list[str]) -> str:
    names = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), lambda w: w IN ({names})))"


MOOD = f"""mood AS (SELECT id AS news_article_id, CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS sentiment_label,
  CASE WHEN p = n THEN 0.5::DOUBLE ELSE greatest(p, n) / (p + n) END AS sentiment_score FROM (
  SELECT id, {_count(nw.POSITIVE_WORDS)} AS p, {_count(nw.NEGATIVE_WORDS)} AS n FROM txt))"""


def _texts(t: Tables) -> DataFrame:
    return t.news_articles.select("id", assemble("headline", "content").alias("text"))


@query("alias_substring", with_tables("SELECT * FROM sub", "news_articles", "company_aliases", extra=TEXTS + ",\n" + SUBSTRING))
def alias_substring(t: Tables) -> DataFrame:
    return nw.alias_substrings(_texts(t), t.company_aliases)


@query("alias_phrase", with_tables("SELECT * FROM phr", "news_articles", "company_aliases", extra=TEXTS + ",\n" + PHRASE))
def alias_phrase(t: Tables) -> DataFrame:
    return nw.alias_phrases(_texts(t), t.company_aliases)


@query("topic_argmax", with_tables(f"SELECT news_article_id, context_tag_id, {rnd('confidence_score')} AS confidence_score FROM top",
                                   "article_vectors", "context_tags", extra=TOPIC))
def topic_argmax(t: Tables) -> DataFrame:
    return rounded(nw.best_topic(t.article_vectors, t.context_tags))


@query("sentiment_score", with_tables(f"SELECT news_article_id, sentiment_label, {rnd('sentiment_score')} AS sentiment_score FROM mood",
                                      "news_articles", extra=TEXTS + ",\n" + MOOD))
def sentiment_score(t: Tables) -> DataFrame:
    label, score = nw.lexicon_sentiment("text")
    return rounded(_texts(t).selectExpr("id AS news_article_id", "text").withColumns(
        {"sentiment_label": label, "sentiment_score": score}).drop("text"))


@query("sentiment_table", with_tables(f"SELECT news_article_id, sentiment_label, {rnd('sentiment_score')} AS sentiment_score FROM mood",
                                      "news_articles", extra=TEXTS + ",\n" + MOOD))
def sentiment_table(t: Tables) -> DataFrame:
    """The same scores from a lexicon that comes as a table."""
    words = [(w, 1.0) for w in nw.POSITIVE_WORDS] + [(w.upper(), -2.0) for w in nw.NEGATIVE_WORDS] + [("plain", 0.0)]
    lexicon = t.spark.createDataFrame(words, "word string, polarity double")
    return rounded(nw.sentiment_from_table(_texts(t), lexicon).withColumnRenamed("id", "news_article_id"))


def _links(match: str, extra_cols: str, extra_join: str) -> str:
    return f"""SELECT m.news_article_id, m.company_id, c.sector_id, t.context_tag_id, {rnd('t.confidence_score')} AS confidence_score{extra_cols}
    FROM {match} m LEFT JOIN companies c ON c.id = m.company_id LEFT JOIN top t ON t.news_article_id = m.news_article_id {extra_join}
    WHERE m.news_article_id NOT IN (SELECT news_article_id FROM news_links)"""


NAMES = ("news_articles", "company_aliases", "article_vectors", "context_tags", "companies", "news_links")


@query("news_label_phrase", with_tables(
    _links("phr", f", s.sentiment_label, {rnd('s.sentiment_score')} AS sentiment_score", "LEFT JOIN mood s ON s.news_article_id = m.news_article_id"),
    *NAMES, extra=",\n".join([TEXTS, PHRASE, TOPIC, MOOD])))
def news_label_phrase(t: Tables) -> DataFrame:
    return rounded(labelling.label_by_phrase(t.news_articles, t.company_aliases, t.article_vectors, t.context_tags,
                                             t.companies, t.news_links))


@query("news_label_substring", with_tables(_links("sub", "", ""), *NAMES, extra=",\n".join([TEXTS, SUBSTRING, TOPIC])))
def news_label_substring(t: Tables) -> DataFrame:
    return rounded(labelling.label_by_substring(t.news_articles, t.company_aliases, t.article_vectors, t.context_tags,
                                                t.companies, t.news_links))
