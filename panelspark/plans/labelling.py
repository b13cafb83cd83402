"""News labelling: companies, best topic and sentiment of each unlabelled article."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import news_text
from ..operators.news import (alias_phrases, alias_substrings, best_topic, lexicon_sentiment, link_rows)
from ..operators.reads import unlabelled


def label_by_phrase(articles: DataFrame, aliases: DataFrame, vectors: DataFrame, tags: DataFrame,
                    companies: DataFrame, stored: DataFrame | None = None,
                    content_chars: int | None = None) -> DataFrame:
    """Link rows from whole-token alias matches, with topic and sentiment.

    The whole text is matched and scored; ``content_chars`` cuts the content
    for callers that want the opening of an article only.
    """
    news = articles if stored is None else unlabelled(articles, stored)
    texts = news.select("id", news_text("headline", "content", content_chars).alias("text"))
    label, score = lexicon_sentiment("text")
    mood = texts.select(F.col("id").alias("news_article_id"), score.alias("sentiment_score"),
                        label.alias("sentiment_label"))
    topics = best_topic(vectors, tags)
    labels = mood.join(topics, "news_article_id", "left")
    return link_rows(alias_phrases(texts, aliases), labels, companies, stored)


def label_by_substring(articles: DataFrame, aliases: DataFrame, vectors: DataFrame, tags: DataFrame,
                       companies: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Link rows from alias text found anywhere in the article, with topic."""
    news = articles if stored is None else unlabelled(articles, stored)
    texts = news.select("id", news_text("headline", "content").alias("text"))
    return link_rows(alias_substrings(texts, aliases), best_topic(vectors, tags), companies, stored)
