"""Read predicates: filters that Catalyst pushes to the scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def read_where(df: DataFrame, *, date: Date | None = None, date_from: Date | None = None,
               date_to: Date | None = None, on: str = "date", **equals) -> DataFrame:
    """Rows that match every given predicate (equality, date, closed date range)."""
    for name, value in equals.items():
        df = df.where(F.col(name) == F.lit(value))
    if date is not None:
        df = df.where(F.col(on) == F.lit(date))
    if date_from is not None:
        df = df.where(F.col(on) >= F.lit(date_from))
    if date_to is not None:
        df = df.where(F.col(on) <= F.lit(date_to))
    return df


def first_where(df: DataFrame, **equals) -> DataFrame:
    """The row of a unique key."""
    return read_where(df, **equals).limit(1)


def in_group(companies: DataFrame, group: str) -> DataFrame:
    """Active companies whose group array holds the name."""
    return companies.where(F.array_contains("groups", group) & F.col("is_active"))


def in_list(df: DataFrame, column: str, values: Iterable | DataFrame) -> DataFrame:
    """Rows whose column is in a list, or in the first column of a table.

    A list becomes one set in the filter, whatever its length; values that do not fit on the driver come as a table.
    """
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(column))
        return df.join(keys, column, "left_semi")
    return df.where(F.col(column).isin(list(values)))


def at_least(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.where(F.col(column) >= threshold)


def drop_all_null_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Remove the columns that hold no value.

    One pass counts all columns; a single row of counts reaches the driver.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    kept = set(keep)
    return df.select(*[c for c in df.columns if counts[c] > 0 or c in kept])


def varying_columns(df: DataFrame, cols: Sequence[str]) -> set[str]:
    """The columns with more than one distinct value, where NULL counts as a value.

    Each column is compared with its value in one row: one flag per column is
    aggregated, and no distinct set is ever built.
    """
    one = df.select(*cols).first() if cols else None
    if one is None:
        return set()
    varies = df.agg(*[F.max(~F.col(c).eqNullSafe(F.lit(one[c]))).alias(c) for c in cols]).first()
    return {c for c in cols if varies[c]}


def drop_constant_columns(df: DataFrame, exclude: Iterable[str] = (), some: DataFrame | None = None) -> DataFrame:
    """Remove the columns with one distinct value, where NULL counts as a value.

    ``some`` are rows of ``df`` that cost less to compute: what varies among them varies, and only the other columns are
    looked for in all rows.
    """
    ex = set(exclude)
    cols = [c for c in df.columns if c not in ex]
    varies = set() if some is None else varying_columns(some, cols)
    varies |= varying_columns(df, [c for c in cols if c not in varies])
    return df.select(*[c for c in df.columns if c in ex or c in varies])


def news_of(articles: DataFrame, links: DataFrame, *, min_confidence: float | None = None,
            **equals) -> DataFrame:
    """Articles that have a link matching the predicates, each once."""
    links = read_where(links, **equals)
    if min_confidence is not None:
        links = at_least(links, "confidence_score", min_confidence)
    ids = links.select(F.col("news_article_id").alias("id"))
    return articles.join(ids, "id", "left_semi")


def unlabelled(articles: DataFrame, links: DataFrame) -> DataFrame:
    """Articles without any link."""
    return articles.join(links.select(F.col("news_article_id").alias("id")), "id", "left_anti")
