"""Key merges: each takes (base, updates) and returns the new table version."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .dedup import one_per_key
from .joins import anti_existing


def insert_ignore(base: DataFrame, updates: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """Insert rows with new keys; the first of equal new keys wins."""
    updates = one_per_key(updates, keys, order or [], keep="first")
    fresh = anti_existing(updates, base, keys)
    return base.unionByName(fresh.select(*base.columns))


def upsert_replace(base: DataFrame, updates: DataFrame, keys: Sequence[str],
                   order: Sequence[str] | None = None) -> DataFrame:
    """Replace rows by key; the last of equal new keys wins."""
    updates = reliable_checkpoint(one_per_key(updates, keys, order or [], keep="last"), "batch")
    kept = base.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates.select(*base.columns))


def merge_columns(base: DataFrame, sources: dict[str, DataFrame], key: str = "date",
                  value: str = "value", order: str = "seq") -> DataFrame:
    """Set one column per source series, adding rows for new keys.

    The sources are stacked with their column name and reduced together, so any
    number of series costs one full join. The last value of a key wins; a key
    without a new value keeps the old one.
    """
    stacked = reduce(DataFrame.unionByName, [
        df.select(F.col(key), F.lit(col).alias("_col"), F.col(value).alias("_v"),
                  F.col(order).alias("_o"))
        for col, df in sources.items()])
    wide = stacked.groupBy(key).agg(*[
        F.max_by(F.when(F.col("_col") == c, F.struct("_v")),
                 F.when(F.col("_col") == c, F.struct("_o", "_v"))).alias(f"_new_{c}")
        for c in sources])
    joined = base.join(wide, key, "full")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}._v"), F.col(c)).alias(c) if c in sources else F.col(c)
        for c in base.columns])


def fill_if_empty(base: DataFrame, updates: DataFrame, key: str = "url",
                  test: str = "content", fill: Sequence[str] = ("content", "headline", "date"),
                  order: Sequence[str] | None = None) -> DataFrame:
    """Add unknown keys; fill rows whose test column is empty; leave the rest alone.

    The test column is taken as it comes; the other filled columns keep the old
    value where the new one is empty.
    """
    updates = one_per_key(updates, [key], order or [], keep="last")
    new = updates.select(F.col(key), F.struct(*[c for c in base.columns if c != key]).alias("_new"))
    old = base.select(F.col(key), F.struct(*[c for c in base.columns if c != key]).alias("_old"))
    joined = old.join(new, key, "full")
    types = {f.name: f.dataType for f in base.schema}

    def empty(c: Column, t: T.DataType) -> Column:
        return c.isNull() | (c == "") if isinstance(t, T.StringType) else c.isNull()

    known = F.col("_old").isNotNull()
    to_fill = known & F.col("_new").isNotNull() & empty(F.col(f"_old.{test}"), types[test])

    def merged(c: str) -> Column:
        o, n = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        if c == test:
            filled = n
        elif c in fill:
            filled = F.when(empty(n, types[c]), o).otherwise(n)
        else:
            filled = o
        return F.when(to_fill, filled).when(known, o).otherwise(n).alias(c)

    return joined.select(*[F.col(c) if c == key else merged(c) for c in base.columns])


def after_high_water(new: DataFrame, stored: DataFrame, key: str = "company_id",
                     on: str = "date") -> DataFrame:
    """Rows later than the newest stored date of their key (all rows of new keys)."""
    marks = stored.groupBy(key).agg(F.max(on).alias("_hw"))
    return (new.join(marks, key, "left")
            .where(F.col("_hw").isNull() | (F.col(on) > F.col("_hw"))).drop("_hw"))


def latest_mark(df: DataFrame, on: str = "date", default: Column | None = None) -> DataFrame:
    """The newest date of a table, or a default when the table is empty."""
    if default is None:
        default = F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return df.agg(F.coalesce(F.max(on), default).alias("mark"))


def sanitize(df: DataFrame, dates: Sequence[str] = ()) -> DataFrame:
    """NaN and infinities become NULL in floating columns; named columns become dates."""
    def clean(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            bad = F.isnan(c) | (F.abs(c) == float("inf"))
            return F.when(~bad, c).alias(f.name)
        return F.to_date(c).alias(f.name) if f.name in dates else c
    return df.select(*[clean(f) for f in df.schema])


def keep_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """The allowed columns that exist, in the order given."""
    return df.select(*[c for c in allowed if c in df.columns])
