"""As-of joins, calendar grids and key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import by_key, reliable_checkpoint
from .dedup import one_per_key


def asof_by_key(left: DataFrame, right: DataFrame, key: str = "company_id",
                on: str = "date", parts: int | None = None) -> DataFrame:
    """Newest right row of the key with ``date`` at or before the left date.

    Both sides are tagged and unioned, so one shuffle on the key serves the
    join, and a window carries the last right row forward. The right row is
    carried as one struct: NULLs inside a matched row stay NULL. ``parts`` names the number of partitions of that
    shuffle, which later windows over the key keep.
    """
    payload = [c for c in right.columns if c not in (key, on)]
    right = one_per_key(right, [key, on], [on])
    lcols = [c for c in left.columns if c not in (key, on)]
    lt = left.select(key, on, F.lit(1).alias("_side"),
                     F.struct(*lcols, F.lit(True).alias("_l")).alias("_left"))
    rt = right.select(key, on, F.lit(0).alias("_side"), F.struct(*payload).alias("_right"))
    w = (Window.partitionBy(key).orderBy(on, "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = by_key(lt.unionByName(rt, allowMissingColumns=True), parts, key)
    return (both.withColumn("_hit", F.last("_right", ignorenulls=True).over(w))
            .where(F.col("_side") == 1)
            .select(key, on, *[F.col(f"_left.{c}").alias(c) for c in lcols],
                    *[F.col(f"_hit.{c}").alias(c) for c in payload]))


def daily_ranges(right: DataFrame, on: str = "date") -> DataFrame:
    """Spread each row of a dated series over the days until the next row.

    The result has one row per calendar day and the payload as a struct.
    """
    payload = [c for c in right.columns if c != on]
    right = one_per_key(right, [on], [on])
    nxt = F.lead(on).over(Window.orderBy(on))
    return (right.select(F.col(on).alias("_from"), F.struct(*payload).alias("_right"),
                         nxt.alias("_to"))
            .select("_right", F.explode(F.sequence(
                "_from", F.coalesce(F.date_sub("_to", 1), F.col("_from")))).alias(on)))


def asof_series(left: DataFrame, right: DataFrame, on: str = "date") -> DataFrame:
    """Newest row of a key-less dated series (macro) at or before the left date.

    The series is spread to days, which turns the range condition into an equi
    join on the day; left rows after the last series row take that one row. The
    series side holds at most one row per calendar day, so it is broadcast.
    """
    payload = [c for c in right.columns if c != on]
    last = right.agg(F.max_by(F.struct(on, *payload), F.struct(on, *payload)).alias("v"))
    days = F.broadcast(daily_ranges(right, on))
    tail = last.select("v").scalar()
    out = left.join(days, on, "left").withColumn("_tail", tail)
    hit = F.when(F.col(on) >= F.col(f"_tail.{on}"),
                 F.struct(*[F.col(f"_tail.{c}").alias(c) for c in payload])).otherwise(F.col("_right"))
    return (out.withColumn("_hit", hit)
            .select(*left.columns, *[F.col(f"_hit.{c}").alias(c) for c in payload]))


def is_business_day(date: str | Column) -> Column:
    return F.weekday(date) < 5


def business_day_grid(keys: DataFrame, start: str | Column, end: str | Column,
                      name: str = "date") -> DataFrame:
    """One row per key row and business day in its closed date range."""
    s, e = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    days = F.sequence(s, e)
    return (keys.where(s <= e).withColumn(name, F.explode(days))
            .where(is_business_day(name)))


def daily_densify(df: DataFrame, key: str | None, on: str = "date") -> DataFrame:
    """Insert the missing calendar days between the first and last row of each key."""
    keys = [key] if key else []
    rest = [c for c in df.columns if c not in (*keys, on)]
    row = F.struct(*rest)
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(on)
    nxt = F.coalesce(F.date_sub(F.lead(on).over(w), 1), F.col(on))
    # Each row opens the gap that follows it: no join and no second shuffle.
    spread = df.select(*keys, F.col(on).alias("_from"), row.alias("_row"), nxt.alias("_to"))
    spread = spread.select(*keys, "_from", "_row",
                           F.explode(F.sequence("_from", "_to")).alias(on))
    first = F.col(on) == F.col("_from")
    return spread.select(*keys, on, *[
        F.when(first, F.col(f"_row.{c}")).alias(c) for c in rest]).select(*df.columns)


def date_chunks(df: DataFrame, start: str | Column, end: str | Column, days: int = 92) -> DataFrame:
    """Split the closed range of each row into closed ranges of ``days`` + 1 days."""
    s, e = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    step = F.make_dt_interval(days=F.lit(days + 1))
    return (df.withColumn("chunk_start", F.explode(F.sequence(s, e, step)))
            .withColumn("chunk_end", F.least(F.date_add("chunk_start", days), e)))


def anti_existing(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows whose key is not stored yet.

    The new batch is computed once and written to the shared folder. The stored keys are cut to those that occur in it;
    the batch is the small side, so Spark can broadcast its keys and the stored table is read once without a shuffle.
    """
    batch = reliable_checkpoint(new, "batch")
    known = stored.select(*keys).join(batch.select(*keys), list(keys), "left_semi").distinct()
    return batch.join(known, list(keys), "left_anti")
