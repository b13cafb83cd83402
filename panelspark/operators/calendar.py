"""Trading sessions: index, next sessions and month phase.

A calendar has one row per day, so its windows and broadcasts are bounded by
the number of days it covers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import asof_series, is_business_day


def sessions(calendar: DataFrame) -> DataFrame:
    """Distinct trading days."""
    return calendar.where("is_trading_day").select(F.col("trade_date").alias("date")).distinct()


def session_index(calendar: DataFrame) -> DataFrame:
    """Trading days numbered from 1."""
    return sessions(calendar).withColumn("idx", F.row_number().over(Window.orderBy("date")))


def next_sessions(last: DataFrame, n: int, calendar: DataFrame | None = None,
                  on: str = "last_date") -> DataFrame:
    """The first n sessions after the date of each row, as (step, date).

    Without a calendar the next n business days are taken. A calendar with too
    few future sessions is an error.
    """
    if calendar is None:
        days = F.sequence(F.date_add(on, 1), F.date_add(on, (n // 5 + 2) * 7))
        nxt = F.slice(F.filter(days, lambda d: is_business_day(d)), 1, n)
        out = last.select("*", F.posexplode(nxt).alias("_p", "date"))
        return out.withColumn("step", F.col("_p") + 1).drop("_p")
    idx = session_index(calendar)
    total = idx.agg(F.max("idx").alias("n")).select("n").scalar()
    base = asof_series(last.withColumnRenamed(on, "date"), idx).withColumnRenamed("date", on)
    at = F.coalesce("idx", F.lit(0))
    enough = F.when(at + n <= total, at).otherwise(F.raise_error(
        F.concat(F.lit("too few future sessions: "), total - at)).cast("int"))
    steps = base.select(*last.columns, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"),
                        enough.alias("_at"))
    steps = steps.withColumn("idx", F.col("_at") + F.col("step"))
    return steps.join(F.broadcast(idx), "idx").drop("idx", "_at")


def session_phase(calendar: DataFrame) -> DataFrame:
    """(date, phase) of every calendar day: its place among the sessions of its month.

    A month without sessions falls back to business days.
    """
    day = calendar.groupBy(F.col("trade_date").alias("date")).agg(
        F.max(F.col("is_trading_day").cast("int")).alias("s"))
    day = day.withColumn("b", is_business_day("date").cast("int"))
    month = Window.partitionBy(F.trunc("date", "month"))
    before = month.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)

    def phase(flag: str):
        pos = F.coalesce(F.sum(flag).over(before), F.lit(0)) + 1
        return pos / F.greatest(F.sum(flag).over(month), F.lit(1))
    return day.select("date", F.when(F.sum("s").over(month) > 0, phase("s")).otherwise(phase("b")).alias("phase"))
