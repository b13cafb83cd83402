"""Time-series operators over (company, date) panels.

A panel holds one row per (key, date); :func:`panelspark.operators.dedup.one_per_key`
enforces that. A window partition is therefore never longer than the number of
calendar days in the table, whatever share of the raw rows one company has: the
raw rows are reduced by map-side aggregation before they reach a window.

Callers build one window spec and put all expressions of a stage in one select,
so Spark plans one Window operator and one shuffle per stage.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .ordering import running_totals


def series(key: str | Sequence[str] = "company_id", order: str = "date") -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the divisor is zero."""
    return num / F.nullif(den, F.lit(0.0))


def rolling(agg: Callable[[Column], Column], x: str | Column, n: int, w: WindowSpec) -> Column:
    """Aggregate over n rows; NULL until the frame has n non-NULL values."""
    frame = w.rowsBetween(-(n - 1), 0)
    x = _col(x)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


def log_return(close: str | Column, k: int, w: WindowSpec) -> Column:
    c = _col(close)
    return F.log(c) - F.log(F.lag(c, k).over(w))


def forward_log_return(close: str | Column, horizon: int, w: WindowSpec) -> Column:
    c = _col(close)
    return F.log(F.lead(c, horizon).over(w)) - F.log(c)


def direction(y: Column, tail_zero: bool = False) -> Column:
    """1 for a positive forward return, else 0; NULL (or 0) where it is unknown."""
    up = F.when(y > 0, 1).when(y.isNotNull(), 0)
    return F.coalesce(up, F.lit(0)) if tail_zero else up


def log_range(close: str | Column, n: int, w: WindowSpec) -> Column:
    return F.log(rolling(F.max, close, n, w) / rolling(F.min, close, n, w))


def difference(x: str | Column, k: int, w: WindowSpec) -> Column:
    x = _col(x)
    return x - F.lag(x, k).over(w)


def ffill(x: str | Column, w: WindowSpec) -> Column:
    return F.last(_col(x), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def bfill(x: str | Column, w: WindowSpec) -> Column:
    """First known value from here on (apply after :func:`ffill` for both)."""
    return F.first(_col(x), ignorenulls=True).over(
        w.rowsBetween(Window.currentRow, Window.unboundedFollowing))


def pct_change(x: str | Column, k: int, w: WindowSpec, shift: int = 0) -> Column:
    """k-step relative change of the forward-filled series; x/0 gives NULL.

    ``shift`` takes the change as it was known that many rows back. The filled
    series some rows back equals the last known value of the frame that ends
    there, so no nested window is needed.
    """
    x = _col(x)

    def known(back: int) -> Column:
        return F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -back))
    return ratio(known(shift), known(shift + k)) - 1.0


def bollinger(close: str | Column, n: int, k: float, w: WindowSpec) -> tuple[Column, Column]:
    """Upper and lower band with the population deviation."""
    mid = rolling(F.avg, close, n, w)
    dev = rolling(F.stddev_pop, close, n, w)
    return mid + k * dev, mid - k * dev


def stochastic_raw(high: str, low: str, close: str, n: int, w: WindowSpec) -> Column:
    """Position of the close in the n-row range, in percent (before smoothing)."""
    ll, hh = rolling(F.min, low, n, w), rolling(F.max, high, n, w)
    return 100.0 * ratio(F.col(close) - ll, hh - ll)


def volume_pressure(volume: str, n: int, w: WindowSpec) -> Column:
    v = F.col(volume).cast("double")
    return ratio(v, rolling(F.avg, v, n, w)) - 1.0


def weekday_cycle(date: str | Column) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * F.weekday(_col(date)) / F.lit(5)
    return F.sin(angle), F.cos(angle)


def phase_cycle(phase: Column) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * phase
    return F.sin(angle), F.cos(angle)


def month_phase(key: str = "company_id", date: str = "date", scope: str = "key") -> Column:
    """Position of the row among the rows of its month, as a share of them.

    ``scope="panel"`` counts over all companies of the month. Its result for a
    row depends on the whole month's rows, so use :func:`panel_month_phase`.
    """
    if scope != "key":
        raise ValueError("use panel_month_phase for the panel-wide count")
    month = Window.partitionBy(key, F.trunc(date, "month"))
    return F.row_number().over(month.orderBy(date)) / F.count(F.lit(1)).over(month)


def panel_month_phase(df: DataFrame, key: str = "company_id", date: str = "date") -> DataFrame:
    """Month phase counted over the stacked panel (rows ordered by key, then date).

    Rows are counted per (month, company) first. Ranges of these counts are accumulated, so a month with very many
    companies spreads over tasks; what lies before the month is then taken off.
    """
    month = F.trunc(date, "month")
    blocks = df.groupBy(F.struct(month.alias("_m"), F.col(key).alias("_k")).alias("_at")).agg(F.count(F.lit(1)).alias("_c"))
    blocks = running_totals(blocks, "_at", ["_c"]).select("_at._m", F.col("_at._k").alias(key), "_c", "_c_before")
    months = F.broadcast(blocks.groupBy("_m").agg(  # one row per calendar month
        F.min("_c_before").alias("_start"), F.sum("_c").alias("_total")))
    own = Window.partitionBy(key, "_m").orderBy(date)
    return (df.withColumn("_m", month).join(blocks, ["_m", key]).join(months, "_m")
            .withColumn("month_phase", (F.col("_c_before") - F.col("_start") + F.row_number().over(own)) / F.col("_total"))
            .select(*df.columns, "month_phase"))


def add_lags(df: DataFrame, col: str, n: int, w: WindowSpec, prefix: str | None = None) -> DataFrame:
    prefix = prefix or f"{col}_lag_"
    return df.select("*", *[F.lag(col, i).over(w).alias(f"{prefix}{i}") for i in range(1, n + 1)])


def min_history(df: DataFrame, n: int, key: str = "company_id") -> DataFrame:
    """Rows of the companies that have at least n rows."""
    return (df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
            .where(F.col("_n") >= n).drop("_n"))


def last_n(df: DataFrame, n: int, key: str = "company_id", order: str = "date") -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def price_path(last_price: Column, r: Column, w: WindowSpec) -> Column:
    return last_price * F.exp(
        F.sum(r).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def shrink_clip(r: Column, bias: float | Column = 0.0, shrink: float = 1.0,
                clip: tuple[float | Column, float | Column] | None = None) -> Column:
    out = (r - bias) * shrink
    if clip is None:
        return out
    lo, hi = (c if isinstance(c, Column) else F.lit(c) for c in clip)
    return F.when(out.isNotNull(), F.least(F.greatest(out, lo), hi))
