"""Positions and running totals over a whole table without one big task.

An un-partitioned window would send every row to a single task. Here sampled splitters cut the order keys into ranges of
about equal size (``repartitionByRange``), whatever the type of the keys and however far apart their values lie. A row's
place inside its range comes from the sorted range itself; only the totals of the ranges, one row each, are accumulated
in one place. The ranged rows are stored once, so that counting and reading see the same ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

#: Bits of a row's number inside its partition in ``monotonically_increasing_id``.
_PLACE_BITS = 33


def in_ranges(df: DataFrame, order: Sequence[str], name: str = "ranges") -> DataFrame:
    """Stored copy of the frame, with ``_part`` (ranges ascend) and ``_place`` (from 0 inside the range)."""
    at = F.monotonically_increasing_id()
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row_id", at)
    return reliable_checkpoint(cut.select(
        *df.columns, F.shiftright("_row_id", _PLACE_BITS).alias("_part"),
        F.col("_row_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place")), name)


def range_offsets(ranged: DataFrame, totals: Sequence[str] = ()) -> DataFrame:
    """One row per range: ``_rows_off`` and ``_<total>_off`` of all ranges before it, ``_rows_all`` of the table."""
    per = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(t).alias(t) for t in totals])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per.select("_part", F.sum("_rows").over(every).alias("_rows_all"), *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c if c == '_rows' else '_' + c}_off")
        for c in ("_rows", *totals)])


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position`` (from 0) in the given order and ``n_rows``, the rows of the table.

    Two passes over the frame (splitters, then the ranges) and two over the stored ranges.
    """
    ranged = in_ranges(df, order)
    offsets = F.broadcast(range_offsets(ranged))  # one row per range
    return (ranged.join(offsets, "_part")
            .select(*df.columns, (F.col("_rows_off") + F.col("_place")).alias("position"), F.col("_rows_all").alias("n_rows")))


def running_totals(df: DataFrame, order: str, totals: Sequence[str]) -> DataFrame:
    """Add ``<total>_before``: the sum over all rows with a smaller order key.

    ``df`` has one row per order key, so no range can hold more than its share.
    """
    ranged = in_ranges(df, [order])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(t).over(inside), F.lit(0)).alias(f"_{t}_in") for t in totals])
    offsets = F.broadcast(range_offsets(ranged, totals).drop("_rows_off", "_rows_all"))  # one row per range
    return (out.join(offsets, "_part")
            .select(*df.columns, *[(F.col(f"_{t}_off") + F.col(f"_{t}_in")).alias(f"{t}_before") for t in totals]))


def stacked_position(df: DataFrame, key: str = "company_id", order: str = "date") -> DataFrame:
    """Positions in the frame sorted by key, then order."""
    return positions(df, [key, order])


def date_position(df: DataFrame, key: str = "company_id", order: str = "date") -> DataFrame:
    """Positions in the frame sorted by order, then key."""
    return positions(df, [order, key])
