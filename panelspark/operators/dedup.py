"""One row per key, by aggregation.

``max_by`` over a struct is combined on the map side, so a key with very many
copies is reduced before the shuffle; no task ever holds all copies of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _comparable(field: T.StructField) -> Column:
    """A column that can be ordered; a map counts as its sorted entries."""
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(field.name)).alias(field.name)
    return F.col(field.name)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                keep: str = "last") -> DataFrame:
    """Keep the last (or first) row of each key in the given order.

    Ties in ``order`` are broken by the remaining columns, so the result does
    not depend on the arrival order of rows. Map columns are kept as they are.
    """
    pick = F.max_by if keep == "last" else F.min_by
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *[_comparable(df.schema[c]) for c in rest if c not in order])
    row = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row"))
    return row.select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The newest row of each key."""
    return one_per_key(df, keys, [order])
