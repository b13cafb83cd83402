"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Tables

Build = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under a name; ``sql`` is its DuckDB twin."""
    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build
    return register


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: q.build(Tables(spark, folder))


def round_half_up(x: Column, digits: int) -> Column:
    """x to so many decimals, halves away from zero, as the twins round; plain arithmetic wherever it is exact.

    Spark's own rounding goes through decimal text, which costs more than the window stages before it.
    """
    scale = 10.0 ** digits
    up = F.when(x < 0, -F.floor(0.5 - x * scale)).otherwise(F.floor(x * scale + 0.5))
    return F.when(F.abs(x) * scale < 2.0 ** 52, up / F.lit(scale)).otherwise(F.round(x, digits))


def rounded(df: DataFrame, digits: int | dict[str, int] = 8, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round the floating columns, so that both engines agree on the last digits."""
    def one(f: T.StructField):
        d = digits.get(f.name, 8) if isinstance(digits, dict) else digits
        if isinstance(f.dataType, T.DoubleType) and f.name not in skip:
            return round_half_up(F.col(f.name), d).alias(f.name)
        return F.col(f.name)
    return df.select(*[one(f) for f in df.schema])


def rnd(expr: str, digits: int = 8) -> str:
    """The same rounding in SQL, without a negative zero."""
    r = f"round({expr}, {digits})"
    return f"CASE WHEN {r} = 0 THEN 0.0::DOUBLE ELSE {r} END"
