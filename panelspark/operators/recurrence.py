"""Exponential recurrences y_t = a*y_(t-1) + b*x_t with plain window sums, for any rate and with gaps.

The inputs that are not NULL are numbered, and the numbers are cut into blocks. A block is one affine map: it multiplies
what it is given by a^L and adds its own partial sum. Inside a block the partial sum is a window sum of z * a^-k scaled
by a^k, where z is the seed first and b*x after it. The length L of a block follows the rate, so that a^-L can neither
overflow nor leave anything of the block before last: a^L lies below 1e-30, far under double precision. So the map of one
earlier block is all that a row needs, and a second window carries it.

A NULL input changes nothing: its row repeats the average so far. Rates that allow it share a block length, and all
windows share the partitioning of the company key, so a chain of recurrences costs one shuffle. No arrays, no Python rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Block length preferred wherever the rate allows it.
BLOCK = 1024

#: Least and most a block may decay, as a natural logarithm: e^-69 is 1e-30, e^650 is far from overflow.
LEAST_DECAY, MOST_DECAY = 69.0, 650.0


@dataclass(frozen=True)
class Ewm:
    """One recurrence: input column, smoothing rate in (0, 1], and how it is seeded.

    ``seed=1`` starts from the first value; ``seed=n`` starts at the n-th value with the mean of the first n, and is
    NULL before it. ``like`` names a column that is NULL in the same rows as the input; inputs that name the same
    column are numbered once.
    """

    source: str
    alpha: float
    seed: int = 1
    like: str | None = None

    def __post_init__(self) -> None:
        if not 0.0 < self.alpha <= 1.0 or self.seed < 1:
            raise ValueError(f"rate {self.alpha} must lie in (0, 1] and seed {self.seed} must be positive")

    @property
    def block(self) -> int:
        if self.alpha == 1.0:
            return 1
        decay = -math.log1p(-self.alpha)
        return BLOCK if LEAST_DECAY <= BLOCK * decay <= MOST_DECAY else max(1, math.ceil(LEAST_DECAY / decay))

    @property
    def index(self) -> str:
        return self.like or self.source


def span(n: int) -> float:
    return 2.0 / (n + 1.0)


def indexed(df: DataFrame, key: str = "company_id", order: str | list[str] = "date") -> DataFrame:
    """Add row number ``_i`` (from 0) and block ``_b`` per key."""
    w = Window.partitionBy(key).orderBy(order)
    return (df.withColumn("_i", F.row_number().over(w) - 1)
            .withColumn("_b", F.floor(F.col("_i") / BLOCK)))


def ewm(df: DataFrame, specs: Mapping[str, Ewm], key: str = "company_id", order: str | list[str] = "date") -> DataFrame:
    """Add one column per spec, along ``order``; the input may carry ``_i`` and ``_b`` (see :func:`indexed`).

    An average is NULL before its seed; a NULL input later keeps the average as it is.
    """
    run = Window.partitionBy(key).orderBy(order)
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = list(specs)
    number = {s.index: f"_n_{s.index}" for s in specs.values()}
    means = {name: f"_m_{name}" for name, s in specs.items() if s.seed > 1}
    df = df.select("*", *[F.count(c).over(upto).alias(n) for c, n in number.items()],
                   *[F.avg(specs[name].source).over(upto).alias(m) for name, m in means.items()])

    blocks = {(s.index, s.block): f"_q_{s.index}_{s.block}" for s in specs.values()}
    df = df.select("*", *[F.floor((F.col(number[c]) - 1) / length).alias(q) for (c, length), q in blocks.items()])

    def place(s: Ewm) -> Column:
        return F.col(number[s.index]) - 1 - F.col(blocks[s.index, s.block]) * s.block

    for (c, length), q in blocks.items():
        inside = Window.partitionBy(key, q).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = []
        for name in names:
            s = specs[name]
            if (s.index, s.block) != (c, length):
                continue
            x, n, k, a = F.col(s.source), F.col(number[c]), place(s), F.lit(1.0 - s.alpha)
            first = F.col(means[name]) if name in means else x
            z = F.when(x.isNotNull() & (n == s.seed), first).when(n > s.seed, x * s.alpha)
            local.append((F.pow(a, k) * F.sum(z * F.pow(a, -k)).over(inside)).alias(f"_l_{name}"))
        df = df.select("*", *local)

    # the first value of a block sees, one row back, the whole sum of the block before
    back = {name: F.when(F.col(specs[name].index).isNotNull() & (place(specs[name]) == 0),
                         F.lag(f"_l_{name}", 1).over(run)).alias(f"_p_{name}") for name in names}
    df = df.select("*", *back.values())
    df = df.select("*", *[F.last(f"_p_{name}", ignorenulls=True).over(upto).alias(f"_c_{name}") for name in names])
    out = []
    for name, s in specs.items():
        carry = F.pow(F.lit(1.0 - s.alpha), place(s) + 1) * F.col(f"_c_{name}")
        y = F.coalesce(F.col(f"_l_{name}"), F.lit(0.0)) + F.coalesce(carry, F.lit(0.0))
        out.append(F.when(F.col(number[s.index]) >= s.seed, y).alias(name))
    made = {*number.values(), *means.values(), *blocks.values(), *(f"_{p}_{name}" for p in "lpc" for name in names)}
    return df.select(*[c for c in df.columns if c not in made and c not in specs], *out)


def rsi_inputs(df: DataFrame, close: str = "close", key: str = "company_id", order: str = "date", **extra: Column) -> DataFrame:
    """Add ``_up`` and ``_down``, the gains and losses from row to row.

    ``extra`` columns over the same window are added in the same stage.
    """
    delta = F.col(close) - F.lag(close, 1).over(Window.partitionBy(key).orderBy(order))
    d = F.col("_d")
    return (df.select("*", delta.alias("_d"), *[c.alias(n) for n, c in extra.items()])
            .withColumn("_up", F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))))
            .withColumn("_down", F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))).drop("_d"))


def rsi_from(up: str, down: str) -> Column:
    """100*up/(up+down); NULL when nothing moved."""
    total = F.col(up) + F.col(down)
    return 100.0 * F.col(up) / F.nullif(total, F.lit(0.0))
