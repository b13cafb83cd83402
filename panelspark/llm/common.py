"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import reliable_checkpoint

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a lookup table is broadcast after it was counted.
BROADCAST_ROWS = 100_000

#: Rows of whole texts that Spark hands to Python at a time.
BATCH_ROWS = 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches, as JVM and worker hold each one several times over; a chosen number is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:  # Spark's own default
        spark.conf.set(key, BATCH_ROWS)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back, so that no later step computes it again."""
    return reliable_checkpoint(df, f"llm-{name}")


def crc_remainder(key: str | Column, mod: int) -> Column:
    """crc32 of a key written as text, modulo ``mod``; NULL for a NULL key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % mod


def held_out(key: str | Column, mod: int, remainder: int) -> Column:
    """True for rows kept out of training; a NULL key is never held out."""
    return F.coalesce(crc_remainder(key, mod) == remainder, F.lit(False))


def fresh(names: list[str], base: str) -> str:
    """A column name like ``base`` that no given column has, in any case of its letters."""
    taken = {n.lower() for n in names}
    while base.lower() in taken:
        base += "_"
    return base


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """Whole rows as a struct ``row`` beside the named columns, so that added columns cannot meet names of the input."""
    whole = F.struct(*["`" + c.replace("`", "``") + "`" for c in docs.columns])
    return docs.select(whole.alias("row"), *columns)


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a stored lookup table by NULL-safe keys.

    ``small`` must be cheap to count (a stage table). It is broadcast only after the count showed at most
    ``max_rows`` rows; a larger one is joined by shuffle, where adaptive execution splits hot keys.
    """
    side = small.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in small.columns])
    match = None
    for c in on:
        one = big[c].eqNullSafe(F.col(f"_k_{c}"))
        match = one if match is None else match & one
    if small.limit(max_rows + 1).count() <= max_rows:
        side = F.broadcast(side)
    return big.join(side, match, how).drop(*[f"_k_{c}" for c in on])


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; a NULL text gives no bytes."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""


def row_blocks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to ``limit`` at most, or of a single larger row."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
