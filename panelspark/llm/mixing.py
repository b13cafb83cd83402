"""Mixing sources to target weights with hash-threshold histograms.

Sizes are summed by source and hash bucket. Running sums over the buckets of a source find where each budget ends; only
the boundary bucket is split further, level by level. What is left is a threshold per source, so documents are chosen
by a filter on their hash, without sorting. Budgets are nested, and reruns agree.

The document at the threshold may be long, so a source would stop short of its target. What is missing is filled up from
beyond the threshold: of each size that fits, the document of least hash stands by, and sizes are tried from the largest
to the smallest; one more document is taken if that comes nearer to the target than stopping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, packed, stage

#: Hash bits looked at by one level, and the number of levels.
LEVEL_BITS, LEVELS = 12, 4

# Weights by rank of the source, share of all sizes, most uses of a document
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size in words (NULL text: 0) and a hash of id and text as a number of 48 bits, then ``keep``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.md5(F.concat(ident, F.lit(":"), F.md5(text.cast("binary"))).cast("binary"))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.size(words).cast("long").alias("size"),
                       F.conv(F.substring(digest, 1, 12), 16, 10).cast("long").alias("h"),
                       *keep)


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size and target per source.

    A target is the source's share by weight, two times its size at most; the excess is shared again. Sources ordered
    by size per weight meet their limit first, so one running sum gives the level of the others. There is one row per
    source here, so the global window is bounded by the number of sources.
    """
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int")).cast("long"))
    by = by.withColumn("top", MOST * F.col("source_size"))
    every, order = Window.partitionBy(), Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0))
    level = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    by = by.withColumn("level", level).withColumn("open", F.col("level") <= F.col("top") / F.col("w"))
    first = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(every)
    return by.withColumn("first", first).select("source", "source_size", F.least(
        F.col("top").cast("double"), F.coalesce(F.col("first") * F.col("w"), F.col("top").cast("double"))).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Hash below which the documents of a source fill its budget, and what is left of it: source, threshold, rest.

    ``rows`` has source, size, h (stored, as it is read once a level); ``budgets`` has source and budget, a whole number.
    A level sums sizes by source and bucket, takes the longest run of buckets within the budget, and goes on with the
    next bucket. ``rest`` is 0 for a source that is used up.
    """
    total = LEVEL_BITS * LEVELS
    state = budgets.select("source", F.col("budget").cast("long").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    for level in range(1, LEVELS + 1):
        shift = total - LEVEL_BITS * level
        side = state.select("source", "rest", "prefix")
        hit = lookup_join(rows.select("source", "size", F.shiftright("h", shift).alias("b")), side, ["source"], "inner")
        sums = (hit.filter(F.shiftright("b", LEVEL_BITS) == F.col("prefix"))
                .groupBy("source", "b").agg(F.sum("size").alias("s"), F.first("rest").alias("rest")))
        run = Window.partitionBy("source").orderBy("b")
        over = sums.withColumn("cum", F.sum("s").over(run)).filter(F.col("cum") > F.col("rest"))
        edge = over.groupBy(F.col("source").alias("_s")).agg(
            F.min(F.struct("b", (F.col("rest") - (F.col("cum") - F.col("s"))).alias("rest"))).alias("e"))
        # a source without an edge takes all of the bucket: its prefix moves past it, and nothing is left to fill
        state = stage(state.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", F.coalesce("e.rest", F.lit(0)).alias("rest"),
            F.coalesce("e.b", F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)).alias("prefix")), "edges")
    return state.select("source", F.col("prefix").alias("threshold"), "rest")


def fillers(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """source, size, h of the documents beyond the threshold that fill what is left, as near as sizes allow.

    A source's candidates are one per size below twice the rest, so its list is bounded by the length of a document.
    """
    left = lookup_join(rows.select("source", "size", "h"), edges.filter("rest > 0"), ["source"], "inner")
    left = left.filter((F.col("h") >= F.col("threshold")) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("rest")))
    first = stage(left.groupBy("source", "size").agg(F.min("h").alias("h"), F.first("rest").alias("rest")), "standing-by")
    # equal rows share a hash and are taken together
    same = lookup_join(left.select("source", "size", "h"), first, ["source", "size", "h"], "inner")
    each = same.groupBy("source", "size", "h", "rest").agg((F.count("*") * F.col("size")).alias("w"))
    lists = each.groupBy("source").agg(F.first("rest").alias("rest"), F.sort_array(
        F.collect_list(F.struct("size", "h", "w")), asc=False).alias("items"))
    none = F.lit(None).cast("struct<w:bigint,size:bigint,h:bigint>")
    start = F.struct(F.col("rest").alias("rest"), F.array().cast("array<struct<size:bigint,h:bigint>>").alias("got"),
                     none.alias("miss"))

    def step(acc, x):
        fits = x["w"] <= acc["rest"]
        skipped = F.struct(x["w"].alias("w"), x["size"].alias("size"), x["h"].alias("h"))
        return F.struct(
            (acc["rest"] - F.when(fits, x["w"]).otherwise(0)).alias("rest"),
            F.when(fits, F.concat(acc["got"], F.array(F.struct(x["size"].alias("size"), x["h"].alias("h"))))
                   ).otherwise(acc["got"]).alias("got"),
            F.when(fits, acc["miss"]).otherwise(F.least(skipped, acc["miss"])).alias("miss"))

    done = lists.select("source", F.aggregate("items", start, step).alias("f"))
    nearer = F.col("f.miss.w") < 2 * F.col("f.rest")
    more = F.when(nearer, F.array(F.struct("f.miss.size", "f.miss.h"))).otherwise(
        F.array().cast("array<struct<size:bigint,h:bigint>>"))
    return done.select("source", F.explode(F.concat("f.got", more)).alias("x")).select("source", "x.size", "x.h")


def plan(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored plan per source (source_size, target, whole, threshold) and the fillers, from stored sizes."""
    goals = stage(targets(rows).withColumn("whole", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")), "targets")
    budget = F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    edges = stage(thresholds(rows, goals.select("source", budget.alias("budget"))), "thresholds")
    whole = goals.join(edges.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "rest")
    return stage(whole, "plan"), stage(fillers(rows, edges).withColumn("fills", F.lit(1)), "fillers")


def with_copies(rows: DataFrame, sources: DataFrame, fills: DataFrame) -> DataFrame:
    """``rows`` (see :func:`sizes`) with source_size, target and copies; neither texts nor rows are shuffled."""
    out = lookup_join(lookup_join(rows, sources, ["source"]), fills, ["source", "size", "h"])
    more = ((F.col("h") < F.col("threshold")) | F.col("fills").isNotNull()) & (F.col("source_size") > 0) & (F.col("whole") < MOST)
    return out.withColumn("copies", F.col("whole") + F.when(more, 1).otherwise(0)).drop("threshold", "fills", "whole")


def mix(docs: DataFrame, **columns: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken per row of ``docs``.

    All documents of a source are used floor(target / size) times; those with a hash below the source's threshold, and
    its fillers, once more. Rows with equal id and text share a hash and fate. A NULL source is a source of its own. A
    source without words has target 0 and its documents 0 copies. Other columns are ignored; an empty table gives no rows.
    """
    rows = stage(sizes(docs, **columns), "sizes")
    return (with_copies(rows, *plan(rows))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns whatever their names."""
    names = (id_col, text_col, source_col)
    rows = sizes(packed(docs, *names), *names, keep=("row",))
    chosen = with_copies(rows, *plan(stage(sizes(docs, *names), "sizes")))
    return (chosen.filter(F.col("copies") > 0)
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM t GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2 * source_size AS top FROM s),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(top) OVER b, 0) AS DOUBLE))
  / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS level FROM w
  WINDOW b AS (ORDER BY top / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (SELECT level FROM l WHERE level <= top / w ORDER BY top / w, source NULLS LAST LIMIT 1) AS first FROM l),
g AS (SELECT source, source_size, least(CAST(top AS DOUBLE), first * w) AS target,
  CASE WHEN source_size > 0 THEN CAST(floor(least(CAST(top AS DOUBLE), first * w) / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM f),
c AS (SELECT t.doc_id, t.size, t.h, g.*, CAST(floor(target - whole * source_size) AS BIGINT) AS budget,
  CAST(sum(t.size) OVER (PARTITION BY t.source ORDER BY t.h) AS BIGINT) AS cum
  FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source),
r AS (SELECT source, any_value(budget) - coalesce(max(cum) FILTER (cum <= budget), 0) AS rest FROM c GROUP BY source
  HAVING count(*) FILTER (cum > budget) > 0),
e AS (SELECT c.source, c.size, c.h, c.size * count(*) AS w, any_value(r.rest) AS rest FROM c
  JOIN r ON r.source IS NOT DISTINCT FROM c.source WHERE c.cum > c.budget AND c.size > 0 AND c.size < 2 * r.rest
  GROUP BY c.source, c.size, c.h QUALIFY row_number() OVER (PARTITION BY c.source, c.size ORDER BY c.h) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC) AS i FROM e),
k(source, i, rest, got) AS (SELECT source, 0::BIGINT, rest, false FROM r
  UNION ALL SELECT o.source, o.i, k.rest - CASE WHEN o.w <= k.rest THEN o.w ELSE 0 END, o.w <= k.rest
  FROM k JOIN o ON o.source IS NOT DISTINCT FROM k.source AND o.i = k.i + 1),
z AS (SELECT source, arg_max(rest, i) AS rest FROM k GROUP BY source),
fill AS (SELECT o.source, o.size, o.h FROM o JOIN k ON k.source IS NOT DISTINCT FROM o.source AND k.i = o.i AND k.got
  UNION ALL SELECT o.source, o.size, o.h FROM o JOIN k ON k.source IS NOT DISTINCT FROM o.source AND k.i = o.i AND NOT k.got
  JOIN z ON z.source IS NOT DISTINCT FROM o.source QUALIFY row_number() OVER (PARTITION BY o.source ORDER BY o.w, o.size, o.h) = 1
  AND o.w < 2 * z.rest)
SELECT c.doc_id, c.size, source_size, target, CAST(c.size * (whole + CASE WHEN source_size > 0 AND whole < 2
  AND (cum <= budget OR fill.size IS NOT NULL) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
LEFT JOIN fill ON fill.source IS NOT DISTINCT FROM c.source AND fill.size = c.size AND fill.h = c.h
"""
