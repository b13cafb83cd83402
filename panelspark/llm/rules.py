"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over the stored failure bits.

The ledger holds one row per document with the measurements and ``fail_bits`` (bit k set: rule k failed). A policy is a
named, versioned set of rules; applying it is one bitwise AND, and ablations are counts over the bits. Everything is
built from DataFrame functions, row by row: no shuffle, and memory is bounded by one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rules in bit order: name and the SQL condition under which a document fails, over the measurements.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("shouting", "2 * n_upper > word_chars"),
]
BASE = ("few_words", "repeated_windows")
#: Policies by name and version; a policy names the rules that it enforces.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": BASE,
    "web-1": tuple(name for name, _ in RULES),
}


def mask(names: tuple[str, ...]) -> int:
    """Bits of the named rules."""
    order = [name for name, _ in RULES]
    return sum(1 << order.index(n) for n in set(names))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text, by window hashes of 64 bits.

    Only a text with a repeated window is sorted. Covered words are counted from the sorted starts: each start adds the
    distance to the next one, five at most.
    """
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - (WINDOW - 1)),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))

    def starts(win: Column) -> Column:
        rows = F.array_sort(F.transform(win, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return _let(rows, lambda s: F.array_sort(F.transform(F.filter(s, lambda x, j: F.coalesce(
            (F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"]),
            F.get(s, j - 1)["w"] == x["w"], F.get(s, j + 1)["w"] == x["w"], F.lit(False))), lambda x: x["i"])))

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeated(win: Column) -> Column:
        return (F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0))
                .otherwise(_let(starts(win), covered)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return (F.when(F.size(words) <= WINDOW, F.lit(0))
            .otherwise(_let(hashes, lambda h: _let(windows(h), repeated))))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and failure bits per document.

    A NULL text has no words. Repeated rows stay separate; other columns are ignored; an empty table gives no rows.
    Returns doc_id, the measurements (long) and fail_bits (long).
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).select(
        "doc_id",
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        upper.cast("long").alias("n_upper"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_lines"),
        _let(F.filter(F.split(text, SPACE), lambda w: w != ""),
             lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("_words"))
    measured = base.select("doc_id", "word_chars", "n_symbols", "n_upper", F.col("_lines.n").cast("long").alias("n_lines"),
                           (F.col("_lines.n") - F.col("_lines.d")).cast("long").alias("n_dup_lines"),
                           F.col("_words.n").cast("long").alias("n_words"),
                           F.col("_words.r").cast("long").alias("n_repeat_words"))
    bits = F.lit(0).cast("long")
    for k, (_, condition) in enumerate(RULES):
        bits = bits + F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    return measured.withColumn("fail_bits", bits)


def apply_policy(rows: DataFrame, policy: str) -> Column:
    """True for ledger rows that fail no rule of the policy."""
    return rows["fail_bits"].bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def only_rule(policy: str) -> Column:
    """Name of the rule of the policy that a ledger row fails alone, so that it would be kept without it; else NULL."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy])))
    return F.coalesce(*[F.when(bits == (1 << k), F.lit(name)) for k, (name, _) in enumerate(RULES) if name in POLICIES[policy]])


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    One aggregation over the distinct masked bits; an empty ledger gives zero counts.
    """
    m = mask(POLICIES[policy])
    bits = F.col("fail_bits").bitwiseAND(F.lit(m))
    sums = [F.coalesce(F.sum(F.when(c, F.col("n")).otherwise(0)), F.lit(0)).alias(f"{what}_{k}")
            for k, (name, _) in enumerate(RULES) if name in POLICIES[policy]
            for what, c in (("failed", F.col("b").bitwiseAND(F.lit(1 << k)) != 0), ("alone", F.col("b") == (1 << k)),
                            ("kept", F.col("b").bitwiseAND(F.lit(m & ~(1 << k))) == 0))]
    one = rows.groupBy(bits.alias("b")).agg(F.count("*").alias("n")).agg(*sums)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"failed_{k}").alias("n_failed"), F.col(f"alone_{k}").alias("n_alone"),
                 F.col(f"kept_{k}").alias("n_kept_without"))
        for k, (name, _) in enumerate(RULES) if name in POLICIES[policy]])).alias("r")).select("r.*")


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(regexp_extract_all(text, '{WORD}')) AS w,
  generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) AS i FROM t),
g AS (SELECT rid, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o
  || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o END AS g FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
c AS (SELECT rid, i, g IS NOT NULL AND count(*) OVER (PARTITION BY rid, g) > 1 AS twice FROM g),
r AS (SELECT rid, i, max(twice) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM c),
n AS (SELECT rid, count(*) FILTER (hit) AS n_repeat_words, count(*) AS n_words FROM r GROUP BY rid),
l AS (SELECT rid, len(x) AS n_lines, len(x) - len(list_distinct(x)) AS n_dup_lines FROM (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS x FROM t)),
m AS (SELECT t.doc_id, coalesce(n.n_words, 0) AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, n_lines, n_dup_lines,
  length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
  coalesce(n.n_repeat_words, 0) AS n_repeat_words FROM t LEFT JOIN n USING (rid) JOIN l USING (rid)),
f AS (SELECT *, {" + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, (_, c) in enumerate(RULES))} AS bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
 CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
 CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(bits AS BIGINT) AS fail_bits,
 (bits & {mask(BASE)}) <> 0 AS base_failed, (bits & {mask(POLICIES["web-1"])}) = 0 AS kept, only_rule,
 CASE WHEN only_rule IS NOT NULL THEN CAST(count(*) OVER (PARTITION BY only_rule) AS BIGINT) END AS n_like
FROM (SELECT *, CASE bits & {mask(POLICIES["web-1"])} {" ".join(f"WHEN {1 << k} THEN '{name}'" for k, (name, _) in enumerate(RULES) if name in POLICIES["web-1"])} END AS only_rule FROM f)
"""
