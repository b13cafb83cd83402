"""Aggregates: quantiles, metrics, weights and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import date_position, running_totals, stacked_position


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of a whole column, one row per prob.

    Values are counted per distinct value and accumulated in order. Only the rows around the wanted ranks are picked.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")) \
        .agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, "v", ["n"])
    total = cum.agg(F.sum("n").alias("t")).select("t").scalar()
    ps = F.array(*[F.lit(float(p)) for p in probs])
    ranked = cum.select("v", "n", "n_before", F.explode(ps).alias("prob"))
    rank = F.col("prob") * (total - 1)
    ranked = ranked.withColumn("_lo", F.floor(rank)).withColumn("_hi", F.ceil(rank)) \
        .withColumn("_f", rank - F.floor(rank))

    def holds(k: str) -> Column:
        return (F.col("n_before") <= F.col(k)) & (F.col(k) < F.col("n_before") + F.col("n"))
    ranked = ranked.where(holds("_lo") | holds("_hi"))
    out = ranked.groupBy("prob").agg(
        F.max(F.when(holds("_lo"), F.col("v"))).alias("_a"),
        F.max(F.when(holds("_hi"), F.col("v"))).alias("_b"), F.first("_f").alias("_f"))
    return out.select("prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("value"))


def winsorize_by_key(df: DataFrame, col: str, p: float | None, key: str = "company_id") -> DataFrame:
    """Clip a column to the [p, 1-p] quantiles of its key; p None or <= 0 changes nothing."""
    if not p or p <= 0:
        return df
    q = df.groupBy(key).agg(F.percentile(F.col(col), F.array(F.lit(p), F.lit(1.0 - p))).alias("_q"))
    clipped = F.least(F.greatest(F.col(col), F.col("_q")[0]), F.col("_q")[1])
    return (df.join(q, key).withColumn(col, F.when(F.col(col).isNotNull(), clipped)).select(*df.columns))


def zscore(df: DataFrame, cols: Sequence[str], sample: bool = True) -> DataFrame:
    """Standardise columns; a zero deviation counts as 1. Statistics are one row."""
    sd = F.stddev_samp if sample else F.stddev_pop
    stats = df.agg(F.struct(*[F.struct(
        F.avg(c).alias("mu"),
        F.coalesce(F.nullif(sd(c), F.lit(0.0)), F.lit(1.0)).alias("sd")).alias(c)
        for c in cols]).alias("s"))
    out = df.withColumn("_s", stats.select("s").scalar())
    return out.select(*[
        ((F.col(c) - F.col(f"_s.{c}.mu")) / F.col(f"_s.{c}.sd")).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("s"))
    out = df.withColumn("_s", stats.select("s").scalar())
    return out.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"_s.{c}")).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def start_dates(companies: DataFrame, market: DataFrame, fundamentals: DataFrame,
                macro: DataFrame, end: Column, mode: str = "min",
                anchor: str = "min", key: str = "sector_id") -> DataFrame:
    """Start date of the feature build, per sector.

    "min": the latest of the first dates of the three tables. "auto": the day
    after the first stored market date (``anchor="max"`` takes the newest one),
    falling back to "min". Sectors whose start is missing or after the end are
    left out.
    """
    active = companies.where("is_active").select(F.col("id").alias("company_id"), key)
    pick = F.max if anchor == "max" else F.min

    def per_sector(df: DataFrame, agg, name: str) -> DataFrame:
        # Companies are reduced first, so the join sees one row per company.
        per = df.where(F.col("date") <= end).groupBy("company_id").agg(agg("date").alias(name))
        return active.join(per, "company_id").groupBy(key).agg(agg(name).alias(name))

    first_market = per_sector(market, F.min, "_m")
    first_fund = per_sector(fundamentals, F.min, "_f")
    first_macro = macro.where(F.col("date") <= end).agg(F.min("date").alias("d"))
    out = (active.select(key).distinct().join(first_market, key, "left")
           .join(first_fund, key, "left"))
    start = F.greatest("_m", "_f", first_macro.select("d").scalar())
    if mode == "auto":
        stored = per_sector(market, pick, "_a")
        out = out.join(stored, key, "left")
        start = F.coalesce(F.date_add("_a", 1), start)
    out = out.select(key, start.alias("start_date"))
    return out.where(F.col("start_date").isNotNull() & (F.col("start_date") <= end))


def news_daily(links: DataFrame, articles: DataFrame, min_confidence: float = 0.7) -> DataFrame:
    """Average, sum and count of link confidence per company and day."""
    ok = links.where(F.col("confidence_score") >= min_confidence)
    days = articles.select(F.col("id").alias("news_article_id"), "date")
    return (ok.join(days, "news_article_id").groupBy("company_id", "date")
            .agg(F.avg("confidence_score").alias("confidence_score_avg"),
                 F.sum("confidence_score").alias("confidence_score_sum"),
                 F.count(F.lit(1)).alias("news_count")))


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    e = F.col(pred) - F.col(y)
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                  F.avg((F.signum(y) == F.signum(pred)).cast("double")).alias("hit_rate"),
                  F.avg(e).alias("bias"))


def classification_metrics(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    """AUC, log loss, accuracy, precision, recall and F1 in one row.

    The frame is read once, into positives and negatives per distinct score; every figure follows from these. AUC
    counts, for each score, the negatives below it plus half of those equal to it (ties get the average rank).
    """
    pos, s = F.col(y).cast("long"), F.col("_s")
    per = df.groupBy(F.col(score).alias("_s")).agg(F.sum(pos).alias("_pos"), F.sum(1 - pos).alias("_neg"))
    cum = running_totals(per, "_s", ["_neg"])
    p = F.least(F.greatest(s, F.lit(2.220446049250313e-16)), F.lit(1 - 2.220446049250313e-16))
    hit = (s >= threshold).cast("long")
    n = F.sum(F.col("_pos") + F.col("_neg")).cast("double")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))
    one = cum.agg(
        (F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2.0))
         / F.nullif(F.sum("_pos").cast("double") * F.sum("_neg"), F.lit(0.0))).alias("auc"),
        (-F.sum(F.col("_pos") * F.log(p) + F.col("_neg") * F.log(1 - p)) / n).alias("logloss"),
        (F.sum(F.col("_pos") * hit + F.col("_neg") * (1 - hit)) / n).alias("accuracy"),
        F.sum(F.col("_pos") * hit).alias("tp"), F.sum(F.col("_neg") * hit).alias("fp"),
        F.sum(F.col("_pos") * (1 - hit)).alias("fn"))
    return one.select("auc", "logloss", "accuracy", share(tp, tp + fp).alias("precision"),
                      share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Positive and negative counts and the positive weight max(1, neg / max(1, pos))."""
    c = df.where(F.col(y).isNotNull()).agg(
        F.coalesce(F.sum(F.col(y).cast("double")), F.lit(0.0)).alias("pos"),
        F.count(F.lit(1)).alias("n"))
    neg = F.col("n") - F.col("pos")
    return c.select("pos", neg.alias("neg"),
                    F.greatest(F.lit(1.0), neg / F.greatest(F.lit(1.0), F.col("pos")))
                    .alias("scale_pos_weight"))


def company_weights(df: DataFrame, key: str = "company_id") -> DataFrame:
    """Add ``weight`` = 1 / rows of the key, joined from per-key counts."""
    n = df.groupBy(key).agg((1.0 / F.count(F.lit(1))).alias("weight"))
    return df.join(n, key)


def decay_weights(df: DataFrame, half_life: int, key: str = "company_id",
                  order: str = "date", by: str = "position") -> DataFrame:
    """Add ``weight``: 2^(t / half_life) over row positions, rescaled to mean 1.

    Measured from the newest row, the powers are at most 1 and their mean is a
    geometric series, so only the row count is needed.
    """
    place = stacked_position if by == "position" else date_position
    out = place(df, key, order)
    n = F.col("n_rows").cast("double")
    q = 2.0 ** (-1.0 / half_life)
    mean = (1.0 - F.pow(F.lit(q), n)) / (n * (1.0 - q))
    return out.withColumn("weight", F.pow(F.lit(q), n - 1 - F.col("position")) / mean).drop("n_rows")


def sample_weights(df: DataFrame, half_life: int | None = None, balance: bool = True,
                   key: str = "company_id", order: str = "date",
                   by: str = "position") -> DataFrame:
    """Decay weight times company weight, rescaled to mean 1."""
    out = decay_weights(df, half_life, key, order, by) if half_life else df.withColumn("weight", F.lit(1.0))
    if balance:
        n = df.groupBy(key).agg((1.0 / F.count(F.lit(1))).alias("_inv"))
        out = out.join(n, key).withColumn("weight", F.col("weight") * F.col("_inv")).drop("_inv")
    mean = out.agg(F.avg("weight").alias("m")).select("m").scalar()
    return out.withColumn("weight", F.col("weight") / mean)


def time_split(df: DataFrame, valid_size: float = 0.2, min_train: int = 200, gap: int = 42,
               by: str = "position", key: str = "company_id", order: str = "date") -> DataFrame:
    """Label rows "train", "gap" or "valid" around a purge gap.

    ``by="position"`` splits the frame stacked by company, then date;
    ``by="date"`` splits the frame sorted by date, so validation is the newest part.
    """
    place = stacked_position if by == "position" else date_position
    out = place(df, key, order)
    at = F.greatest(F.floor(F.col("n_rows") * (1.0 - valid_size)), F.lit(min_train))
    pos = F.col("position")
    part = F.when(pos < at - gap, "train").when(pos < at, "gap").otherwise("valid")
    return out.withColumn("part", part).drop("n_rows")


def split_by_share(df: DataFrame, share: float = 0.8, key: str = "company_id",
                   order: str = "date") -> DataFrame:
    """Label the first floor(share * n) rows of each key "train", the rest "test"."""
    w = Window.partitionBy(key)
    return (df.withColumn("_r", F.row_number().over(w.orderBy(order)))
            .withColumn("_n", F.count(F.lit(1)).over(w))
            .withColumn("part", F.when(F.col("_r") <= F.floor(F.col("_n") * share), "train")
                        .otherwise("test")).drop("_r", "_n"))


def holdout_tail(df: DataFrame, h: int, key: str = "company_id", order: str = "date") -> DataFrame:
    """Label the last h rows of each key "test", the rest "train"."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (df.withColumn("_r", F.row_number().over(w))
            .withColumn("part", F.when(F.col("_r") <= h, "test").otherwise("train")).drop("_r"))


def last_row(df: DataFrame, key: str = "company_id", order: str = "date") -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *rest)).alias("_r"))
            .select(key, "_r.*").select(*df.columns))


